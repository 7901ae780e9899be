import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from corpusmill.operators.clean import strip_inline_images

IMAGE = "![x](data:image/png;base64,AAA=)"


def strip(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, content string")
    rows = strip_inline_images(df).orderBy("i").collect()
    return [(r.content, r.n_images) for r in rows]


@pytest.mark.parametrize(
    "text, cleaned, n",
    [
        (f"a\n{IMAGE}\n\n\n\nb", "a\n\n\nb", 1),
        ("![a] t ![b](data:image/png;base64,QQ==) z", " z", 1),
        ("no img\n\n\n\n\nk", "no img\n\n\n\n\nk", 0),
        ("![a\rb](data:image/png;base64,QQ==)\n  \n\n\nq", "\n\n\nq", 1),
        ("![a](data:image/png;base64,QQ==)\n\n\n    ind", "\n\n\n    ind", 1),
        (None, None, None),
        ("", "", 0),
        ("![a](data:image/png;base64,)", "![a](data:image/png;base64,)", 0),
    ],
)
def test_cases(spark, text, cleaned, n):
    assert strip(spark, [text]) == [(cleaned, n)]


BASE64 = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=")


def image_end(text, at):
    """Where the image that opens at ``at`` ends, or -1: a scanner, character by character."""
    line_end = text.find("\n", at)
    close = text.find("](data:image/", at + 2)
    while 0 <= close and (line_end < 0 or close < line_end):
        kind = close + len("](data:image/")
        mark = text.find(";", kind)
        if mark > kind and text.startswith(";base64,", mark):
            end = start = mark + len(";base64,")
            while end < len(text) and text[end] in BASE64:
                end += 1
            if end > start and text[end : end + 1] == ")":
                return end + 1
        close = text.find("](data:image/", close + 1)
    return -1


def scanned(text):
    """The text and its images by hand: images out, then runs of blank lines closed if there were any."""
    kept, n, at = [], 0, 0
    while at < len(text):
        end = image_end(text, at) if text.startswith("![", at) else -1
        if end >= 0:
            n, at = n + 1, end
        else:
            kept.append(text[at])
            at += 1
    if not n:
        return text, 0
    rest, out, at = "".join(kept), [], 0
    while at < len(rest):
        if rest[at] == "\n":
            stop = at
            while stop < len(rest) and rest[stop].isspace():
                stop += 1
            last = rest.rfind("\n", at, stop)
            if rest.count("\n", at, last + 1) >= 3:
                out.append("\n\n\n")
                at = last + 1
                continue
        out.append(rest[at])
        at += 1
    return "".join(out), n


pieces = st.sampled_from(
    [IMAGE, "![", "]", "(data:image/png;base64,", "QQ==)", "\n", "\r", " ", " ", " ",
     "\u0085", "ab", "\n\n\n", "![a\nb](data:image/gif;base64,Zm9v)", "\t"]
)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(pieces, max_size=14).map("".join), min_size=150, max_size=150))
def test_like_a_scanner(spark, texts):
    assert strip(spark, texts) == [scanned(t) for t in texts]
