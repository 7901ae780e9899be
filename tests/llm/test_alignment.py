"""Cross-tokenizer alignment against the libraries and pairs counted one by one."""

import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest

from corpusmill.llm import alignment
from corpusmill.llm.bpe import byte_alphabet

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
draw = random.Random(9)
WORDS = "the of and ing straße 日本 don't x1 .. ## 12.5 Ω²   naïve tokenization\nline <s> </s> <|endoftext|> <unk> <0x41>".split(" ")


def prose(n):
    return " ".join(draw.choice(WORDS) for _ in range(n))


TEXTS = [None, "", " ", "  a", "a ", "a  b", "\n\n", "a", "the the the the", "▁", "a▁b", "nul \x00 x", "😀 J̌ ﬁ", "é" * 300, "x" * 900, prose(2000),
         "<|endoftext|>", " <s>", "tab\tend\t", "\r\n", "a \xa0 \xa0b \n \nc\n \td\n", "x \n", "\x1c y \x85 z\u3000 w", *[prose(draw.randint(1, 60)) for _ in range(40)]]


@pytest.fixture(scope="module", autouse=True)
def shared(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    stand_ins = byte_alphabet()

    def tokens(text):
        """(id, begin, end) of both sides; none where the bytes differ."""
        if not text:
            return [], []
        want, sides = (" " + text).encode(), []
        ids = a.encode(" " + text, add_special_tokens=False)
        sides.append([(i, bytes(stand_ins[c] for c in t)) for i, t in zip(ids.ids, ids.tokens)])
        pieces = [(i, b.id_to_piece(i)) for i in b.encode(text)]
        sides.append([(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces])
        if any(b"".join(t for _, t in s) != want for s in sides):
            return [], []
        placed = []
        for s in sides:
            ends = np.cumsum([len(t) for _, t in s]).tolist()
            placed.append([(i, e - len(t), e) for (i, t), e in zip(s, ends)])
        return placed[0], placed[1]

    return tokens


def brute(texts, tokens):
    docs, count, n_docs = [], Counter(), Counter()
    for text in texts:
        a, b = tokens(text)
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        count.update(links)
        n_docs.update(set(links))
        ends, groups, start = sorted({x[2] for x in a} & {y[2] for y in b}), [], 0
        for e in ends:
            groups.append(tuple([t[0] for t in side if start < t[2] <= e] for side in (a, b)))
            start = e
        docs.append((a, b, links, groups))
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    out = []
    for a, b, links, groups in docs:
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((len(a), len(b), len(groups), len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links),
                    sha256(text.encode()).hexdigest() if a else ""))
    return out, count, n_docs


@pytest.mark.parametrize("block_links, buckets, together", [(4_000_000, 16, 32), (500, 3, 2)])
def test_alignment(spark, libraries, monkeypatch, block_links, buckets, together):
    monkeypatch.setattr(alignment, "TOGETHER", together)
    rows = [(i, t, "k", 1, 2) for i, t in enumerate(TEXTS)] + [(3, TEXTS[15], "k", 1, 2), (None, "an id is missing", "k", 1, 2), (8, TEXTS[8], "k", 1, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, task string, pair int, n_links int").repartition(3)
    want, count, n_docs = brute([r[1] for r in rows], libraries)
    found = alignment.align(df, A, B, buckets, block_links)
    counts = alignment.pair_counts(found)
    assert {(r["a"], r["b"]): (r["n_docs"], r["n_links"]) for r in counts.collect()} == {p: (n_docs[p], n) for p, n in count.items()}
    scored = {(r["task"], r["block"], r["number"]): (r["n_best"], r["count_sum"])
              for r in alignment.document_scores(found, alignment.best_pairs(counts).select("pair", "n_links", "best"), buckets).collect()}
    got = Counter(
        (r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], *scored.get((r["task"], r["block"], r["number"]), (0, 0)), r["groups_sha256"])
        for r in found.documents.collect()
    )
    assert got == Counter((r[0], *w) for r, w in zip(rows, want))
    if buckets == alignment.BUCKETS:
        got = Counter((r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"])
                      for r in alignment.score_documents(df, A, B).collect())
        assert got == Counter((r[0], *w) for r, w in zip(rows, want))
        assert alignment.score_documents(df.limit(0), A, B).count() == 0


def test_spans(spark, libraries):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in alignment.group_spans(df, A, B).collect():
        a, b = libraries(TEXTS[r["doc_id"]])
        begins = [0]
        for g in r["groups"]:
            assert g["begin"] == begins[-1]
            begins.append(g["end"])
            assert g["a"] == [t[0] for t in a if g["begin"] < t[2] <= g["end"]] and g["b"] == [t[0] for t in b if g["begin"] < t[2] <= g["end"]]
        assert begins[-1] == (a[-1][2] if a else 0)


@pytest.mark.parametrize("n_docs", [1, 7, 40, 3000])
def test_bitmaps(n_docs):
    rng = np.random.default_rng(n_docs)
    postings = {}
    for p in range(60):
        for d in rng.choice(n_docs, rng.integers(1, n_docs + 1) if p % 3 == 0 else min(n_docs, 3), replace=False).tolist():
            postings[p * 1000, d] = int(rng.choice([1, 1, 1, 2, 3, 900]))
    keys = sorted(postings)
    pairs, docs = (np.array(c, np.int64) for c in zip(*keys))
    times = np.array([postings[k] for k in keys])
    maps = alignment.Bitmaps.read(alignment.Bitmaps.of(pairs, docs, times, n_docs).record())
    back = Counter()
    which, doc = maps.postings()
    for w, d in zip(which.tolist(), doc.tolist()):
        back[int(maps.pairs[w]), d] += 1 << int(maps.planes[w])
    assert back == Counter(postings)
    names, in_docs, links = maps.counts()
    assert names.tolist() == sorted({p for p, _ in keys})
    assert in_docs.tolist() == [sum(p == q for q, _ in keys) for p in names.tolist()]
    assert links.tolist() == [sum(n for (q, _), n in postings.items() if p == q) for p in names.tolist()]
    half = maps.part(maps.pairs % 2000 == 0)
    assert set(zip(half.pairs.tolist(), half.planes.tolist())) == {(p, k) for p, k in zip(maps.pairs.tolist(), maps.planes.tolist()) if p % 2000 == 0}
