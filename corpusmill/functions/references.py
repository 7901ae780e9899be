"""Character references of HTML, decoded by column functions."""

from __future__ import annotations

from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.arrays import let, lookup

# fixed values: what the numbers 128 to 159 mean on the web, by the code page that pages of old were written in
_OLD_CODE_PAGE = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"
_REFERENCE = r"^(#[0-9]{1,9}|#[xX][0-9a-fA-F]{1,8}|[A-Za-z][A-Za-z0-9]{1,31});"
_UNKNOWN = "�"


@cache
def _names() -> dict[str, str]:
    """The standard names by their first letter, each on a line with its characters."""
    lines: dict[str, str] = {}
    for name, chars in sorted(html5.items()):
        if name.endswith(";") and "\n" not in chars:
            lines[name[0]] = lines.get(name[0], "\n") + f"{name[:-1]}={chars}\n"
    return lines


def _numbered(code: Column) -> Column:
    old = F.substring(F.lit(_OLD_CODE_PAGE), code.cast("int") - 127, F.lit(1))
    wide = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (
        F.when((code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF), F.lit(_UNKNOWN))
        .when(code.between(128, 159), old)
        .otherwise(wide)
    )


def _named(name: Column) -> Column:
    key = F.concat(F.lit("\n"), name, F.lit("="))

    def found(lines: Column) -> Column:
        after = F.call_function("substring_index", lines, key, F.lit(-1))
        return F.when(lines.contains(key), F.call_function("substring_index", after, F.lit("\n"), F.lit(1)))

    return let(lookup(_names(), F.substring(name, F.lit(1), F.lit(1))), found)


def _decoded(name: Column) -> Column:
    number = (
        F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, F.lit(3), F.length(name)), 16, 10))
        .otherwise(F.substring(name, F.lit(2), F.length(name)))
        .cast("bigint")
    )
    return F.when(name.startswith("#"), let(number, _numbered)).when(name == "NewLine", F.lit("\n")).otherwise(_named(name))


def decode_references(text: Column) -> Column:
    """The text with all numeric and named character references decoded, once; a no-break space is a space.

    A reference ends in a semicolon. Unknown names stay as they are written; numbers that are no character become U+FFFD.
    """

    def piece(part: Column) -> Column:
        return let(
            F.regexp_extract(part, _REFERENCE, 1),
            lambda name: F.when(name == "", F.concat(F.lit("&"), part)).otherwise(
                let(
                    _decoded(name),
                    lambda char: F.when(char.isNull(), F.concat(F.lit("&"), part)).otherwise(
                        F.concat(
                            F.when(char == " ", F.lit(" ")).otherwise(char),
                            F.substring(part, F.length(name) + 2, F.length(part)),
                        )
                    ),
                )
            ),
        )

    def whole(t: Column) -> Column:
        parts = F.split(t, "&", -1)
        rest = F.transform(F.slice(parts, F.lit(2), F.size(parts)), piece)
        return F.concat(F.get(parts, F.lit(0)), F.array_join(rest, ""))

    return let(text, lambda t: F.when(t.contains("&"), whole(t)).otherwise(t))
