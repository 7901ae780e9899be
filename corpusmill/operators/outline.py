"""The hierarchy of HTML documents: every element with its parent and depth.

A page is cut once, at the tags that shape it. The pieces are folded in order over a stack of what is open: lists
and other containers, headings, list items. What stands on it when an element begins are its ancestors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.arrays import let, lookup
from corpusmill.operators.partition import CATEGORIES, metadata, plain

# fixed values: tags by what they do to the hierarchy
LISTS = ("ul", "ol")
CONTAINERS = (*LISTS, "dl", "section", "article", "div", "nav", "aside", "main", "header", "footer", "blockquote", "figure", "form", "body")
HEADINGS = {"title": 0, "h1": 1, "h2": 2, "h3": 3, "h4": 4, "h5": 5, "h6": 6}
_SHAPING = "|".join((*CONTAINERS, *HEADINGS, "p", "li", "table", "img"))
_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
_CUT = rf"(?i)(?=</?(?:{_SHAPING})\b[^<>]*>)"
_TAG = rf"(?i)^<(/?(?:{_SHAPING}))\b[^<>]*>"
_ALT = r"""(?is)\balt\s*=\s*(?:"([^"]*)"|'([^']*)')"""
_PIECES = 128  # pieces folded before their elements are put to the others, so that these are seldom copied

_STACK = "array<struct<tag:string,level:int,pos:int>>"
_ELEMENTS = "array<struct<type:string,category:string,text:string,depth:int,parent_pos:int>>"
_STATE = f"struct<stack:{_STACK},tables:int,table:array<string>,n:int,out:{_ELEMENTS}>"


def _entry(tag: Column | str, level: Column | None = None, pos: Column | None = None) -> Column:
    none = F.lit(None).cast("int")
    return F.struct(
        (F.lit(tag) if isinstance(tag, str) else tag).alias("tag"),
        (none if level is None else level).alias("level"),
        (none if pos is None else pos).alias("pos"),
    )


def _upto(stack: Column, n: Column) -> Column:
    return F.slice(stack, F.lit(1), n)


def _last(stack: Column, test) -> Column:
    """Number of entries up to the last one that passes; 0 if none does."""
    return F.coalesce(F.array_max(F.transform(stack, lambda e, i: F.when(test(e), i + 1).otherwise(F.lit(0)))), F.lit(0))


def _stacked(stack: Column, tag: Column, level: Column) -> Column:
    """The stack after a tag, before the element that it may begin."""
    name = F.substring(tag, F.lit(2), F.length(tag))
    opened = F.concat(stack, F.array(_entry(tag)))
    # a closing tag that nothing is open for does nothing
    closed = let(_last(stack, lambda e: e["tag"] == name), lambda n: F.when(n > 0, _upto(stack, n - 1)).otherwise(stack))
    # a heading ends those of its level or below in the same container
    heading = let(
        _last(stack, lambda e: e["tag"] != "h"), lambda n: F.filter(stack, lambda e, i: ~((i >= n) & (e["level"] >= level)))
    )
    items = let(
        _last(stack, lambda e: e["tag"].isin(*LISTS)),
        lambda n: F.when(n > 0, _upto(stack, n)).otherwise(F.filter(stack, lambda e: e["tag"] != "li")),
    )
    return (
        F.when(tag.isin(*CONTAINERS), opened)
        .when(tag.isin(*(f"/{c}" for c in CONTAINERS)), closed)
        .when(level.isNotNull(), heading)
        .when(tag == "li", F.concat(items, F.array(_entry("li"))))
        .when(tag == "/li", items)
        .otherwise(stack)
    )


def _step(state: Column, piece: Column) -> Column:
    """One piece: what it does to the stack, and the elements that it gives."""
    tag, text, level = piece["tag"], piece["text"], piece["level"]
    inside = state["tables"] > 0
    tables = (
        F.when(tag == "table", state["tables"] + 1)
        .when(tag == "end", F.lit(0))
        .when(tag == "/table", F.greatest(state["tables"] - 1, F.lit(0)))
        .otherwise(state["tables"])
    )
    none = F.lit(None).cast("string")

    def placed(s: Column) -> Column:
        stack, tables = s["stack"], s["tables"]
        empty_item = F.coalesce(F.get(stack, F.size(stack) - 1)["tag"] == "li", F.lit(False)) & F.get(stack, F.size(stack) - 1)["pos"].isNull()
        done = inside & (tables == 0)
        # a table is one element, however it ends; inside of it nothing else is
        block = F.when(done, F.lit("Table")).when((tables == 0) & (tag == "img"), F.lit("Image"))
        block_text = F.when(done, F.array_join(F.filter(state["table"], lambda t: t != ""), " ")).when(tag == "img", piece["alt"])
        own = F.when((tables > 0) | (text == ""), none).otherwise(
            F.when(level.isNotNull(), F.lit("Title"))
            .when((tag == "li") | ((tag == "p") & empty_item), F.lit("ListItem"))
            .otherwise(F.lit("NarrativeText"))
        )
        found = F.filter(
            F.array(F.struct(block.alias("type"), block_text.alias("text")), F.struct(own.alias("type"), text.alias("text"))),
            lambda e: e["type"].isNotNull() & ((e["text"] != "") | (e["type"] == "Image")),
        )

        def emitted(found: Column) -> Column:
            ancestors = F.filter(stack, lambda e: e["pos"].isNotNull())
            parent = F.array_max(F.transform(ancestors, lambda e: e["pos"]))
            elements = F.transform(
                found,
                lambda e: F.struct(
                    e["type"].alias("type"), lookup(CATEGORIES, e["type"]).alias("category"), e["text"].alias("text"),
                    F.size(ancestors).alias("depth"), parent.alias("parent_pos"),
                ),
            )
            at = state["n"] + F.size(found) - 1  # of the element of the piece's own text, which comes last
            grown = (
                F.when((own == "Title"), F.concat(stack, F.array(_entry("h", level, at))))
                .when(own == "ListItem", F.concat(_upto(stack, F.size(stack) - 1), F.array(_entry("li", pos=at))))
                .otherwise(stack)
            )
            return F.struct(
                grown.alias("stack"), tables.alias("tables"),
                F.when(tables > 0, F.when(inside, F.concat(state["table"], F.array(text))).otherwise(F.array(text)))
                .otherwise(F.array().cast("array<string>")).alias("table"),
                (state["n"] + F.size(found)).alias("n"), F.concat(state["out"], elements).alias("out"),
            ).cast(_STATE)

        return let(found, emitted)

    stack = F.when(inside | (tables > 0), state["stack"]).otherwise(_stacked(state["stack"], tag, level))
    return let(F.struct(stack.alias("stack"), tables.alias("tables")), placed)


def html_outline(html: Column | str) -> Column:
    """Elements of an HTML text in order: ``(type, category, text, depth, parent_pos)``.

    The parent of an element is the list item it stands in, else the heading it stands under, by its position from 0;
    NULL without either. A heading heads what follows in its container up to one of its level or above. ``depth`` is
    the number of ancestors. Tags that are left open end where a neighbour of theirs begins or their container ends.
    Every piece of text between two shaping tags is an element of its own, a table as a whole is one; scripts, styles and
    comments are none. An empty list item is a place in the stack, but no element and no parent.
    """
    html = F.col(html) if isinstance(html, str) else html
    pieces = F.concat(F.split(F.regexp_replace(html, _HIDDEN, " "), _CUT, -1), F.array(F.lit("")))

    def folded(raw: Column) -> Column:
        def piece(p: Column, i: Column) -> Column:
            tag = F.lower(F.regexp_extract(p, _TAG, 1))
            return let(
                tag,
                lambda t: F.struct(
                    F.when(i == F.size(raw) - 1, F.lit("end")).otherwise(t).alias("tag"), plain(p).alias("text"),
                    lookup(_LEVELS, t).cast("int").alias("level"),
                    F.when(t == "img", F.trim(plain(F.concat(F.regexp_extract(p, _ALT, 1), F.regexp_extract(p, _ALT, 2))))).alias("alt"),
                ),
            )

        def fold(typed: Column) -> Column:
            start = F.struct(
                F.array().alias("stack"), F.lit(0).alias("tables"), F.array().alias("table"), F.lit(0).alias("n"), F.array().alias("out")
            ).cast(_STATE)

            def block(state: Column, k: Column) -> Column:
                some = F.slice(typed, k * _PIECES + 1, F.lit(_PIECES))
                fresh = F.struct(
                    state["stack"].alias("stack"), state["tables"].alias("tables"), state["table"].alias("table"), state["n"].alias("n"),
                    F.array().cast(_ELEMENTS).alias("out"),
                )
                return let(
                    F.aggregate(some, fresh.cast(_STATE), _step),
                    lambda s: F.struct(
                        s["stack"].alias("stack"), s["tables"].alias("tables"), s["table"].alias("table"), s["n"].alias("n"),
                        F.concat(state["out"], s["out"]).alias("out"),
                    ).cast(_STATE),
                )

            blocks = F.sequence(F.lit(0), F.expr("0") + F.floor((F.size(typed) - 1) / _PIECES).cast("int"))
            return F.aggregate(blocks, start, block, lambda s: s["out"])

        return let(F.transform(raw, piece), fold)

    return F.when(html.isNotNull(), let(pieces, folded))


_LEVELS = {tag: str(level) for tag, level in HEADINGS.items()}


def outline_html(df: DataFrame, doc_id: str = "doc_id", html: str = "html", filename: str | None = None) -> DataFrame:
    """One row per element: doc_id, pos, type, category, text, depth, parent_pos, metadata."""
    return df.select(
        F.col(doc_id).alias("doc_id"), metadata(filename, F.lit("html")).alias("metadata"), F.posexplode(html_outline(html))
    ).select("doc_id", "pos", "col.type", "col.category", "col.text", "col.depth", "col.parent_pos", "metadata")
