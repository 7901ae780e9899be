"""Filters as boolean columns: presence, boolean groups, ranges, token matches.

Each returns a column that is never NULL, so the negation of a predicate is the
complement of the rows it selects.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A token is a maximal run of letters and digits. No word is dropped.
TOKEN_BREAK = r"[^\p{L}\p{N}]+"

_UNITS = {
    "s": "SECOND", "m": "MINUTE", "h": "HOUR", "d": "DAY",
    "w": "WEEK", "M": "MONTH", "y": "YEAR",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _known(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def exists(c: Column | str, *, array: bool = False) -> Column:
    """The field holds a value. An empty string is a value, an empty array is not."""
    c = _col(c)
    return (c.isNotNull() & _known(F.size(c) > 0)) if array else c.isNotNull()


def exists_in(df: DataFrame, name: str) -> Column:
    """:func:`exists` with the array rule chosen from the type of the column."""
    return exists(df[name], array=isinstance(df.schema[name].dataType, T.ArrayType))


def any_of(*predicates: Column) -> Column:
    """At least one predicate holds; an empty list selects nothing."""
    return reduce(or_, map(_known, predicates)) if predicates else F.lit(False)


def all_of(*predicates: Column) -> Column:
    """Every predicate holds; an empty list selects everything."""
    return reduce(and_, map(_known, predicates)) if predicates else F.lit(True)


def between_range(c: Column | str, *, gt=None, gte=None, lt=None, lte=None) -> Column:
    """Open or closed bounds on either side; NULL is outside every range."""
    c = _col(c)
    tests = [c.isNotNull()]
    if gt is not None:
        tests.append(c > gt)
    if gte is not None:
        tests.append(c >= gte)
    if lt is not None:
        tests.append(c < lt)
    if lte is not None:
        tests.append(c <= lte)
    # a plain conjunction, so that every part can reach the parquet reader
    return reduce(and_, tests)


def since(ts: Column | str, period: str, as_of: str | Column) -> Column:
    """``ts`` is no older than ``period`` (``30d``, ``12h``, ``6M``, …) before ``as_of``."""
    found = re.fullmatch(r"(\d+)([smhdwMy])", period)
    if not found:
        raise ValueError(f"not a period: {period!r}")
    amount, unit = found.groups()
    start = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of
    ts = _col(ts)
    return ts.isNotNull() & (ts >= start - F.expr(f"INTERVAL '{amount}' {_UNITS[unit]}"))


def match_keyword(c: Column | str, value) -> Column:
    """The whole value is equal."""
    c = _col(c)
    return c.isNotNull() & (c == F.lit(value))


def tokens(c: Column | str) -> Column:
    """Lower-cased tokens of a text, in order, with repeats."""
    return F.filter(F.split(F.lower(_col(c)), TOKEN_BREAK), lambda t: t != "")


def query_tokens(query: str) -> list[str]:
    """Distinct lower-cased tokens of a query string."""
    found = re.findall(r"[^\W_]+", query.lower(), flags=re.UNICODE)
    return list(dict.fromkeys(found))


def match(c: Column | str, query: str, operator: str = "or") -> Column:
    """Full-text test: any (``or``) or every (``and``) query token is a token of the text.

    Tested without building token arrays: a substring search rules most texts
    out, and a pattern with token borders decides the rest. Both stay in
    generated code.
    """
    words = query_tokens(query)
    if operator not in ("or", "and"):
        raise ValueError(f"operator must be 'or' or 'and': {operator!r}")
    text = F.lower(_col(c))

    def has(word: str) -> Column:
        border = rf"(?<![\p{{L}}\p{{N}}]){re.escape(word)}(?![\p{{L}}\p{{N}}])"
        return text.contains(word) & text.rlike(border)

    if not words:
        return F.lit(False)
    return (any_of if operator == "or" else all_of)(*map(has, words))


def contains_any(c: Column | str, needles: Iterable[str]) -> Column:
    """Any of the strings occurs, also inside a word."""
    return any_of(*(_col(c).contains(n) for n in needles))


def has_text(c: Column | str) -> Column:
    """Not NULL and not empty."""
    return _known(F.length(_col(c)) > 0)
