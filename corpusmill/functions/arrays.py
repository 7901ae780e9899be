"""Helpers for expressions over arrays."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once.

    A column that a lambda refers to may be inlined into the lambda by the
    optimizer and is then computed again for every entry of the array. A lambda
    variable cannot be inlined.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lookup(table: Mapping[str, str], key: Column) -> Column:
    """The value of a fixed table, or NULL; ``key`` is computed once."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), key)
