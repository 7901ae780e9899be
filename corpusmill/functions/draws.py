"""Reproducible draws: every value is a function of seed, field and row id.

No draw depends on how the rows are partitioned or on which attempt of a task
produced them, unlike ``rand``. Four draws share one digest.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

_SLOTS = 4  # 32-bit draws in one 128-bit digest


class Draws:
    """Draws for one row id. The name order fixes which digest serves which field."""

    def __init__(self, seed: int, row_id: Column, names: Sequence[str]):
        self._seed = seed
        self._id = row_id.cast("string")
        self._index = {name: i for i, name in enumerate(names)}

    def digest(self, block: int | str) -> Column:
        return F.md5(F.concat(F.lit(f"{self._seed}:{block}:"), self._id).cast("binary"))

    def raw(self, name: str) -> Column:
        """A whole number below 2^32."""
        block, slot = divmod(self._index[name], _SLOTS)
        part = F.substring(self.digest(block), slot * 8 + 1, 8)
        return F.conv(part, 16, 10).cast("bigint")

    def pick(self, name: str, values: Sequence) -> Column:
        """One of the values, each equally likely."""
        return F.get(F.array(*map(F.lit, values)), (self.raw(name) % len(values)).cast("int"))

    def pick_from(self, name: str, values: Column, n: int) -> Column:
        """One entry of an array column that has ``n`` entries in every row."""
        return F.get(values, (self.raw(name) % n).cast("int"))

    def integer(self, name: str, low: Column | int, high: Column | int) -> Column:
        """Both ends included."""
        low, high = (F.lit(x) if isinstance(x, int) else x for x in (low, high))
        return low + self.raw(name) % (high - low + 1)

    def flag(self, name: str) -> Column:
        return self.raw(name) % 2 == 0

    def moment(self, name: str, start: str, end: str) -> Column:
        """A second from ``start`` (included) to ``end`` (excluded)."""
        first, last = datetime.fromisoformat(start), datetime.fromisoformat(end)
        span = int((last - first).total_seconds())
        shift = F.make_dt_interval(secs=(self.raw(name) % span).cast("decimal(18,6)"))
        return F.lit(start).cast("timestamp_ntz") + shift

    def uuid(self) -> Column:
        """An id in uuid layout."""
        h = self.digest("uuid")
        return F.concat_ws(
            "-",
            F.substring(h, 1, 8),
            F.substring(h, 9, 4),
            F.concat(F.lit("4"), F.substring(h, 14, 3)),
            F.concat(F.lit("a"), F.substring(h, 18, 3)),
            F.substring(h, 21, 12),
        )
