"""Scalar column functions: snippets, calendar parts, counts, masks, payload keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: payload keys that have a meaning of their own
KNOWN_PAYLOAD_KEYS = ("metadata", "type", "category", "text")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def snippet(c: Column | str, n: int, *, always: bool = True) -> Column:
    """The first ``n`` characters followed by three dots.

    ``always`` keeps the dots on short text too; otherwise text that fits is
    returned as it is.
    """
    c = _col(c)
    cut = F.concat(F.substring(c, 1, n), F.lit("..."))
    return cut if always else F.when(F.length(c) > n, cut).otherwise(c)


def quarter_label(ts: Column | str, mode: str = "calendar") -> Column:
    """``Q1`` … ``Q4``; mode ``legacy`` is ``month div 3 + 1``, which reaches ``Q5``."""
    ts = _col(ts)
    if mode == "calendar":
        number = F.quarter(ts)
    elif mode == "legacy":
        number = F.floor(F.month(ts) / 3).cast("int") + 1
    else:
        raise ValueError(f"mode must be 'calendar' or 'legacy': {mode!r}")
    return F.concat(F.lit("Q"), number.cast("string"))


def calendar_parts(ts: Column | str, mode: str = "calendar") -> dict[str, Column]:
    """Quarter, year, month name and weekday name, by column name."""
    # through the date, so that no clock change of the session zone can shift it
    day = _col(ts).cast("date")
    return {
        "quarter": quarter_label(day, mode),
        "year": F.year(day),
        "month": F.date_format(day, "MMMM"),
        "day_of_week": F.date_format(day, "EEEE"),
    }


def iso_format(ts: Column | str) -> Column:
    """ISO-8601 with seconds and no zone."""
    return F.replace(F.substring(_col(ts).cast("string"), 1, 19), F.lit(" "), F.lit("T"))


def iso_parse(text: Column | str) -> Column:
    """Reads ISO-8601 with or without ``Z`` or an offset; what cannot be read becomes NULL.

    ``Z`` is taken as the zone all data is in, and a time with an offset is moved to it, so
    the result does not depend on the time zone of the session.
    """
    trimmed = F.trim(_col(text))
    offset = F.regexp_extract(trimmed, r"[T ]\d{1,2}:.*([+-]\d{2}):?(\d{2})$", 0)
    hours = F.regexp_extract(trimmed, r"([+-]\d{2}):?\d{2}$", 1)
    minutes = F.concat(F.substring(hours, 1, 1), F.substring(trimmed, -2, 2))
    read = F.regexp_replace(trimmed, "Z$", "").try_cast("timestamp_ntz")
    bare = F.regexp_replace(trimmed, r"[+-]\d{2}:?\d{2}$", "").try_cast("timestamp_ntz")
    moved = bare - F.make_dt_interval(F.lit(0), hours.try_cast("int"), minutes.try_cast("int"))
    return F.when(offset != "", moved).otherwise(read)


def iso_year(text: Column | str) -> Column:
    return F.year(iso_parse(text))


def word_count(c: Column | str) -> Column:
    """Words between runs of white space."""
    return F.size(F.filter(F.split(_col(c), r"(?U)\s+"), lambda t: t != ""))


def text_stats(c: Column | str) -> dict[str, Column]:
    """Words and characters, by column name."""
    c = _col(c)
    return {"n_words": word_count(c), "n_chars": F.length(c)}


def mask_middle(c: Column | str, keep: int = 10) -> Column:
    """Keeps both ends of a long secret; one too short for that is hidden whole."""
    c = _col(c)
    ends = F.concat(F.left(c, F.lit(keep)), F.lit("..."), F.right(c, F.lit(keep)))
    hidden = F.repeat(F.lit("*"), F.length(c))
    return F.when(F.length(c) > 2 * keep, ends).otherwise(hidden)


def payload_keys(json_text: Column | str) -> Column:
    """Top-level keys of a JSON object, in order of appearance; NULL if it is none."""
    return F.json_object_keys(_col(json_text))


def extra_keys(keys: Column | str, known: tuple[str, ...] = KNOWN_PAYLOAD_KEYS) -> Column:
    """Keys without the known ones."""
    return F.array_except(_col(keys), F.array(*map(F.lit, known)))


def describe_vector(v: Column | str) -> dict[str, Column]:
    """First, second and last coordinate at four decimals, and the dimension."""
    v = _col(v)

    def shown(x: Column) -> Column:
        return F.when(x.isNotNull(), F.format_string("%.4f", x.cast("double")))

    return {
        "first": shown(F.get(v, F.lit(0))),
        "second": shown(F.get(v, F.lit(1))),
        "last": shown(F.try_element_at(v, F.lit(-1))),
        "dim": F.size(v),
    }


def megabytes(n_bytes: Column | str) -> Column:
    """Bytes as MB at two decimals."""
    return F.round(_col(n_bytes) / F.lit(1048576.0), 2)
