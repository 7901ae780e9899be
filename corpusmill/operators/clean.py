"""Removal of inline images from converted notebook text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: what an inline image is, and which gap is closed after removal.
# [^\n] rather than a dot: a dot also stops at other line ends here.
INLINE_IMAGE = r"!\[[^\n]*?\]\(data:image/[^;]+;base64,[A-Za-z0-9+/=]+\)"
BLANK_GAP = r"(?U)\n\s*\n\s*\n+"


def image_count(text: Column | str) -> Column:
    """Inline base64 images in the text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_count(text, F.lit(INLINE_IMAGE))


def without_images(text: Column | str, n_images: Column) -> Column:
    """The text without images and with wide gaps closed, or as it is if it has none."""
    text = F.col(text) if isinstance(text, str) else text
    cleaned = F.regexp_replace(F.regexp_replace(text, INLINE_IMAGE, ""), BLANK_GAP, "\n\n\n")
    return F.when(n_images > 0, cleaned).otherwise(text)


def strip_inline_images(df: DataFrame, text: str = "content") -> DataFrame:
    """Cleans a text column in place and adds ``n_images``.

    Text without the literal mark of an inline image, which is nearly all of
    it, is told apart by a plain substring search before any pattern runs.
    """
    count = F.when(F.col(text).contains(";base64,"), image_count(text)).when(
        F.col(text).isNotNull(), F.lit(0)
    )
    counted = df.withColumn("n_images", count)
    return counted.withColumn(text, without_images(text, F.col("n_images")))
