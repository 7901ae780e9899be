"""Text into vectors: signed feature hashing, and a hook for models of your own.

Feature hashing is the published method of Weinberger et al. (2009): every token
adds +1 or -1 to one of ``dim`` coordinates, both chosen by its digest, and the
sum is scaled to unit length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.arrays import let
from corpusmill.functions.predicates import tokens

DIM = 1536


def _signed_codes(text: Column, dim: int) -> Column:
    """Sorted ``2 * coordinate + (1 if negative)``, one per token.

    The first eight hex digits of the digest choose the coordinate, the next
    two the sign (even is positive); all ten are read as one number.
    """

    numbers = F.transform(
        tokens(text),
        lambda t: F.conv(F.substring(F.md5(t.cast("binary")), 1, 10), 16, 10).cast("bigint"),
    )
    # a second pass, so that the number is read once and used twice
    return F.sort_array(
        F.transform(
            numbers, lambda v: (F.shiftright(v, 8) % dim * 2 + v.bitwiseAND(1)).cast("int")
        )
    )


def hashed_counts(text: Column | str, dim: int = DIM) -> Column:
    """Array of (dim, n): the signed token count of every coordinate that is not zero.

    Works on runs of equal sorted codes inside the row, so no token ever
    leaves its task. A run is known by its last index, its length is the
    distance to the run before, and the two runs of a coordinate are neighbours.
    """
    text = F.col(text) if isinstance(text, str) else text

    def run_ends(codes: Column) -> Column:
        # a code that differs from its successor ends a run; the last one always does
        marked = F.transform(
            codes,
            lambda c, i: F.when(
                ~F.get(codes, i + 1).eqNullSafe(c), F.struct(i.alias("i"), c.alias("code"))
            ),
        )
        return F.filter(marked, lambda e: e.isNotNull())

    def lengths(ends: Column) -> Column:
        return F.transform(
            ends,
            lambda e, k: F.struct(
                e["code"].alias("code"),
                (e["i"] - F.coalesce(F.get(ends, k - 1)["i"], F.lit(-1))).alias("n"),
            ),
        )

    def signed(runs: Column) -> Column:
        def weigh(r: Column, k: Column) -> Column:
            after, before = F.get(runs, k + 1), F.get(runs, k - 1)
            minus = F.when(after["code"] == r["code"] + 1, after["n"]).otherwise(0)
            positive = F.struct(
                F.shiftright(r["code"], 1).alias("dim"), (r["n"] - minus).alias("n")
            )
            negative = F.struct(F.shiftright(r["code"], 1).alias("dim"), (-r["n"]).alias("n"))
            return F.when(r["code"].bitwiseAND(1) == 0, positive).when(
                ~before["code"].eqNullSafe(r["code"] - 1), negative
            )

        return F.filter(F.transform(runs, weigh), lambda w: w.isNotNull() & (w["n"] != 0))

    return let(
        _signed_codes(text, dim),
        lambda codes: let(run_ends(codes), lambda ends: let(lengths(ends), signed)),
    )


def hashed_sparse(text: Column | str, dim: int = DIM) -> Column:
    """Array of (dim, w) with unit length in total; empty for text without tokens."""
    return let(
        hashed_counts(text, dim),
        lambda counts: let(
            F.sqrt(
                F.aggregate(
                    counts, F.lit(0.0), lambda acc, c: acc + (c["n"] * c["n"]).cast("double")
                )
            ),
            lambda norm: F.transform(
                counts,
                lambda c: F.struct(c["dim"].alias("dim"), (c["n"] / norm).alias("w")),
            ),
        ),
    )


def densify(sparse: Column, dim: int = DIM) -> Column:
    """A sparse vector, sorted by dim, as ``dim`` floats, as the point table stores it.

    Zeros are laid out between one coordinate and the next, so the work grows
    with ``dim`` and not with ``dim`` times the number of coordinates.
    """

    def zeros(n: Column) -> Column:
        return F.array_repeat(F.lit(0.0).cast("float"), n)

    def last_dim(entry: Column) -> Column:
        return F.coalesce(entry["dim"], F.lit(-1))

    def dense(s: Column) -> Column:
        filled = F.flatten(
            F.transform(
                s,
                lambda e, k: F.array_append(
                    zeros(e["dim"] - last_dim(F.get(s, k - 1)) - 1), e["w"].cast("float")
                ),
            )
        )
        return F.concat(filled, zeros(F.lit(dim - 1) - last_dim(F.get(s, F.size(s) - 1))))

    return let(sparse, dense)


def embed_hashed(
    df: DataFrame, text: str = "text", vector: str = "vector", dim: int = DIM
) -> DataFrame:
    """Adds a dense hashed vector; NULL where the text has no tokens."""
    sparse = hashed_sparse(text, dim)
    dense = let(sparse, lambda s: F.when(F.size(s) > 0, densify(s, dim)))
    return df.withColumn(vector, dense)


def embed_with(
    df: DataFrame,
    model: Callable[[list[str]], list],
    dim: int,
    text: str = "text",
    vector: str = "vector",
) -> DataFrame:
    """Adds vectors from a model of your own.

    ``model`` maps a list of texts to as many sequences of ``dim`` numbers. It
    is called once per Arrow batch, inside the tasks, without the NULL texts, whose vectors are NULL.
    """

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            given = batch[batch.notna()]
            vectors = [[float(x) for x in v] for v in model(given.tolist())] if len(given) else []
            if len(vectors) != len(given) or any(len(v) != dim for v in vectors):
                raise ValueError(f"the model must return {len(given)} vectors of {dim}")
            found = pd.Series([None] * len(batch), index=batch.index, dtype=object)
            for at, vector in zip(given.index, vectors):
                found.at[at] = vector
            yield found

    return df.withColumn(vector, run(F.col(text)))
