"""Quality classifier by positive-unlabelled learning with the non-negative risk estimator.

Trusted positives are the documents labelled good outside of the held-out part; every other document is
unlabelled web text, a mixture of good and bad in proportion of the class prior, whatever its label says.
The risk of calling unlabelled text bad, less the part that the good ones in it must add, estimates
the risk on bad text; that estimate may not fall below zero, or the model has begun to fit noise.

The model is linear in fixed features (measures of the text and tanh units of drawn weights) and the
loss is squared, so the risk is a function of the second moments of positives and of unlabelled rows.
Tasks add these up over *all* rows, and what the driver minimises is the exact risk, whose
size does not depend on the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import each_block, kept_rows, staged

FEATURES = (
    "log_words", "log_chars", "word_length", "upper_words", "upper_chars", "bangs", "bars", "stars", "symbols",
    "commas", "stops", "distinct", "adjacent", "lines", "repeated_lines", "digits", "short_words", "quotes",
)
UNITS = 64  # tanh units
RIDGE = 0.9  # weight of the squared coefficients, over the root of the number of positives
_CLIP = 4.0  # standardised measures reach so far
_BINS = 2000


def features_of(text: str) -> list[float]:
    """Measures of a text, all of bounded size; the empty text has zeros."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    data = text.encode("utf-8", "replace")
    lines = [x for x in text.split("\n") if x]
    chars = len(text)
    symbols = sum(map(text.count, "#%&$<>"))
    upper = len(data) - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = len(data) - len(data.translate(None, b"0123456789"))
    return [
        math.log1p(n),
        math.log1p(chars),
        min(chars / n, 40.0) / 10,
        sum(map(str.isupper, words)) / n,
        upper / len(data),
        min(text.count("!") / n, 3.0),
        min(text.count("|") / n, 3.0),
        min(text.count("*") / n, 3.0),
        min(symbols / n, 3.0),
        min(text.count(",") / n, 3.0),
        min(text.count(".") / n, 3.0),
        len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        min(len(lines) / n, 1.0),
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        digits / len(data),
        sum(len(w) <= 3 for w in words) / n,
        min(text.count('"') / n, 3.0),
    ]


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the features of every row."""

    def make() -> Callable[[list[str]], dict[str, pa.Array]]:
        return lambda texts: {"features": [features_of(t) for t in texts]}

    return each_block(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")), "_text", make, "features array<double>"
    )


def held_out(doc_id: Column) -> Column:
    """Whether a document is left out of training: crc32 of its id as text divides by five; a null id is."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


@dataclass(frozen=True)
class Model:
    """Coefficients over the fixed features of standardised measures; ``prior`` is the share of good ones in all rows."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float = 0.5

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The estimated probability to be good; one half where nothing was learnt."""
        return np.clip((expanded(x, self.mean, self.scale) @ self.weights + 1) / 2, 0.0, 1.0)


def expanded(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """One, the standardised measures, and tanh units over them whose weights are drawn once and for all."""
    draw = np.random.default_rng(7)
    z = np.clip((x - mean) / scale, -_CLIP, _CLIP)
    inner = draw.normal(0, 1.5 * x.shape[1] ** -0.5, (x.shape[1], UNITS))
    return np.concatenate([np.ones((len(z), 1)), z / 2, np.tanh(z @ inner + draw.uniform(-1.5, 1.5, UNITS))], axis=1)


@dataclass(frozen=True)
class Moments:
    """Number of rows, and the sums of their features and of the products of these."""

    n: float
    first: np.ndarray
    second: np.ndarray

    @staticmethod
    def zero(width: int) -> Moments:
        return Moments(0.0, np.zeros(width), np.zeros((width, width)))

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.first + other.first, self.second + other.second)

    def risk(self, weights: np.ndarray, sign: int) -> float:
        """Mean of the squared loss, a quarter of (1 - sign * f)^2."""
        return float(1 - 2 * sign * (self.first @ weights) / self.n + weights @ self.second @ weights / self.n) / 4


def fit(positive: Moments, unlabelled: Moments, prior: float, ridge: float = RIDGE, non_negative: bool = True) -> np.ndarray:
    """The coefficients of least non-negative risk, for ``prior`` as the share of good ones among the unlabelled.

    Without the bound the risk has one minimum in closed form. If the estimated risk on bad text is
    below zero there, the minimum of the bounded risk lies where the estimate is zero: there the estimate enters
    with some weight between 0 and 1 (a subgradient of the bound), which bisection finds.
    """
    width = len(positive.first)
    penalty = np.eye(width) * ridge / np.sqrt(positive.n)
    penalty[0, 0] = 1e-9

    def at(weight: float) -> np.ndarray:
        second = weight * unlabelled.second / unlabelled.n + (1 - weight) * prior * positive.second / positive.n
        first = prior * (1 + weight) * positive.first / positive.n - weight * unlabelled.first / unlabelled.n
        return np.linalg.solve(second + penalty, first)

    def bad_risk(weights: np.ndarray) -> float:
        return unlabelled.risk(weights, -1) - prior * positive.risk(weights, -1)

    best = at(1.0)
    if non_negative and bad_risk(best) < 0:
        low, high = 0.0, 1.0
        for _ in range(40):
            middle = (low + high) / 2
            low, high = (middle, high) if bad_risk(at(middle)) >= 0 else (low, middle)
        best = at(low)
    return best


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """Adds ``score`` to rows with ``features``, which are left out."""
    kept = [c for c in rows.columns if c != "features"]
    schema = rows.select(*kept, F.lit(0.0).alias("score")).schema

    def run(batches):
        for batch in batches:
            x = _matrix(batch)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(model.scores(x))],
                names=[*kept, "score"],
            )

    return rows.mapInArrow(run, schema)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("features"))
    return column.flatten().to_numpy().reshape(-1, len(FEATURES))


def moments(rows: DataFrame, mean: np.ndarray, scale: np.ndarray) -> dict[tuple[bool, int], Moments]:
    """Moments by kind and half over all rows ``(good, half, features)``.

    Each task leaves one row of fixed size for each of the four, and as many tasks as the root of their number
    add those up, so that the driver gets few.
    """
    width = 1 + len(FEATURES) + UNITS
    schema = "good boolean, half int, n double, first array<double>, second array<double>"

    def record(sums: dict[tuple[bool, int], Moments]) -> pa.RecordBatch:
        keys = sorted(sums)
        doubles = pa.list_(pa.float64())
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.bool_()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([sums[k].n for k in keys], pa.float64()), pa.array([sums[k].first for k in keys], doubles),
             pa.array([sums[k].second.ravel() for k in keys], doubles)],
            names=["good", "half", "n", "first", "second"],
        )

    def add_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[bool, int], Moments] = {}
        for batch in batches:
            x = expanded(_matrix(batch), mean, scale)
            good, half = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for key in {(bool(g), int(h)) for g, h in set(zip(good.tolist(), half.tolist()))}:
                part = x[(good == key[0]) & (half == key[1])]
                sums[key] = sums.get(key, Moments.zero(width)) + Moments(len(part), part.sum(0), part.T @ part)
        yield record(sums)

    def add_sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield record(_total(r for batch in batches for r in batch.to_pylist()))

    parts = rows.select("good", "half", "features").mapInArrow(add_rows, schema)
    groups = max(1, math.isqrt(rows.rdd.getNumPartitions()))
    return _total(r.asDict() for r in parts.repartition(groups).mapInArrow(add_sums, schema).collect())


def _total(rows: Iterable[dict]) -> dict[tuple[bool, int], Moments]:
    """The sums of partial moments, added in an order of their own so that it does not depend on arrival."""
    sums: dict[tuple[bool, int], Moments] = {}
    for r in sorted(rows, key=lambda r: (r["good"], r["half"], r["n"], r["first"])):
        first, second = np.array(r["first"]), np.array(r["second"])
        part = Moments(r["n"], first, second.reshape(len(first), -1))
        key = r["good"], r["half"]
        sums[key] = sums[key] + part if key in sums else part
    return sums


def class_prior(rows: DataFrame, halves: dict[tuple[bool, int], Moments], mean: np.ndarray, scale: np.ndarray) -> float:
    """Share of good documents among the unlabelled, over all rows ``(good, half, features)``.

    Wherever a set of scores holds a share P of the positives and U of the unlabelled, the prior is at most
    U / P, with equality where no bad document falls. Sets are all above some score of a model that tells
    positives from unlabelled text; each half is scored by the model of the other one, as positives a
    model has seen score too well. The set is not the one of least U / P, which in small samples is a
    matter of luck, but the one whose U / P is least after the deviations of U and P (90 % sure) are added to U.
    """
    models = {}
    for half in (0, 1):
        if any(halves.get((good, h), Moments.zero(1)).n < 2 for good in (True, False) for h in (0, 1)):
            return 0.5
        models[half] = Model(mean, scale, fit(halves[True, half], halves[False, half], 0.5, non_negative=False))
    shares = []
    for half in (0, 1):
        bins = (
            scored(rows.filter(F.col("half") != half).select("good", "features"), models[half])
            .groupBy("good", F.least(F.floor(F.col("score") * _BINS), F.lit(_BINS - 1)).alias("b"))
            .agg(F.count(F.lit(1)).alias("n"))
            .collect()  # twice _BINS rows at most
        )
        counts = {good: np.zeros(_BINS) for good in (True, False)}
        for r in bins:
            counts[r["good"]][r["b"]] = r["n"]
        above = {good: np.cumsum(c[::-1])[::-1] / c.sum() for good, c in counts.items()}
        deviation = sum(np.sqrt(np.log(4 / 0.1) / (2 * c.sum())) for c in counts.values())
        usable = above[True] > 0
        u, p = above[False][usable], above[True][usable]
        best = np.argmin((u + 1.01 * deviation) / p)
        shares.append(u[best] / p[best])
    return float(np.clip(np.mean(shares), 0.02, 0.98))


def train(features: DataFrame, labels: DataFrame) -> Model:
    """The model from features of all documents and ``labels (doc_id, quality)``.

    Held-out labels are not read, and neither are labels of 0: every document that is no trusted positive is
    unlabelled. All rows enter the moments, the prior and the risk; nothing is sampled.
    """
    trusted = labels.filter((F.col("quality") == 1) & ~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("_id")).distinct()
    rows = staged(
        features.join(trusted, F.col("doc_id") == F.col("_id"), "left").select(
            F.col("_id").isNotNull().alias("good"), F.pmod(F.xxhash64("doc_id", "features"), F.lit(2)).cast("int").alias("half"),
            "features",
        ),
        "pu_rows",
    )
    width = len(FEATURES)
    sums = rows.agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("p"),
        *(F.avg(F.col("features")[i]).alias(f"m{i}") for i in range(width)),
        *(F.stddev_pop(F.col("features")[i]).alias(f"s{i}") for i in range(width)),
    ).first()
    mean = np.array([sums[f"m{i}"] or 0.0 for i in range(width)])
    scale = np.array([sums[f"s{i}"] or 0.0 for i in range(width)])
    scale[scale < 1e-9] = 1.0
    if not sums["p"] or sums["p"] == sums["n"]:
        return Model(mean, scale, np.zeros(1 + width + UNITS), 0.5 if not sums["p"] else 1.0)
    halves = moments(rows, mean, scale)
    prior = class_prior(rows, halves, mean, scale)
    whole = {good: sum((m for k, m in halves.items() if k[0] == good), Moments.zero(1 + width + UNITS)) for good in (True, False)}
    weights = fit(whole[True], whole[False], prior)
    return Model(mean, scale, weights, float((prior * whole[False].n + whole[True].n) / sums["n"]))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row.

    Null and empty texts get the score of zero features. Without positives, or with nothing but positives,
    nothing can be learnt, and every score is one half. Repeated rows are scored alike.
    """
    features = staged(measured(docs, id_col, text_col), "quality_features")
    model = train(features, labels)
    return scored(features, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, by the model learnt from these rows.

    The score is computed beside the row, so nothing is joined; columns may have any names.
    """
    model = train(staged(measured(docs, id_col, text_col), "quality_features"), labels)

    def make() -> Callable[[list[str]], list[bool]]:
        def good(texts: list[str]) -> list[bool]:
            x = np.array([features_of(t) for t in texts]).reshape(-1, len(FEATURES))
            return (model.scores(x) >= threshold).tolist()

        return good

    return kept_rows(docs, text_col, make)
