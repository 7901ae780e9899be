"""Toxicity by a weighted finite-state grammar over the clauses of a text.

Words become symbols: insult, threat, target, negation, mark of reported speech, anything else. Five small
transducers rewrite them one after the other and are composed into one machine: what follows a report or stands
in quotes becomes reported, what closely follows a negation becomes negated, what is near a target becomes
targeted; insults so marked come out as they are, threats by whether a target follows. The machine runs over each
clause that holds an insult or a threat, and its outputs are what is scored: an isolated word has no score.

Which words, and which beginnings of words, are insults besides a short list, and how heavy each is, is learnt
from labelled texts; so are the weights of the outputs.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import blocks, each_block, spare_collector, staged

SAMPLE = 10_000  # labelled documents that the lexicon and the weights are learnt from, at most
ENTRIES = 4_000  # learnt words and beginnings, at most
LENGTHS = range(3, 9)  # of beginnings of words
_LEAST_DOCS = 4  # toxic documents that an entry must occur in
_LEAST_WEIGHT = 1.2
_LEAST_EVIDENCE = 15.0  # likelihood ratio statistic
_GIVEN = 4.0  # weight of a listed insult or threat
_CACHE = 200_000  # words whose symbol a task remembers

# fixed values: words of the grammar in English, German, French and Spanish
INSULTS = (
    "idiot idiots moron morons imbecile fool fools stupid dumb loser losers trash scum pathetic worthless disgusting clown "
    "jerk vermin filth garbage trottel dumm dummkopf abschaum crétin abruti débile ordure estúpido imbécil basura escoria"
).split()
THREATS = (
    "kill hurt beat shoot stab burn destroy punish strangle töten umbringen verprügeln erschießen tuer frapper massacrer "
    "matar golpear quemar"
).split()
TARGETS = "you your yours yourself u ya du dich dir euch ihr tu toi te vous usted ustedes tú ti vosotros".split()
NEGATIONS = "not no never without nobody isn't aren't don't won't nicht kein keine niemals ohne pas jamais sans nunca sin".split()
REPORTS = (
    "said says called wrote claimed claims quoted quote allegedly reportedly sagte sagt nannte schrieb angeblich disait "
    "déclaré écrit dijo dice llamó escribió"
).split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE = "o i t g n r q".split()
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[\"“”„«»]|[.!?;:\n]+").findall
_QUOTES = frozenset("\"“”„«»")
_ENDS = frozenset(".!?;:\n")


@dataclass(frozen=True)
class Transducer:
    """A machine ``step(state, symbol) -> (state, output)``, total over the symbols it reads."""

    start: object
    step: Callable[[object, str], tuple[object, str]]

    def then(self, other: Transducer) -> Transducer:
        """The composition: ``other`` reads what this one writes."""

        def step(state: tuple, symbol: str) -> tuple[tuple, str]:
            first, written = self.step(state[0], symbol)
            second, out = other.step(state[1], written)
            return (first, second), out

        return Transducer((self.start, other.start), step)


def within(mark: str, reach: int, changed: dict[str, str], drops: bool) -> Transducer:
    """Rewrites symbols as ``changed`` says in the ``reach`` symbols after each ``mark``; ``drops`` it from what is written."""

    def step(left: int, symbol: str) -> tuple[int, str]:
        if symbol == mark:
            return reach, OTHER if drops else mark
        return max(0, left - 1), changed.get(symbol, symbol) if left else symbol

    return Transducer(0, step)


def _reported() -> Transducer:
    """Insults and threats after a report, or between quotes, become reported; the rest of a clause is."""

    def step(state: tuple[bool, bool], symbol: str) -> tuple[tuple[bool, bool], str]:
        told, quoted = state
        if symbol == REPORT:
            return (True, quoted), OTHER
        if symbol == QUOTE:
            return (told, not quoted), OTHER
        return state, "reported " + symbol if symbol in (INSULT, THREAT) and (told or quoted) else symbol

    return Transducer((False, False), step)


def _insults() -> Transducer:
    """Writes insults as they are marked, and a second time as aimed where a target follows closely."""

    def step(left: int, symbol: str) -> tuple[int, str]:
        if symbol == INSULT:
            return 3, "plain"
        if symbol == TARGET and left:
            return 0, "aimed"
        kept = symbol in ("targeted i", "negated i", "reported i", TARGET) or symbol.endswith(THREAT)
        return max(0, left - 1), symbol if kept else OTHER

    return Transducer(0, step)


def _threats() -> Transducer:
    """Writes threats as they are marked, those that a target follows within four symbols as aimed threats."""

    def step(left: int, symbol: str) -> tuple[int, str]:
        if symbol in (THREAT, "targeted t"):
            return 4, "threat"
        if symbol in (TARGET, "aimed") and left:
            return 0, "aimed threat"
        return max(0, left - 1), OTHER if symbol == TARGET else symbol

    return Transducer(0, step)


OUTPUTS = ("plain", "targeted i", "negated i", "reported i", "aimed", "threat", "aimed threat", "negated t", "reported t")
_WEIGHTLESS = frozenset(("aimed", "aimed threat"))  # they stress the match before them


def grammar() -> Transducer:
    """All five transducers in one."""
    negated = within(NEGATION, 3, {INSULT: "negated i", THREAT: "negated t"}, drops=True)
    targeted = within(TARGET, 4, {INSULT: "targeted i", THREAT: "targeted t"}, drops=False)
    return _reported().then(negated).then(targeted).then(_insults()).then(_threats())


class Machine:
    """The grammar as tables: states are numbers, and runs of other words are one step."""

    RUN = 5  # after so many other words in a row, nothing that is near counts any more

    def __init__(self) -> None:
        machine, self.symbols = grammar(), (INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE)
        number, todo = {machine.start: 0}, [machine.start]
        self.next: list[dict[str, tuple[int, str]]] = []
        while todo:
            state = todo.pop(0)
            row = {}
            for s in (OTHER, *self.symbols):
                to, out = machine.step(state, s)
                if to not in number:
                    number[to] = len(number)
                    todo.append(to)
                row[s] = number[to], out
            self.next.append(row)

    def run(self, clause: list[tuple[int, str, float]]) -> list[tuple[str, float]]:
        """Outputs and weights for the symbols ``(place, symbol, weight)`` of a clause that are not other words."""
        state, before, found, last = 0, -1, [], 0.0
        for place, symbol, weight in clause:
            for _ in range(min(place - before - 1, self.RUN)):
                state = self.next[state][OTHER][0]
            state, out = self.next[state][symbol]
            if out != OTHER:
                last = last if out in _WEIGHTLESS else weight
                found.append((out, last))
            before = place
        return found


@dataclass(frozen=True)
class Model:
    """Weights of learnt words and beginnings (a word ends in ``$``), and of the features of a text."""

    lexicon: dict[str, float]
    weights: np.ndarray


class Reader:
    """Turns texts into features, with the symbols of words remembered."""

    def __init__(self, lexicon: dict[str, float]):
        self.machine, self.lexicon = Machine(), lexicon
        self.given = {w: (k, _GIVEN) for k, words in ((INSULT, INSULTS), (THREAT, THREATS)) for w in words}
        self.given |= {w: (k, 0.0) for k, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in words}
        self.given |= {q: (QUOTE, 0.0) for q in _QUOTES}
        self.known: dict[str, tuple[str, float] | None] = {}

    def symbol(self, word: str) -> tuple[str, float] | None:
        """Symbol and weight of a word: of the list, as a whole, or of its longest beginning that was learnt; None for others."""
        if word[0] in _ENDS:
            return ".", 0.0
        if word in self.given:
            return self.given[word]
        for entry in (word + "$", *(word[:k] for k in reversed(LENGTHS) if k <= len(word))):
            if entry in self.lexicon:
                return INSULT, self.lexicon[entry]
        return None

    def matches(self, text: str) -> Iterator[list[tuple[str, float]]]:
        """The outputs of every clause that has some."""
        words = _TOKEN(text.lower())
        known = self.known
        if len(known) > _CACHE:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self.symbol(w)
        clause: list[tuple[int, str, float]] = []
        matched = False
        for place, found in enumerate([known[w] for w in words]):
            if found is None:
                continue
            if found[0] == ".":
                if matched:
                    yield self.machine.run(clause)
                clause, matched = [], False
            else:
                clause.append((place, *found))
                matched = matched or found[0] in (INSULT, THREAT)
        if matched:
            yield self.machine.run(clause)

    def features(self, text: str) -> list[float]:
        """Of the outputs of all clauses: the weight of each kind, the heaviest clause, clauses matched, and rates by length."""
        total, heaviest, clauses, count = dict.fromkeys(OUTPUTS, 0.0), 0.0, 0, 0
        for outputs in self.matches(text):
            weight = sum(w for _, w in outputs)
            heaviest, clauses, count = max(heaviest, weight), clauses + 1, count + len(outputs)
            for out, w in outputs:
                total[out] += w
        n = len(text) / 6 + 1
        size, whole = math.log(n), sum(total.values())
        return [1.0, *(math.log1p(total[o]) for o in OUTPUTS), math.log1p(whole), min(100 * whole / n, 20.0) / 5, min(heaviest, 20.0) / 4,
                math.log1p(clauses), math.log1p(count) * size / 8, size / 4]


# what the weights are before any label is seen: the constant, each kind of output, then the totals and lengths
_PRIOR = np.array([-3.0, 0.6, 0.9, 0.0, 0.0, 0.3, 0.2, 0.9, 0.0, 0.0, 0.8, 0.4, 0.2, 0.2, 0.0, -0.4])


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, toxic: np.ndarray, strength: float = 1.0) -> np.ndarray:
    """Logistic weights, held near those assumed without labels."""
    w = _PRIOR.copy()
    for _ in range(60):
        p = _logistic(x @ w)
        gradient = x.T @ (p - toxic) + strength * (w - _PRIOR)
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + strength * np.eye(len(w)), gradient)
        w = w - step * min(1.0, 3.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-10:
            break
    return w


def held_out(doc_id: Column) -> Column:
    """Whether a document is left out of training: crc32 of its id as text leaves 1 when divided by three; a null id is."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(text, toxic)`` of at most ``sample`` labelled documents outside of the held-out part, those of least hash of their ids.

    An id is one document here, whichever of its texts; one with several labels is toxic if any says so.
    """
    known = labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # the bound is one on rows of ids and labels, so these can be broadcast
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select(F.col("doc_id").alias("_id"), (F.col("toxic") == 1).alias("toxic"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    met = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    return staged(met.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic"), "toxic_sample")


def learn_lexicon(rows: DataFrame, entries: int = ENTRIES) -> dict[str, float]:
    """Weights of words and beginnings that toxic texts have more often than others, from ``(text, toxic)``.

    The weight is the logarithm of the ratio of their rates among the different words of toxic and of other texts.
    Tasks count, counts are combined by a shuffle, and only the strongest entries reach the driver.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spare_collector()
        docs: Counter = Counter()
        found: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for part, texts in blocks(batch, 0):
                for text, toxic in zip(texts, part.column(1).to_pylist()):
                    words = {w for w in _TOKEN(text.lower()) if w[0] not in _ENDS and w[0] not in _QUOTES}
                    here = Counter(w[:k] for w in words for k in LENGTHS if k <= len(w))
                    here.update(w + "$" for w in words)
                    here[""] = len(words)
                    found[toxic].update(here)
                    if toxic:
                        docs.update(here.keys())
        names = list(found[0].keys() | found[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *(pa.array([c[x] for x in names], pa.int64()) for c in (*found, docs))],
            names=["entry", "other", "toxic", "docs"],
        )

    counts = staged(
        rows.select("text", "toxic").mapInArrow(count, "entry string, other bigint, toxic bigint, docs bigint")
        .groupBy("entry").agg(*(F.sum(c).alias(c) for c in ("other", "toxic", "docs"))).filter(f"docs >= {_LEAST_DOCS} OR entry = ''"),
        "entries",
    )
    whole = counts.filter("entry = ''").first()
    if whole is None or not whole["toxic"] or not whole["other"]:
        return {}
    a, b = float(whole["toxic"]), float(whole["other"])
    x, z = F.col("toxic").cast("double"), F.col("other").cast("double")
    share = F.lit(a / (a + b))
    evidence = 2 * (x * F.log(x / ((x + z) * share)) + F.when(z > 0, z * F.log(z / ((x + z) * (1 - share)))).otherwise(0.0))
    weight = F.log((x + 0.5) / (a + 1)) - F.log((z + 0.5) / (b + 1))
    best = (
        counts.filter("entry <> '' AND toxic > 0").select("entry", weight.alias("weight"), evidence.alias("evidence"))
        .filter((F.col("weight") > _LEAST_WEIGHT) & (F.col("evidence") > _LEAST_EVIDENCE))
        .orderBy(F.desc("evidence"), "entry").limit(entries)
    )
    return {r["entry"]: r["weight"] for r in best.collect()}


def _measured(rows: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """``rows (text, …)`` with the features in place of the text."""

    def make() -> Callable[[list[str]], dict[str, list]]:
        reader = Reader(lexicon)
        return lambda texts: {"features": [reader.features(t) for t in texts]}

    return each_block(rows, "text", make, "features array<double>")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model from at most ``sample`` labelled documents; without both kinds among them, the one assumed before."""
    rows = labelled(docs, labels, sample, id_col, text_col)
    lexicon = learn_lexicon(rows)
    seen = sorted((r["toxic"], r["features"]) for r in _measured(rows, lexicon).collect())  # ``sample`` rows at most
    toxic = np.array([t for t, _ in seen], float)
    if not toxic.any() or toxic.all():
        return Model(lexicon, _PRIOR)
    return Model(lexicon, fit(np.array([f for _, f in seen]), toxic))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = SAMPLE, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row, judged by its whole text alone.

    Null and empty texts have no clause and get the score of that. Repeated rows are scored alike; other
    columns are left out. Without labels the listed words and assumed weights decide.
    """
    model = train(docs, labels, sample, id_col, text_col)

    def make() -> Callable[[list[str]], dict[str, list]]:
        reader = Reader(model.lexicon)

        def work(texts: list[str]) -> dict[str, list]:
            x = np.array([reader.features(t) for t in texts]).reshape(-1, len(model.weights))
            return {"score": _logistic(x @ model.weights).tolist()}

        return work

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    return each_block(rows, "_text", make, "score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")
    )


def matched_clauses(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and, for each clause with a match, its outputs and their weights."""

    def make() -> Callable[[list[str]], dict[str, list]]:
        reader = Reader(model.lexicon)
        return lambda texts: {"clauses": [[[{"output": o, "weight": w} for o, w in c] for c in reader.matches(t)] for t in texts]}

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    return each_block(rows, "_text", make, "clauses array<array<struct<output:string,weight:double>>>")
