"""Token counts by rank-synchronous merging of ragged numpy arrays.

The symbols of many pre-tokens lie in one array. In each round every pre-token applies the pair
of its own lowest rank, all at once, until none has a pair left; what survives is counted. Pre-tokens
are cut where no piece of the vocabulary holds the two neighbouring characters, since no
merge can ever cross such a place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import each_block

_NONE = np.int64(1) << 40
_CACHE = 400_000
_SYMBOLS = 1 << 20  # symbols merged together
_SPACE = "▁"


class PieceCounter:
    """The merge table of a sentence-piece BPE model."""

    def __init__(self, path: str):
        import re

        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        ids = {
            model.id_to_piece(i): i
            for i in range(n)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        }
        chars = sorted({c for p in ids for c in p})
        symbols = dict(ids)
        for c in chars:
            symbols.setdefault(c, len(symbols) + n)
        self.width = n + len(symbols) + 1
        self.chars = {c: symbols[c] for c in chars}
        self.unknown = self.width - 1
        scores = sorted({model.get_score(i) for i in ids.values()}, reverse=True)
        order = {s: r for r, s in enumerate(scores)}
        keys, ranks, wholes = [], [], []
        for piece, i in ids.items():
            rank = order[model.get_score(i)]
            for cut in range(1, len(piece)):
                a, b = symbols.get(piece[:cut]), symbols.get(piece[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.width + b)
                    ranks.append(rank)
                    wholes.append(i)
        at = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[at]
        self.ranks = np.array(ranks, np.int64)[at]
        self.wholes = np.array(wholes, np.int64)[at]
        # a rank is tried again at once if its piece can form a pair of lower rank
        own = np.full(self.width, -1, np.int64)
        own[list(ids.values())] = [order[model.get_score(i)] for i in ids.values()]
        left, right = self.keys // self.width, self.keys % self.width
        eager = np.concatenate([own[left][self.ranks < own[left]], own[right][self.ranks < own[right]]])
        self.one_by_one = np.zeros(len(scores) + 1, bool)
        self.one_by_one[eager] = True
        doubled = self.ranks[np.isin(self.ranks, [r for r, c in zip(*np.unique(self._piece_ranks(ids, model, order), return_counts=True)) if c > 1])]
        self.one_by_one[doubled] = True
        # tokens that a lone symbol becomes: itself, or its bytes where it is no piece
        self.inside = {p[i : i + 2] for p in ids for i in range(len(p) - 1)}
        self.no_piece = {c for c in chars if c not in ids}
        breaks = "" if any("\n" in p for p in ids) else "\n"
        self._split = re.compile(rf"{_SPACE}*[^{_SPACE}{breaks}]+|{_SPACE}+" + (r"|\n" if breaks else "")).findall

    @staticmethod
    def _piece_ranks(ids: dict, model, order: dict) -> list[int]:
        return [order[model.get_score(i)] for i in ids.values()]

    def words(self, text: str) -> list[str]:
        """The coarse pre-tokens of a text: spaces and what follows them, line ends apart."""
        return self._split(_SPACE + text.replace(" ", _SPACE)) if text else []

    def count_words(self, words: Iterable[str]) -> dict[str, int]:
        """Tokens of distinct words, merged in batches of bounded size."""
        found: dict[str, int] = {}
        names, symbols, lengths, size = [], [], [], 0
        inside, chars, no_piece = self.inside, self.chars, self.no_piece
        for w in words:
            total, run, previous = 0, [], ""
            parts = []
            for c in w:
                symbol = chars.get(c)
                if previous and previous + c in inside:
                    run.append(symbol)
                else:
                    parts.append(run)
                    run = [] if symbol is None else [symbol]
                    if symbol is None:
                        total += len(c.encode("utf-8", "replace"))
                previous = "" if symbol is None else c
            parts.append(run)
            found[w] = total
            for p in parts:
                if len(p) == 1 and not no_piece:
                    found[w] += 1
                elif p:
                    names.append(w)
                    symbols += p
                    lengths.append(len(p))
                    size += len(p)
            if size >= _SYMBOLS:
                self._add(names, symbols, lengths, found)
                names, symbols, lengths, size = [], [], [], 0
        self._add(names, symbols, lengths, found)
        return found

    def _add(self, names: list[str], symbols: list[int], lengths: list[int], found: dict[str, int]) -> None:
        if names:
            for w, n in zip(names, self.merge(np.array(symbols, np.int64), np.array(lengths, np.int64)).tolist()):
                found[w] += n

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[at] == key
        return np.where(known, self.ranks[at], _NONE), self.wholes[at]

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Symbols that survive in each of the sequences of ``lengths`` laid end to end."""
        counts = np.zeros(len(lengths), np.int64)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        cost = np.ones(self.width, np.int64)
        for c in self.no_piece:
            cost[self.chars[c]] = len(c.encode())

        def pairs(s: np.ndarray, o: np.ndarray, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            j = np.minimum(i + 1, len(s) - 1)
            rank, whole = self._rank(s[i], s[j])
            rank[(j == i) | (o[i] != o[j])] = _NONE
            return rank, whole

        rank, whole = pairs(symbols, owner, np.arange(len(symbols)))
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(symbols)])
            best = np.minimum.reduceat(rank, starts)
            done = best == _NONE
            if done.any():
                gone = np.repeat(done, sizes)
                np.add.at(counts, owner[gone], cost[symbols[gone]])
                symbols, owner, rank, whole = symbols[~gone], owner[~gone], rank[~gone], whole[~gone]
                best, sizes = best[~done], sizes[~done]
                if not len(symbols):
                    break
                starts = np.r_[0, np.cumsum(sizes)[:-1]]
            hit = rank == np.repeat(best, sizes)
            # of touching pairs the first, third, … of a run merge
            index = np.arange(len(hit))
            begins = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], index, 0))
            hit &= (index - begins) % 2 == 0
            single = self.one_by_one[best]
            if single.any():
                at = np.flatnonzero(hit)
                first = np.zeros(len(hit), bool)
                first[at[np.r_[True, owner[at][1:] != owner[at][:-1]]]] = True
                hit &= first | ~np.repeat(single, sizes)
            at = np.flatnonzero(hit)
            symbols[at] = whole[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            changed = np.zeros(len(symbols), bool)
            changed[at] = True
            changed[at[at > 0] - 1] = True
            # where the symbol before was merged away, its pair belongs to the merged symbol before it
            before = at[at > 1]
            changed[before[~keep[before - 1]] - 2] = True
            symbols, owner, rank, whole, changed = symbols[keep], owner[keep], rank[keep], whole[keep], changed[keep]
            i = np.flatnonzero(changed)
            rank[i], whole[i] = pairs(symbols, owner, i)
        return counts

    def count(self, text: str) -> int:
        words = self.words(text)
        known = self.count_words(set(words))
        return sum(known[w] for w in words)


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row the id, bytes, tokens and whether these exceed ``limit``; a null text has none.

    Each row is counted on its own and whole; other columns are left out, so none can clash.
    """

    def make() -> Callable[[list[str]], dict[str, list]]:
        counter = PieceCounter(path)
        cache: dict[str, int] = {}

        def work(texts: list[str]) -> dict[str, list]:
            split = [counter.words(t) for t in texts]
            fresh = set().union(*split) - cache.keys()
            if len(cache) + len(fresh) > _CACHE:
                cache.clear()
                fresh = set().union(*split)
            cache.update(counter.count_words(fresh))
            n = [sum(map(cache.__getitem__, ws)) for ws in split]
            return {
                "n_bytes": [len(t.encode("utf-8", "replace")) for t in texts],
                "n_tokens": n,
                "over_limit": [x > limit for x in n],
            }

        return work

    return each_block(
        docs.select(id_col, F.col(text_col).alias("_text")), "_text", make,
        "n_bytes bigint, n_tokens bigint, over_limit boolean",
    )
