"""Byte-level BPE encoding and decoding by depth-first traversal of a trie of distinct words.

For every prefix of a word, the *last token* of its encoding determines the rest: the encoding is that
of the prefix without the token, and the token. A token can be last if it is a suffix of the prefix
and stays apart from the last token before it; exactly one is. So the traversal carries one token per
depth, and words that share a prefix share all work on it.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import each_block
from corpusmill.llm.ragged import Table, at_rows, distinct

# fixed value: the pattern that splits text before byte-level merges
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPLIT_ASCII = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"

_CACHE = 80 << 20  # bytes that a task remembers of the words it knows, and as many of stretches
_ENTRY = 220  # bytes that an entry takes besides its text and ids


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte: itself where printable, else the next free from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteBpe:
    """The vocabulary of a tokenizer file, with encoding and decoding."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()
        raw = {piece: bytes(alphabet[c] for c in piece) for piece in spec["model"]["vocab"] if all(c in alphabet for c in piece)}
        self.ids = {raw[p]: i for p, i in spec["model"]["vocab"].items() if p in raw}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for t in self.special:
            self.ids.pop(t.encode(), None)
        self.pieces = {i: b for b, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        # token of a byte string, or -1 where it only begins one
        self.known = {b[:n]: -1 for b in self.ids for n in range(1, len(b))} | self.ids
        self.rank = {i: -1 for i in self.ids.values()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[int, tuple[int, int]] = {}
        for n, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, whole = self.ids[raw[left]], self.ids[raw[right]], self.ids[raw[left] + raw[right]]
            self.merged[a << 32 | b] = (n, whole)
            self.rank[whole], self.parts[whole] = n, (a, b)
        self._apart: dict[int, bool] = {}
        self._alone: dict[int, bool] = {}
        self._split = regex.compile(SPLIT).findall
        self._split_ascii = re.compile(SPLIT_ASCII, re.ASCII).findall
        self._marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def words(self, text: str) -> list[str]:
        """The pre-tokens of a text; special tokens stand alone."""
        split = self._split_ascii if text.isascii() else self._split
        if self._marks is None or not any(t in text for t in self.special):
            return split(text)
        found: list[str] = []
        for i, part in enumerate(self._marks.split(text)):
            found += [part] if i % 2 else split(part)
        return found

    def stays_apart(self, left: int, right: int) -> bool:
        """Whether no merge crosses the boundary of two adjacent tokens.

        Undoes the merges beside the boundary, the latest first. The symbols that meet then would
        have merged if their rank is lower than that of the merge that took one of them away;
        at equal rank the one further left goes first.
        """
        key = left << 32 | right
        known = self._apart.get(key)
        if known is not None:
            return known
        rank, parts, merged = self.rank, self.parts, self.merged
        taken, by_right, apart = len(self.ids) + 1, False, True
        while True:
            m = merged.get(left << 32 | right)
            if m is not None and (m[0] < taken or (m[0] == taken and by_right)):
                apart = False
                break
            if rank[left] < 0 and rank[right] < 0:
                break
            if rank[left] > rank[right]:
                taken, by_right, left = rank[left], False, parts[left][1]
            else:
                taken, by_right, right = rank[right], True, parts[right][0]
        self._apart[key] = apart
        return apart

    def stands(self, token: int) -> bool:
        """Whether the bytes of a token encode to the token."""
        known = self._alone.get(token)
        if known is None:
            pair = self.parts.get(token)
            known = self._alone[token] = pair is None or (
                self.stands(pair[0]) and self.stands(pair[1]) and self._first_merge_is(token)
            )
        return known

    def _first_merge_is(self, token: int) -> bool:
        """Plain merging of the bytes of a token ends in that token."""
        symbols = [self.ids[bytes([b])] for b in self.pieces[token]]
        while len(symbols) > 1:
            ranked = [(self.merged.get(a << 32 | b, (1 << 60, 0)), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:]))]
            (n, whole), i = min(ranked, key=lambda x: (x[0][0], x[1]))
            if n == 1 << 60:
                return False
            symbols[i : i + 2] = [whole]
        return symbols == [token]

    def encode_words(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """Ids of distinct words."""
        special = [w for w in words if w in self.special]
        for w in special:
            yield w, [self.special[w]]
        for data, ids in self._walk(sorted(w.encode("utf-8", "replace") for w in words if w not in self.special)):
            yield data.decode("utf-8", "replace"), ids

    def _walk(self, words: list[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """Ids of words in the order of a depth-first traversal of their trie.

        Sorted words are a trie laid flat: each word hangs below its predecessor at the end of their common
        prefix. So the path from the root is kept with its states, cut back to that depth, and
        only the nodes below it are new: no prefix that words share is computed twice.
        """
        known, apart, stands, test = self.known.get, self._apart.get, self.stands, self.stays_apart
        last = [-1]  # last token of the encoding of the path, at each depth
        size = [0]  # its length
        reach = [0]  # length of the longest suffix of the path that some token begins with
        before = b""
        for w in words:
            depth, most = 0, min(len(w), len(before))
            while depth < most and w[depth] == before[depth]:
                depth += 1
            del last[depth + 1 :], size[depth + 1 :], reach[depth + 1 :]
            for end in range(depth + 1, len(w) + 1):
                n = reach[-1] + 1
                token = known(w[end - n : end])
                while token is None:
                    n -= 1
                    token = known(w[end - n : end])
                reach.append(n)
                while True:
                    if token is not None and token >= 0:
                        if n == end:
                            if stands(token):
                                break
                        else:
                            left = last[end - n]
                            free = apart(left << 32 | token)
                            if test(left, token) if free is None else free:
                                break
                    n -= 1
                    token = known(w[end - n : end])
                last.append(token)
                size.append(n)
            ids, at = [], len(w)
            while at:
                ids.append(last[at])
                at -= size[at]
            ids.reverse()
            before = w
            yield w, ids

    def encode(self, text: str) -> list[int]:
        words = self.words(text)
        known = dict(self.encode_words(set(words)))
        return [i for w in words for i in known[w]]

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(self.pieces[i] for i in ids).decode("utf-8", "replace")


_APART = "\x00"


class _Coder:
    """Ids of blocks of texts, and what these decode to; words met before are remembered.

    No token goes beyond a space that ends white space or begins it. So Arrow cuts texts ahead of each
    space and finds the different stretches, and only these are split and encoded. Texts with a space
    inside of white space, special tokens or NUL are taken whole.
    """

    def __init__(self, path: str):
        self.bpe = ByteBpe(path)
        self.words: dict[str, bytes] = {}
        self.stretches: dict[str, bytes] = {}
        self.held = [0, 0]  # bytes in both
        self.inner_space = re.compile(r"[^\S ] [^\S ]").search
        n = max(self.bpe.pieces) + 1
        self.numbers = Table([f"{i},".encode() for i in range(n)], "u1")
        self.pieces = Table([self.bpe.pieces.get(i, b"") for i in range(n)], "u1")

    def _learn(self, stretches: list[str]) -> None:
        if self.held[0] > _CACHE:
            self.words.clear()
            self.held[0] = 0
        split = [self.bpe.words(x) for x in stretches]
        fresh = set().union(*split).difference(self.words)
        for w, ids in self.bpe.encode_words(fresh):
            self.words[w] = array("I", ids).tobytes()
            self.held[0] += _ENTRY + len(w) + 4 * len(ids)
        known = self.words.__getitem__
        for x, ws in zip(stretches, split):
            self.stretches[x] = ids = known(ws[0]) if len(ws) == 1 else b"".join(map(known, ws))
            self.held[1] += _ENTRY + len(x) + len(ids)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the offsets of the texts in them."""
        whole = [i for i, t in enumerate(texts) if "  " in t or "<|" in t or _APART in t or self.inner_space(t)]
        column = list(texts)
        for i in whole:
            column[i] = ""
        cut = pc.split_pattern(pc.replace_substring(pa.array(column, pa.string()), " ", _APART + " "), _APART)
        found, index, offsets = distinct(cut)
        index = index.copy()
        index[offsets[whole]] = len(found) + np.arange(len(whole))
        found += [texts[i] for i in whole]
        if self.held[1] > _CACHE:
            self.stretches.clear()
            self.held[1] = 0
        self._learn([x for x in found if x not in self.stretches])
        flat, ends = Table([self.stretches[x] for x in found], "<u4").take(index)
        return flat, at_rows(ends, offsets)

    def rendered(self, ids: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
        """For each text its ids in decimal with a comma after each, and the bytes they decode to."""
        decimal, d_ends = self.numbers.take(ids)
        decoded, p_ends = self.pieces.take(ids)
        d, p = (at_rows(e, offsets).tolist() for e in (d_ends, p_ends))
        decimal, decoded = decimal.tobytes(), decoded.tobytes()
        for i in range(len(offsets) - 1):
            yield decimal[d[i] : d[i + 1]], decoded[p[i] : p[i + 1]]


def encode_table(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every text (``array<int>``) beside its id; null and empty texts have none."""

    def columns() -> Callable[[list[str]], dict[str, list]]:
        code = _Coder(path)

        def run(texts: list[str]) -> dict[str, list]:
            flat, offsets = code.ids(texts)
            return {"ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.astype(np.int32)))}

        return run

    return each_block(docs.select(id_col, F.col(text_col).alias("_text")), "_text", columns, "ids array<int>")


def decode_table(tokens: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Text of every row of ids, beside the other columns; a null row decodes to the empty text."""
    kept = [c for c in tokens.columns if c != ids_col]
    schema = tokens.select(*kept, F.lit("").alias("text")).schema

    def run(batches):
        bpe = ByteBpe(path)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            texts = pa.array([bpe.decode(x or ()) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in kept), texts], names=[*kept, "text"]
            )

    return tokens.mapInArrow(run, schema)


def code_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes every text; per row the id, number of tokens, and digests of ids and text.

    The text decoded is that of the ids. A null text is empty: no token, digests of nothing.
    Rows are independent, so repeated ones give repeated results; other columns are left out.
    """

    def columns() -> Callable[[list[str]], dict[str, list]]:
        code = _Coder(path)

        def run(texts: list[str]) -> dict[str, list]:
            ids, decoded = [], []
            flat, offsets = code.ids(texts)
            n = np.diff(offsets).tolist()
            for joined, data in code.rendered(flat, offsets):
                ids.append(hashlib.sha256(joined[:-1]).hexdigest())
                text = data.decode("utf-8", "replace")
                decoded.append(hashlib.sha256(text.encode("utf-8", "replace")).hexdigest())
            return {"n_tokens": n, "ids_sha256": ids, "decoded_sha256": decoded}

        return run

    return each_block(
        docs.select(id_col, F.col(text_col).alias("_text")), "_text", columns,
        "n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    )
