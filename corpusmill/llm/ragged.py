"""Stretches of text as Arrow arrays, and lists of different lengths laid end to end in numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


class Table:
    """Lists of numbers or bytes, to be put together again by their index."""

    def __init__(self, entries: list[bytes], kind: str):
        self.data = np.frombuffer(b"".join(entries), kind)
        width = np.dtype(kind).itemsize
        self.sizes = np.fromiter(map(len, entries), np.int64, len(entries)) // width
        self.starts = np.cumsum(self.sizes) - self.sizes

    def take(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entries at ``index`` end to end, and where each ends."""
        sizes = self.sizes[index]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.starts[index] - (ends - sizes), sizes)
        return self.data[at], ends


def at_rows(ends: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where rows begin and end in the flat data, from where their items end and the offsets of the items."""
    return np.r_[0, ends][offsets]


def distinct(lists: pa.ListArray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The different strings of a list array, the index of each item among them, and the offsets of the rows."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), offsets - offsets[0]
