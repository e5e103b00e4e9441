"""Texts as codes of their distinct pieces, in Arrow and numpy.

Tokenizers never join characters over a single space, so a text is the row of its pieces
and each distinct piece has to be looked at once.  A batch of texts is cut and coded in
Arrow, a bounded memory holds what is known of the pieces met, and results of whole texts
are gathered from those of their pieces.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text and rows that are worked on at once.
BATCH_BYTES = 8 << 20
BATCH_ROWS = 8192
#: Characters of the longest piece that is remembered.
LONG = 100


def batches(batch: pa.RecordBatch, text: int, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``limit`` bytes of text, or of one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, low = np.cumsum(sizes), 0
    while low < len(sizes):
        before = ends[low - 1] if low else 0
        high = int(np.searchsorted(ends, before + limit, "right"))
        high = max(low + 1, min(high, low + BATCH_ROWS))
        yield batch.slice(low, high - low)
        low = high


def coded(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Codes of all pieces one after another, where each text starts (the end last), and
    the distinct pieces."""
    starts = np.asarray(lists.offsets).astype(np.int64)
    flat = lists.values.slice(starts[0], starts[-1] - starts[0]).dictionary_encode()
    return np.asarray(flat.indices).astype(np.int64), starts - starts[0], flat.dictionary.to_pylist()


class Known:
    """What ``learn`` finds for pieces, kept for those met lately."""

    def __init__(self, learn: Callable[[list[str]], list], remembered: int):
        self.learn, self.remembered = learn, remembered
        self.now: dict = {}
        self.older: dict = {}

    def of(self, pieces: list[str]) -> list:
        if len(self.now) > self.remembered // 2:
            # pieces that come again are taken over, the others go with the next turn
            self.older, self.now = self.now, {}
        new = [p for p in pieces if p not in self.now]
        if not new:
            return list(map(self.now.__getitem__, pieces))
        found = {p: self.older[p] for p in new if p in self.older}
        if len(found) < len(new):
            new = [p for p in new if p not in found]
            found.update(zip(new, self.learn(new)))
        # whole texts and other long pieces hardly come again
        self.now.update((p, x) for p, x in found.items() if len(p) <= LONG)
        return [found[p] if p in found else self.now[p] for p in pieces]


def flat(parts: list[bytes], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Packed numbers of all parts one after another, and how many each has."""
    each = np.dtype(kind).itemsize
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // each
    return np.frombuffer(b"".join(parts), kind), sizes


def places(sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the numbers of the coded parts stand in the flat array, one after another,
    and how many each code has."""
    starts = np.cumsum(sizes) - sizes
    many = sizes[codes]
    ends = np.cumsum(many)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts[codes] - (ends - many), many), many


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values`` from each start to the next."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[starts[1:]] - total[starts[:-1]]
