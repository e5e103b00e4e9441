"""Best-fit packing of tokenized documents by exact-complement hashing.

1. Documents are encoded and cut into pieces of at most ``capacity`` tokens; the pieces
   are stored with their lengths.
2. Only the number of pieces of each length comes to the driver: at most ``capacity``
   numbers, whatever the corpus.  ``plan`` fills sequences by length classes: sums of one,
   two and three lengths are kept in a hash index, a gap is filled by a combination that
   is still available and fills it exactly, and each filling is used as often as the
   counts allow.  Where no combination fits the gap, the longest piece that fits goes in
   and the smaller gap is tried.  What never fills a sequence exactly is placed best-fit,
   longest first, into the sequence with the smallest gap that takes it.
3. Pieces of one length are exchangeable.  Each gets its number among those of its length
   (counted inside the stored partitions, plus the counts of the partitions before), and
   the plan says for ranges of these numbers which sequence and offset they have.

A length that a third of all pieces share is numbered in as many tasks as hold it.

Defined results: a missing text is empty and is one piece of the end id alone; a missing
or repeated document id is a document of its own for every row; an empty table has no
pieces; other columns are not looked at.  Sequences are numbered from 0.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeframe.runtime import materialize, small_rows

from .pieces import Known, batches, coded, flat, places
from .text import whole

CAPACITY = 4096
#: Distinct words a worker remembers; a matter of memory only.
REMEMBERED = 400_000


#: Words of Latin letters (without U+0130, of which lower case is two characters), perhaps
#: with ASCII marks after them: one token of the word's end for the letters, one for the marks.
PLAIN = r"^[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{17f}]+[!-&(-/:-@\[-`{-~]*$"
#: How a token at the end of a word is written (fixed value).
WORD_END = "</w>"


class WordEncoder:
    """A tokenizer file that drops white space, over distinct words."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True

    def _one_by_one(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [array("i", e.ids).tobytes() for e in found]

    def _together(self, words: list[str], ends: np.ndarray) -> list[bytes]:
        """Plain words in one call, of which the number of end tokens is known."""
        found = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids
        ids = np.array(found, np.int32)
        stops = np.flatnonzero(self.is_end[ids]) + 1
        if len(stops) != ends.sum():
            return self._one_by_one(words)
        cuts = (4 * np.concatenate([[0], stops[np.cumsum(ends) - 1]])).tolist()
        packed = ids.tobytes()
        return [packed[i:j] for i, j in zip(cuts, cuts[1:])]

    def ids(self, words: list[str]) -> list[bytes]:
        column = pa.array(words, pa.string())
        plain = np.asarray(pc.match_substring_regex(column, PLAIN).to_numpy(zero_copy_only=False))
        marks = np.asarray(pc.match_substring_regex(column, r"[!-/:-@\[-`{-~]$").to_numpy(zero_copy_only=False))
        out: list[bytes] = [b""] * len(words)
        at = np.flatnonzero(plain)
        for low in range(0, len(at), 2000):
            some = at[low : low + 2000]
            packed = self._together([words[i] for i in some.tolist()], 1 + marks[some].astype(np.int64))
            for i, ids in zip(some.tolist(), packed):
                out[i] = ids
        rest = np.flatnonzero(~plain).tolist()
        for i, ids in zip(rest, self._one_by_one([words[i] for i in rest])):
            out[i] = ids
        return out


@lru_cache(maxsize=1)
def _known(path: str) -> Known:
    return Known(WordEncoder(path).ids, REMEMBERED)


def encode_words(column: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, ``end_id`` after each, and where each starts.
    For tokenizers that drop white space: words are encoded one by one."""
    for white in "\t\n\x0b\x0c\r":
        column = pc.replace_substring(column, white, " ")
    codes, starts, distinct = coded(pc.split_pattern(column, " "))
    ids, sizes = flat([*_known(path).of(distinct), np.int32(end_id).tobytes()], np.int32)
    codes = np.insert(codes, starts[1:], len(distinct))
    starts = starts + np.arange(len(starts))
    at, many = places(sizes, codes)
    ends = np.concatenate([[0], np.cumsum(many)])
    return ids[at], ends[starts]


def encode_pieces(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY, end_id: int = 1, keep_ids: bool = True,
) -> DataFrame:
    """``key, piece, start, length, ids_crc32`` and, if kept, ``ids`` of all pieces of the
    documents.  ``tokenizer`` is a tokenizer file that every executor has and that drops
    white space."""

    def cut(rows):
        for whole_batch in rows:
            for batch in batches(whole_batch, 1):
                ids, starts = encode_words(batch.column(1), tokenizer, end_id)
                sizes = np.diff(starts)
                many = -(-sizes // capacity)
                owner = np.repeat(np.arange(len(many)), many)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
                start = piece * capacity
                length = np.minimum(sizes[owner] - start, capacity)
                at = starts[owner] + start
                packed = memoryview(np.ascontiguousarray(ids, "<i4")).cast("B")
                crc = [zlib.crc32(packed[4 * i : 4 * (i + n)]) for i, n in zip(at.tolist(), length.tolist())]
                columns = {
                    "key": batch.column(0).take(pa.array(owner)), "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
                if keep_ids:
                    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
                yield pa.RecordBatch.from_pydict(columns)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    rows = docs.select(F.col(key).alias("key"), whole(F.col(text)).alias("text"))
    return rows.mapInArrow(cut, schema).withColumnRenamed("key", key)


class Complements:
    """Combinations of one, two or three available lengths by their sum."""

    def __init__(self, left: np.ndarray):
        self.left = left
        self.index: dict[tuple[int, int], tuple[int, ...]] = {}

    def _available(self, lengths: tuple[int, ...]) -> bool:
        return all(self.left[n] >= m for n, m in Counter(lengths).items())

    def pair(self, total: int) -> tuple[int, int] | None:
        """Two available lengths that add up to ``total``, the longer first; a found pair
        is kept until its lengths are used up."""
        kept = self.index.get((total, 2))
        if kept and self._available(kept):
            return kept
        half = np.arange(1, total // 2 + 1)
        both = np.flatnonzero((self.left[half] > 0) & (self.left[total - half] > (total == 2 * half)))
        if not len(both):
            return None
        self.index[total, 2] = (total - int(half[both[0]]), int(half[both[0]]))
        return self.index[total, 2]

    def triple(self, total: int) -> tuple[int, int, int] | None:
        """As ``pair`` for three lengths."""
        kept = self.index.get((total, 3))
        if kept and self._available(kept):
            return kept
        longest = np.arange(max(total - 2, 0), -(-total // 3) - 1, -1)
        for n in longest[self.left[longest] > 0].tolist():
            self.left[n] -= 1
            rest = self.pair(total - n)
            self.left[n] += 1
            if rest:
                self.index[total, 3] = (n, *rest)
                return self.index[total, 3]
        return None

    def filling(self, gap: int) -> tuple[int, ...] | None:
        """One, two or three lengths that fill the gap exactly."""
        if gap < 1:
            return None
        if self.left[gap]:
            return (gap,)
        return self.pair(gap) or self.triple(gap)


def _filled(left: np.ndarray, index: Complements, top: int, capacity: int) -> tuple[Counter, int]:
    """Lengths, ``top`` among them, that fill a sequence, and the gap that is left where
    they can't do so exactly."""
    pattern, gap = [top], capacity - top
    left[top] -= 1
    while gap:
        found = index.filling(gap)
        if found is None:
            fits = np.flatnonzero(left[1 : gap + 1])
            if not len(fits):
                break
            found = (int(fits[-1]) + 1,)
        for n in found:
            left[n] -= 1
        pattern.extend(found)
        gap -= sum(found)
    for n in pattern:
        left[n] += 1
    return Counter(pattern), gap


def _plan(counts: dict[int, int], capacity: int, put_off: bool) -> list[tuple[dict[int, int], int]]:
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    index, fillings = Complements(left), []
    for top in range(capacity, 0, -1):
        while left[top]:
            pattern, gap = _filled(left, index, top, capacity)
            if gap and put_off:
                break
            many = min(int(left[n]) // m for n, m in pattern.items())
            for n, m in pattern.items():
                left[n] -= many * m
            fillings.append((dict(pattern), many))
    return fillings + _best_fit({n: int(left[n]) for n in np.flatnonzero(left).tolist()}, capacity)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Fillings ``{length: how many}`` and the number of sequences that have each.

    Lengths that can't fill a sequence exactly are put off to the end, where the best fit
    is taken; or, if that takes fewer sequences, get the longest pieces that fit at once.
    """
    both = [_plan(counts, capacity, put_off) for put_off in (True, False)]
    return min(both, key=lambda fillings: sum(many for _, many in fillings))


def _best_fit(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Longest first, each into an open sequence with the smallest gap that takes it;
    sequences that hold the same lengths are handled together."""
    open_at: dict[int, list[tuple[Counter, int]]] = {}  # by gap

    def put(pattern: Counter, many: int, length: int, each: int) -> None:
        filled = pattern + Counter({length: each})
        gap = capacity - sum(n * m for n, m in filled.items())
        open_at.setdefault(gap, []).append((filled, many))

    for length in sorted(counts, reverse=True):
        todo = counts[length]
        while todo:
            gap = min((g for g in open_at if g >= length), default=None)
            if gap is None:
                each = min(capacity // length, todo)
                many = todo // each
                put(Counter(), many, length, each)
                todo -= many * each
                continue
            pattern, many = open_at[gap].pop()
            if not open_at[gap]:
                del open_at[gap]
            # the same sequence stays the best one until it takes no more
            each = min(gap // length, todo)
            used = min(many, todo // each)
            if used < many:
                open_at.setdefault(gap, []).append((pattern, many - used))
            put(pattern, used, length, each)
            todo -= used * each
    return [(dict(p), n) for group in open_at.values() for p, n in group]


def slots(fillings: list[tuple[dict[int, int], int]], capacity: int = CAPACITY) -> np.ndarray:
    """The plan by piece numbers: rows ``(first, sequence, each, offset, length)``, sorted.
    Pieces are numbered by length and inside a length; from ``first`` to that of the next
    row, each sequence from ``sequence`` on takes ``each`` of them, from ``offset`` on."""
    total = np.zeros(capacity + 2, np.int64)
    for pattern, many in fillings:
        for n, m in pattern.items():
            total[n + 1] += many * m
    first = np.cumsum(total)  # pieces that are shorter
    rows, sequence = [], 0
    for pattern, many in fillings:
        offset = 0
        for n, m in sorted(pattern.items(), reverse=True):
            rows.append((first[n], sequence, m, offset, n))
            first[n] += many * m
            offset += n * m
        sequence += many
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with ``length`` from 1 to ``capacity``, with the ``sequence_id`` and the
    ``offset`` that they get; other columns stay.  ``pieces`` is stored first."""
    stored = materialize(pieces.withColumn("__at", F.monotonically_increasing_id()))
    stored = stored.withColumn("__part", F.shiftright("__at", 33))
    counts = stored.groupBy("length").agg(F.count("*").alias("n"))
    # one number for each length
    held = {r["length"]: r["n"] for r in small_rows(counts, "lengths", capacity)}
    if any(not 1 <= n <= capacity for n in held):
        raise ValueError(f"a piece has no length from 1 to {capacity}")
    table = slots(plan(held, capacity), capacity)
    shorter = np.zeros(capacity + 2, np.int64)
    for n, many in held.items():
        shorter[n + 1] = many
    shorter = np.cumsum(shorter)

    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        n = length.to_numpy(np.int64)
        at = shorter[n] + number.to_numpy(np.int64)
        row = table[np.searchsorted(table[:, 0], at, "right") - 1]
        inside = at - row[:, 0]
        return pd.DataFrame({
            "sequence_id": row[:, 1] + inside // row[:, 2], "offset": row[:, 3] + inside % row[:, 2] * n,
        })

    placed = F.pandas_udf(place, "sequence_id long, offset long")
    same = Window.partitionBy("__part", "length")
    before = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored.groupBy("__part", "length").agg(F.count("*").alias("__n"))
    parts = parts.select("__part", "length", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    numbered = stored.withColumn("__number", F.row_number().over(same.orderBy("__at")) - 1)
    numbered = numbered.join(parts, ["__part", "length"])
    found = numbered.withColumn("__slot", placed("length", F.col("__before") + F.col("__number")))
    return found.select(*pieces.columns, "__slot.sequence_id", "__slot.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` of the packed pieces with their ``ids``; a sequence has at most
    as many pieces as it has tokens."""
    held = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(held, lambda p: p["ids"])).alias("ids"))
