"""Removal of repeated passages by a depth-limited radix sort of suffixes.

Suffixes matter up to ``LENGTH`` bytes only: two of them in the same group after that
many bytes are a repeated window.  As in a most-significant-digit sort, groups are split
pass by pass and a group of one is dropped at once; but a pass compares hashes of long
pieces instead of single bytes, and only suffixes near an anchor are looked at.

Anchors are the places of the smallest hash of ``GRAM`` bytes in each window, so equal
windows have their anchor at the same distance ``r`` from their start.  A pass holds
items: an anchor and a range of ``r``, that is of window starts.  All windows of the
range share a core; together they fill a hull.  A core found once cannot be part of a
repeated window: the item is dropped.  A hull found twice makes all windows of the range
repeated: the item is done.  Other items, at the edges of what is repeated, are split
into ranges of 49, of 7 and at last of 1, where core and hull are the window itself.
Where a core has such items, one item of each of its other hulls goes along as a witness,
so that the windows of the parts still find their likes.

Counts are aggregates combined before they are shuffled, items meet them in joins that
adaptive execution can split, and no group of equal pieces is ever gathered.  Texts are
moved only for documents with items at an edge or with something to remove.

Defined results: a missing or empty text has no bytes; texts under ``LENGTH`` bytes lose
nothing; a row that occurs twice loses every byte, as its windows also start elsewhere.
Rows are told apart by key and 64 bits of hash of the text; a missing key is a key of its
own.  A range is known by its core, 64 bits modulo a power of two, and its hull, 62 bits
modulo a prime with other bases; for ranges of one start both are the window itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeframe.runtime import materialize

from .bloom import bloom, passes
from .rolling import Prefix, PrimePrefix, joined, mix
from .text import whole

LENGTH = 400
GRAM = 64
SPAN = LENGTH - GRAM
#: Ranges of window starts in the passes after the first.
STEPS = (49, 7, 1)
#: Bytes of text hashed at a time; longer texts go in overlapping pieces.
CHUNK = 1 << 19
KEY = ["k", "h"]
#: Set in a packed place when the item is a witness only.
WITNESS = 1 << 20


def pack(place, r0, r1):
    """Place, witness bit and range in one number: 42, 1, 10 and 10 bits."""
    return (place << 21) | (r0 << 10) | r1


def unpack(at):
    return at >> 21, (at >> 10) & 1023, at & 1023


def anchors(prefix: Prefix, starts: np.ndarray):
    """Text number, place, smallest and largest distance of each anchor of a chunk."""
    w = SPAN + 1
    grams = prefix.every(GRAM)
    sizes = np.diff(starts)
    windows = np.maximum(sizes - LENGTH + 1, 0)
    text = np.repeat(np.arange(len(sizes)), windows)
    if not len(text):
        return (np.zeros(0, np.int64),) * 4
    first = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows) + starts[text]
    # smallest hash, then leftmost place, of each run of w places
    rank = (mix(grams) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    padded = np.full(-(-len(rank) // w) * w, np.uint64(2**64 - 1))
    padded[: len(rank)] = rank
    blocks = padded.reshape(-1, w)
    head = np.minimum.accumulate(blocks, axis=1).ravel()
    tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    owner = (np.minimum(tail[first], head[first + w - 1]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    last = np.concatenate([new[1:], [len(owner)]]) - 1
    place, text = owner[new], text[new]
    return text, place - starts[text], place - first[last], place - first[new]


class Hashes:
    """Both kinds of prefix hashes of a chunk."""

    def __init__(self, data: np.ndarray):
        self.prefix, self.prime = Prefix(data), PrimePrefix(data)

    def of(self, low, high, place, r0, r1):
        """Hashes of the core, modulo a power of two, and of the hull, modulo a prime, of
        the ranges ``r0`` to ``r1``; ``low`` and ``high`` are the text's bounds, ``place``
        counts from the chunk's start."""
        core = self.prefix.of(np.maximum(place - r0, low), np.minimum(place - r1 + LENGTH, high))
        begin, end = np.maximum(place - r1, low), np.minimum(place - r0 + LENGTH, high)
        hull = mix(self.prime.of(begin, end)) + ((place - begin) * 1024 + (end - place)).astype(np.uint64)
        tag = (r0 * 1024 + r1).astype(np.uint64)
        return mix(core + tag).view(np.int64), mix(hull ^ tag).view(np.int64)


def first_items(texts: list[bytes]):
    """Text number, packed place and range, core and hull of all anchors of texts."""
    data, starts = joined(texts)
    found = Hashes(data)
    text, place, near, far = anchors(found.prefix, starts)
    low, high = starts[text], starts[text + 1]
    zero = np.zeros_like(place)
    core, hull = found.of(low, high, place + low, zero, zero + SPAN)
    return text, pack(place, near, far), core, hull


def long_items(text: bytes):
    """The same for one text of any length, piece by piece."""
    found: dict[int, tuple[int, int]] = {}
    for low in range(0, max(1, len(text) - LENGTH + 1), CHUNK):
        piece = np.frombuffer(text[low : low + CHUNK + LENGTH - 1], np.uint8)
        _, place, near, far = anchors(Prefix(piece), np.array([0, len(piece)]))
        for p, a, b in zip((place + low).tolist(), near.tolist(), far.tolist()):
            x, y = found.get(p, (a, b))
            found[p] = min(a, x), max(b, y)
    place = np.array(sorted(found), np.int64)
    near = np.array([found[p][0] for p in place.tolist()], np.int64)
    far = np.array([found[p][1] for p in place.tolist()], np.int64)
    zero = np.zeros_like(place)
    core, hull = piecewise(text, place, zero, zero + SPAN)
    return np.zeros(len(place), np.int64), pack(place, near, far), core, hull


def piecewise(text: bytes, place, r0, r1):
    """Cores and hulls in one text of any length; ``place`` ascends."""
    core, hull = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
    i = 0
    while i < len(place):
        j = int(np.searchsorted(place, place[i] + CHUNK, side="right"))
        low, high = max(0, int(place[i]) - LENGTH), min(len(text), int(place[j - 1]) + LENGTH)
        found = Hashes(np.frombuffer(text[low:high], np.uint8))
        core[i:j], hull[i:j] = found.of(0, high - low, place[i:j] - low, r0[i:j], r1[i:j])
        i = j
    return core, hull


def _chunks(sizes: list[int]):
    """Slices of rows of about CHUNK bytes together."""
    low = total = 0
    for i, n in enumerate(sizes):
        total += n
        if total >= CHUNK:
            yield low, i + 1
            low, total = i + 1, 0
    if low < len(sizes):
        yield low, len(sizes)


ITEMS = "k long, h long, at long, core long, hull long"


def _rows(keys, text, at, core, hull) -> pa.RecordBatch:
    columns = [keys[0][text], keys[1][text], at, core, hull]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["k", "h", "at", "core", "hull"])


def _first_pass(batches):
    for b in batches:
        keys = [b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)]
        texts = [t for t in b.column(2).to_pylist()]
        for i, j in _chunks([len(t) for t in texts]):
            short = [x for x in range(i, j) if len(texts[x]) <= 4 * CHUNK]
            if short:
                text, at, core, hull = first_items([texts[x] for x in short])
                yield _rows(keys, np.array(short)[text], at, core, hull)
            for x in set(range(i, j)).difference(short):
                text, at, core, hull = long_items(texts[x])
                yield _rows(keys, text + x, at, core, hull)


def _split(at: np.ndarray, step: int):
    """Items for the parts of each range on the grid of ``step``."""
    place, near, far = unpack(at)
    low, n = near // step, far // step - near // step + 1
    item = np.repeat(np.arange(len(at)), n)
    r0 = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[item]) * step
    r1 = np.minimum(r0 + step - 1, SPAN)
    return item, place[item], r0, r1, np.maximum(near[item], r0), np.minimum(far[item], r1)


def _next_pass(step: int):
    def run(batches):
        for b in batches:
            keys = [b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)]
            for x, (text, places) in enumerate(zip(b.column(2).to_pylist(), b.column(3))):
                at = np.sort(np.asarray(places.values))
                item, place, r0, r1, near, far = _split(at, step)
                core, hull = piecewise(text, place, r0, r1)
                yield _rows(keys, np.full(len(place), x), pack(place, near, far) | (at[item] & WITNESS), core, hull)

    return run


def _sort_out(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of stored items: those whose windows are all repeated, and those for the next
    pass."""
    pairs = ["core", "hull"]
    own = F.col("at").bitwiseAND(WITNESS) == 0
    # a core found once ends here, but for the few that pass the filter by mistake
    bits = bloom(items.groupBy("core").agg(F.count("*").alias("n")).where("n > 1"), "core", "core")
    alive = items.where(passes(bits, "core", "core"))
    classes = materialize(alive.groupBy(*pairs).agg(
        F.count("*").alias("n"), F.max(own).alias("own"), F.min(F.struct(*KEY, "at")).alias("one")
    ))
    edge = (F.col("n") == 1) & F.col("own")
    split = classes.groupBy("core").agg(F.sum("n").alias("n"), F.max(edge).alias("edge")).where("n > 1 AND edge")
    split = materialize(split.select("core"))  # stored, so that the join can divide a core's classes
    at = F.when(edge, F.col("one.at")).otherwise(F.col("one.at").bitwiseOR(WITNESS))
    following = classes.join(split, "core", "left_semi").select("one.k", "one.h", at.alias("at"))
    done = alive.where(own).join(classes.where("n > 1").select(*pairs), pairs, "left_semi").select(*KEY, "at")
    return materialize(done), materialize(following)


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    kind = docs.schema[key].dataType.typeName()
    number = F.col(key).cast("long") if kind in ("byte", "short", "integer", "long") else F.xxhash64(F.col(key))
    body = whole(F.col(text))
    return docs.select(
        F.coalesce(number, F.lit(-(2**63))).alias("k"), F.xxhash64(body).alias("h"),
        F.encode(body, "utf-8").alias("text"), F.col(key).alias("key"),
    )


def repeated_windows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``k, h, at`` of all ranges of repeated windows (see ``unpack``)."""
    keyed = _keyed(docs, key, text).select("k", "h", "text")
    long_enough = keyed.where(F.octet_length("text") >= LENGTH)
    items = materialize(long_enough.mapInArrow(_first_pass, ITEMS))
    done, edge = _sort_out(items)
    found = [done]
    for step in STEPS:
        bits = bloom(edge, *KEY)
        places = edge.groupBy(*KEY).agg(F.collect_set("at").alias("places"))  # of one text
        texts = long_enough.where(passes(bits, *KEY)).join(places, KEY).dropDuplicates(KEY)
        items = materialize(texts.mapInArrow(_next_pass(step), ITEMS))
        done, edge = _sort_out(items)
        found.append(done)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def merged(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that repeated windows cover."""
    place, near, far = unpack(at)
    start, stop = place - far, place - near + LENGTH
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    new = np.flatnonzero(np.concatenate([[True], start[1:] > stop[:-1]]))
    return start[new], stop[np.concatenate([new[1:], [len(stop)]]) - 1]


def _cut(batches):
    for b in batches:
        kept, removed, starts, stops = [], [], [], []
        for text, places in zip(b.column(1).to_pylist(), b.column(2)):
            at = np.asarray(places.values) if places.is_valid else np.zeros(0, np.int64)
            low, high = merged(at) if len(at) else (at, at)
            ends = np.concatenate([low, [len(text)]])
            kept.append(b"".join([text[i:j] for i, j in zip([0, *high.tolist()], ends.tolist())]))
            removed.append(int((high - low).sum()))
            starts.append(low)
            stops.append(high)
        lists = [pa.array(x, pa.list_(pa.int64())) for x in (starts, stops)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), *lists],
            names=["key", "kept", "n_removed", "starts", "stops"],
        )


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the bytes that are ``kept``, ``n_bytes``, ``n_removed`` and the removed
    runs as ``starts`` and ``stops`` in bytes, for every row of ``docs``."""
    ranges = repeated_windows(docs, key, text)
    bits = bloom(ranges, *KEY)
    keyed = _keyed(docs, key, text).withColumn("hit", passes(bits, *KEY))
    kind = docs.schema[key].dataType.simpleString()
    none = F.array().cast("array<bigint>")
    clean = keyed.where(~F.col("hit")).select("key", F.col("text").alias("kept"), F.lit(0).cast("long").alias("n_removed"), none.alias("starts"), none.alias("stops"))
    # of one text: equal rows have the same places, once
    places = ranges.groupBy(*KEY).agg(F.collect_set("at").alias("places"))
    hit = keyed.where("hit").join(places, KEY, "left").select("key", "text", "places")
    cut = hit.mapInArrow(_cut, f"key {kind}, kept binary, n_removed long, starts array<long>, stops array<long>")
    both = clean.unionByName(cut)
    size: Column = F.octet_length("kept").cast("long") + F.col("n_removed")
    return both.select(F.col("key").alias(key), "kept", size.alias("n_bytes"), "n_removed", "starts", "stops")
