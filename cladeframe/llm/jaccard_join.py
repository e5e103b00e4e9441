"""N-gram Jaccard join with a token-group matrix.

Links two documents when the sets of their five-word shingles have a Jaccard similarity
of ``PERCENT`` or more, and returns each document's connected component.

1. Equal sets are one set, by 128 bits of digest; copies are never compared.
2. Similar documents are partitioned into groups: every set is compared with the first
   set that shares one of its rare tokens, and linked sets form a group.
3. The token-group matrix has two parts.  Its index holds, for each token of the prefixes
   of a group's sets (their first fifth in a global order), the group and the range of its
   set sizes: a set can be similar to one of a group only if their prefixes share a token,
   and the sizes and the number of tokens that it has alone allow it.  For the groups that
   a set meets there, the union of all tokens of the group is stored as a bit map; the
   set's tokens in it are counted, no fewer than there are, and the group qualifies if they
   are enough for its smallest set.
4. Only qualifying groups of others are opened: the members that share the token are
   bounded by bit maps of their sets, and those that may be similar compared exactly.

The bound is exact for any global order of tokens, so no link between different texts is
lost.  The order only matters for cost: by hash, but the most frequent tokens last
(``HOT_TOKENS`` of them, a fixed size, counted over all documents), so that passages
shared by many documents do not make candidates.  Sets already in one group are not
compared again to find the components, so a large group of near copies costs a star there.

Links are counted afterwards, as all of them are inside components: the sets of a component
go into classes by size, of which only equal and neighbouring ones can be similar, and the
classes into blocks of bounded size.  Every two blocks meet in a task of their own, which
counts the common tokens of all pairs exactly and passes on one sum for each set.

Defined results: ``n_links`` is the number of other sets, that is of different texts, that
are similar to the row's; copies have the same number and no links to each other.  A
document without words has an empty set, its own component and no links; fewer than five
words make one shingle of the whole sequence.  Rows with equal
ids are rows of their own with the smallest id as usual; a missing id is no smallest id
unless all ids of the component are missing.  Shingles are 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeframe.runtime import materialize

from .bloom import bloom, passes
from .components import components
from .rolling import joined, mix, word_hashes
from .text import whole

WORDS = 5
PERCENT = 80
#: Tokens that may be put last in the order; they travel to every task (16 bytes each).
HOT_TOKENS = 500_000
#: Documents from which on a token counts as frequent.
FREQUENT = 64
#: Bits of the map of tokens that occur more than once; it travels to every task.
SEEN_BITS = 1 << 27
CHUNK = 1 << 19
#: Rows worked on at once.
ROWS = 500
#: Tokens that a task counts before it passes them on.
FLUSH = 1 << 18
#: Sets and tokens of about one block of a component; two blocks meet in a task.
BLOCK_SETS = 1024
BLOCK_TOKENS = 1 << 19
#: Tokens in more sets of two blocks than this are counted by products of matrices.
DENSE = 16
COLUMNS = 1 << 12
CELLS = "array<struct<x:struct<class:int,block:int>,y:struct<class:int,block:int>>>"

_factors = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_white = np.zeros(256, bool)
_white[[9, 10, 11, 12, 13, 32]] = True


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, starts = joined(texts)
    data = _lower[data]
    gap = np.ones(len(data) + 1, bool)
    gap[:-1] = _white[data]
    first, last = ~gap[:-1], ~gap[:-1]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[starts] = True
    first = first & (np.concatenate([[True], gap[:-2]]) | fresh[:-1]) if len(data) else first
    last = last & (gap[1:] | fresh[1:])
    at, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    word = word_hashes(data, at, stop)
    low = np.searchsorted(at, starts)
    n = max(0, len(word) - WORDS + 1)
    shingle = np.zeros(n, np.uint64)
    for j in range(WORDS):
        shingle += word[j : n + j] * _factors[j]
    shingle = mix(shingle)
    sets = []
    for i, j in zip(low[:-1].tolist(), low[1:].tolist()):
        if j - i >= WORDS:
            s = np.sort(shingle[i : j - WORDS + 1])
            sets.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif j > i:
            sets.append(mix((word[i:j] * _factors[: j - i]).sum(dtype=np.uint64, keepdims=True) + np.uint64(j - i)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def _few(batches):
    """Batches of at most ``ROWS`` rows: sets and texts of few rows are held at once."""
    for b in batches:
        for i in range(0, b.num_rows, ROWS):
            yield b.slice(i, ROWS)


def _sets(column: pa.Array):
    """The sets of many texts, hashed a chunk at a time."""
    held, total = [], 0
    for text in column:
        held.append(text.as_py())
        total += len(held[-1])
        if total >= CHUNK:
            yield from shingle_sets(held)
            held, total = [], 0
    yield from shingle_sets(held)


class _Order:
    """The global order of tokens: by hash, frequent ones last, the most frequent at
    the very end; and the map of tokens that occur more than once."""

    def __init__(self, shift: int, bits_each: int, seen: np.ndarray, hot: np.ndarray, level: np.ndarray):
        self.shift, self.bits_each, self.seen, self.hot, self.level = shift, bits_each, seen, hot, level

    def repeated(self, tokens: np.ndarray) -> np.ndarray:
        """Whether tokens may occur in more than one document; False is certain."""
        short = (tokens >> np.uint64(self.shift - 32)) & np.uint64(0xFFFFFFFF)
        place = (tokens >> np.uint64(self.shift)) * np.uint64(self.bits_each) + short % np.uint64(self.bits_each)
        return ((self.seen[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1) > 0

    def prefix(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The tokens of a set of which one is common with any similar set, without
        those that are in no other set; how many tokens are left from each to the end
        of the order; and how many of the whole set may be in others."""
        size = len(tokens) - -(-PERCENT * len(tokens) // 100) + 1
        maybe = self.repeated(tokens)
        level = np.zeros(len(tokens), np.int8)
        if len(self.hot):
            some = tokens[maybe] >> np.uint64(self.shift - 32)
            at = np.minimum(np.searchsorted(self.hot, some), len(self.hot) - 1)
            level[maybe] = np.where(self.hot[at] == some, self.level[at], 0)
        first = np.argsort(level, kind="stable")[:size]
        place = np.flatnonzero(maybe[first])
        return tokens[first[place]], (len(tokens) - place).astype(np.int32), int(maybe.sum())


def _count_order(texts: DataFrame, n_docs: int) -> _Order:
    """Count the tokens of all documents in packed form and derive the order.

    Each task sends, per range of hashes, its distinct tokens (32 bits beyond those of
    the range) and their counts; a range is summed in one group of bounded size, as the
    number of ranges follows the number of documents.
    """
    ranges = 1 << min(22, max(6, (n_docs // 256).bit_length()))
    shift = 64 - (ranges.bit_length() - 1)
    bits_each = max(8, SEEN_BITS // ranges)

    def pack(held: list[np.ndarray]):
        tokens, counts = np.unique(np.concatenate(held) >> np.uint64(shift - 32), return_counts=True)
        part = (tokens >> np.uint64(32)).astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        ends = np.append(cut[1:], len(part))
        small = np.minimum(counts, 255).astype(np.uint8)
        low = tokens.astype("<u4")
        yield pd.DataFrame({
            "part": part[cut],
            "tokens": [low[i:j].tobytes() for i, j in zip(cut, ends)],
            "counts": [small[i:j].tobytes() for i, j in zip(cut, ends)],
        })

    def count(batches):
        held, total = [], 0
        for b in batches:
            for s in _sets(b.column(0)):
                held.append(s)
                total += len(s)
                if total >= FLUSH:
                    yield from map(pa.RecordBatch.from_pandas, pack(held))
                    held, total = [], 0
        if total:
            yield from map(pa.RecordBatch.from_pandas, pack(held))

    def add_up(part: pd.DataFrame) -> pd.DataFrame:
        tokens = np.frombuffer(b"".join(part["tokens"]), "<u4")
        counts = np.frombuffer(b"".join(part["counts"]), np.uint8)
        tokens, where = np.unique(tokens, return_inverse=True)
        counts = np.bincount(where, counts)
        flags = np.zeros(bits_each, np.uint8)
        flags[tokens[counts > 1] % bits_each] = 1
        hot = counts > FREQUENT
        number = int(part["part"].iat[0])
        return pd.DataFrame({
            "part": [number], "seen": [np.packbits(flags, bitorder="little").tobytes()],
            "hot": [tokens[hot].astype(np.int64) + (number << 32)], "n": [counts[hot].astype(np.int64)],
        })

    packed = texts.mapInArrow(count, "part long, tokens binary, counts binary")
    parts = materialize(packed.groupBy("part").applyInPandas(add_up, "part long, seen binary, hot array<long>, n array<long>"))
    seen = np.zeros(ranges * bits_each // 8, np.uint8)
    each = bits_each // 8
    for r in parts.select("part", "seen").toLocalIterator():  # SEEN_BITS bits in all
        seen[r["part"] * each : (r["part"] + 1) * each] = np.frombuffer(r["seen"], np.uint8)
    pairs = parts.select(F.explode(F.arrays_zip("hot", "n")).alias("x")).select("x.hot", "x.n")
    top = pairs.orderBy(F.col("n").desc(), "hot").limit(HOT_TOKENS).toPandas().sort_values("hot")
    level = np.log2(np.maximum(top["n"].to_numpy(float) / FREQUENT, 1)).astype(np.int8)
    return _Order(shift, bits_each, seen, top["hot"].to_numpy(np.int64).view(np.uint64), level)


def bit_map(tokens: np.ndarray) -> bytes:
    """Bits of the tokens of a set, two to four for each token."""
    k = max(8, (2 * len(tokens)).bit_length())
    bits = np.zeros(1 << k, np.uint8)
    bits[tokens >> np.uint64(64 - k)] = 1
    return np.packbits(bits).tobytes()


def most_common(n: int, x: bytes, m: int, y: bytes) -> int:
    """No more tokens than this are in both of two sets of ``n`` and ``m`` tokens: a bit
    that only one map has stands for a token that only its set has."""
    a, b = (np.unpackbits(np.frombuffer(z, np.uint8)) for z in (x, y))
    if len(a) > len(b):
        a = a.reshape(len(b), -1).any(axis=1)
    elif len(b) > len(a):
        b = b.reshape(len(a), -1).any(axis=1)
    return min(n - int((a > b).sum()), m - int((b > a).sum()))


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """A map of fewer bits: one that stands for several is set if any of them is."""
    return bits if len(bits) == size else bits.reshape(size, -1).any(axis=1)


def joined_maps(maps: list[bytes]) -> bytes:
    """The map of the union of sets, as coarse as the coarsest of theirs."""
    bits = [np.unpackbits(np.frombuffer(m, np.uint8)) for m in maps]
    size = min(map(len, bits))
    out = np.zeros(size, bool)
    for b in bits:
        out |= folded(b, size).astype(bool)
    return np.packbits(out).tobytes()


def most_in_union(n: int, own: bytes, union: bytes) -> int:
    """No more of a set's ``n`` tokens than this are in a union of sets: a bit of the set's
    map that the union's lacks stands for a token that no set of it has."""
    a, b = (np.unpackbits(np.frombuffer(z, np.uint8)) for z in (own, union))
    size = min(len(a), len(b))
    return n - int((folded(a, size) > folded(b, size)).sum())


def _unions(members: DataFrame) -> DataFrame:
    """``g, union``: the map of all tokens of each group, of rows ``g, map``.  Maps are joined
    in the tasks that hold them first, so a large group is a row a task."""

    def partly(batches):
        for b in batches:
            held: dict[int, list[bytes]] = {}
            for g, m in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.setdefault(g, []).append(m)
            yield pa.RecordBatch.from_pydict(
                {
                    "g": pa.array(held.keys(), pa.int64()),
                    "union": pa.array([m[0] if len(m) == 1 else joined_maps(m) for m in held.values()], pa.binary()),
                }
            )

    def wholly(batches):
        for b in batches:
            unions = [m[0] if len(m) == 1 else joined_maps(m) for m in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(unions, pa.binary())], names=["g", "union"])

    parts = members.select("g", "map").mapInArrow(partly, "g long, union binary")
    return parts.groupBy("g").agg(F.collect_list("union").alias("maps")).mapInArrow(wholly, "g long, union binary")


def _qualifying(pairs: DataFrame, one: DataFrame, members: DataFrame) -> DataFrame:
    """Of ``uid, g, least`` (the smallest set of the group), those whose set can have enough
    tokens in the union of the group to be similar to any set of it."""

    def enough(batches):
        for b in _few(batches):
            keep = []
            for least, n, own, union in zip(*[b.column(i).to_pylist() for i in (2, 3, 4, 5)]):
                keep.append(most_in_union(n, own, union) * (100 + PERCENT) >= (n + least) * PERCENT)
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    wanted = pairs.select("g").distinct()
    unions = _unions(members.join(wanted, "g", "left_semi"))
    both = pairs.join(one.select("uid", "n", "map"), "uid").join(unions, "g")
    return both.select("uid", "g", "least", "n", "map", "union").mapInArrow(enough, "uid long, g long")


def _sketch(order: _Order, key_type: str):
    def run(batches):
        for b in _few(batches):
            keys = [b.column(i) for i in range(4)]
            sizes, sums, xors, tokens, rests, shared, maps = [], [], [], [], [], [], []
            for s in _sets(b.column(4)):
                sizes.append(len(s))
                sums.append(int(s.sum(dtype=np.uint64)))
                xors.append(int(np.bitwise_xor.reduce(mix(s + np.uint64(1)))) if len(s) else 0)
                first, rest, others = order.prefix(s)
                tokens.append(first.view(np.int64))
                rests.append(rest)
                shared.append(others)
                maps.append(bit_map(s))
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int64), *tokens]), np.concatenate([np.zeros(0, np.int32), *rests])
            lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in flat]
            digests = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (sums, xors)]
            yield pa.RecordBatch.from_arrays(
                [*keys, pa.array(sizes, pa.int64()), *digests, *lists, pa.array(shared, pa.int64()), pa.array(maps, pa.binary())],
                names=["uid", "k", "h", "key", "n", "d1", "d2", "tokens", "rests", "v", "map"],
            )

    return run, f"uid long, k long, h long, key {key_type}, n long, d1 long, d2 long, tokens array<long>, rests array<int>, v long, map binary"


def _may_link(n, v, m, w):
    """Whether sets of ``n`` and ``m`` tokens, of which ``v`` and ``w`` may be in other
    sets, can have enough in common."""
    return (F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT) & (
        F.least(v, w) * (100 + PERCENT) >= (F.col(n) + F.col(m)) * PERCENT
    )


def _first_common(n, rest, m, other):
    """Whether a common token of sets of ``n`` and ``m`` tokens can be their first in
    the order, with ``rest`` and ``other`` tokens left from it on."""
    return F.least(rest, other) * (100 + PERCENT) >= (F.col(n) + F.col(m)) * PERCENT


def _opened(sets: DataFrame, texts: DataFrame) -> DataFrame:
    """``uid, tokens`` of the sets, made from their texts."""

    def hashed(batches):
        for b in _few(batches):
            ids = b.column(0).to_pylist()
            sets = [s.tobytes() for s in _sets(b.column(1))]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], names=["uid", "tokens"])

    places = materialize(sets.select("uid", "k", "h"))
    bits = bloom(places, "k", "h")
    found = texts.where(passes(bits, "k", "h")).join(places, ["k", "h"]).dropDuplicates(["uid"])
    return materialize(found.select("uid", "text").mapInArrow(hashed, "uid long, tokens binary"))


def _verify(pairs: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """The stored ``pairs`` (``x, y``) whose sets are similar.

    ``sets`` has every set's size, bit map and the place (``k, h``) of its text.  Maps
    rule out most pairs; the sets of the others are made from their texts, and each
    travels once to each of its pairs.
    """
    def possible(batches):
        for b in _few(batches):
            keep = []
            for n, x, m, y in zip(*[b.column(i).to_pylist() for i in (2, 3, 4, 5)]):
                most = most_common(n, x, m, y)
                keep.append(100 * most >= PERCENT * (n + m - most))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    x = sets.select(F.col("uid").alias("x"), F.col("n").alias("nx"), F.col("map").alias("mx"))
    y = sets.select(F.col("uid").alias("y"), F.col("n").alias("ny"), F.col("map").alias("my"))
    bounded = pairs.join(x, "x").join(y, "y").select("x", "y", "nx", "mx", "ny", "my")
    pairs = materialize(bounded.mapInArrow(possible, "x long, y long"))

    def similar(batches):
        for b in _few(batches):
            keep = []
            for s, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                s, t = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                both = np.intersect1d(s, t, assume_unique=True).size
                keep.append(100 * both >= PERCENT * (len(s) + len(t) - both))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    wanted = pairs.select(F.col("x").alias("uid")).unionByName(pairs.select(F.col("y").alias("uid"))).distinct()
    opened = _opened(sets.join(wanted, "uid", "left_semi"), texts)
    left = pairs.join(opened.select(F.col("uid").alias("x"), F.col("tokens").alias("s")), "x")
    both = left.join(opened.select(F.col("uid").alias("y"), F.col("tokens").alias("t")), "y")
    return materialize(both.select("x", "y", "s", "t").mapInArrow(similar, "x long, y long"))


def count_links(a: list[np.ndarray], b: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """How many sets of ``b`` are similar to each of ``a`` and the other way round; without
    ``b``, how many others of ``a``."""
    every = a + (b or [])
    low, n = (len(a) if b else 0), len(every)
    sizes = np.array([len(x) for x in every], np.int64)
    row = np.repeat(np.arange(n), sizes)
    _, token, held = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    both = np.zeros((len(a), n - low), np.float32)
    # tokens in many sets
    dense = held > DENSE
    number = np.cumsum(dense) - 1
    at = np.flatnonzero(dense[token])
    column, of = number[token[at]], row[at]
    order = np.argsort(column, kind="stable")
    column, of = column[order], of[order]
    for first in range(0, int(dense.sum()), COLUMNS):
        i, j = np.searchsorted(column, [first, first + COLUMNS])
        part = np.zeros((n, COLUMNS), np.float32)
        part[of[i:j], column[i:j] - first] = 1
        both += part[: len(a)] @ part[low:].T
    # tokens in few: every two sets that have one
    at = np.flatnonzero(((held > 1) & ~dense)[token])
    at = at[np.argsort(token[at], kind="stable")]
    token, row = token[at], row[at]
    for step in range(1, DENSE):
        same = np.flatnonzero(token[step:] == token[:-step])
        if not len(same):
            break
        x, y = row[same], row[same + step]
        if b:
            across = (x < low) & (y >= low)
            np.add.at(both, (x[across], y[across] - low), 1)
        else:
            np.add.at(both, (x, y), 1)
            np.add.at(both, (y, x), 1)
    both = both.astype(np.int64)
    similar = 100 * both >= PERCENT * (sizes[: len(a), None] + sizes[None, low:] - both)
    if not b:
        np.fill_diagonal(similar, False)
    return similar.sum(axis=1), similar.sum(axis=0)


def _count_all(found: DataFrame, one: DataFrame, texts: DataFrame) -> DataFrame:
    """``uid, n_links`` of every set of the components ``found`` (``node, component``).

    Components that fit into one block are counted many in a task; the others in cells of
    two blocks.  Two sets in a component are linked to each other.
    """
    base = np.log(100 / PERCENT) + 0.01  # a little wider, so that rounding cannot part similar sizes
    members = one.select("uid", "k", "h", "n").join(found.withColumnRenamed("node", "uid"), "uid")
    members = materialize(members.withColumn("class", F.floor(F.log("n") / base).cast("int")))
    need = F.greatest(F.ceil(F.sum("sets") / BLOCK_SETS), F.ceil(F.sum("tokens") / BLOCK_TOKENS))
    classes = members.groupBy("component", "class").agg(F.count("*").alias("sets"), F.sum("n").alias("tokens"))
    blocks = classes.groupBy("component", "class").agg(need.cast("int").alias("blocks"))
    per_class = F.map_from_entries(F.collect_list(F.struct("class", "blocks"))).alias("blocks")  # a class is a power of a size
    total = classes.groupBy("component").agg(F.sum("sets").alias("sets"), need.alias("need"))
    total = total.join(blocks.groupBy("component").agg(per_class), "component").where("sets > 2")
    total = materialize(total)
    bins = total.where("need = 1").join(classes, "component").agg(F.sum("tokens")).first()[0] or 0
    bins = -(-bins // BLOCK_TOKENS) + 1

    own = F.pmod(F.xxhash64("uid"), F.col("blocks")[F.col("class")]).cast("int")
    held = members.join(total, "component").withColumn("block", F.when(F.col("need") > 1, own).otherwise(0))
    here = F.struct("class", "block")
    cell = lambda x, y: F.struct(x.alias("x"), y.alias("y"))

    def others(step: int):
        number = F.coalesce(F.try_element_at("blocks", F.col("class") + step), F.lit(0))
        there = lambda j: F.struct((F.col("class") + step).alias("class"), j.cast("int").alias("block"))
        side = lambda j: cell(F.least(here, there(j)), F.greatest(here, there(j)))
        return F.when(number > 0, F.transform(F.sequence(F.lit(0), number - 1), side)).otherwise(F.array().cast(CELLS))

    cells = F.concat(others(0), others(-1), others(1))
    alone = F.array(F.struct(*[F.struct(F.lit(0).alias("class"), F.lit(0).alias("block")).alias(x) for x in "xy"]))
    small = F.col("need") == 1
    held = held.select(
        "uid", "component", F.when(small, 0).otherwise(F.col("class")).alias("class"), "block",
        F.when(small, F.pmod(F.xxhash64("component"), F.lit(bins))).alias("bin"), F.when(small, alone).otherwise(cells).alias("cells"),
    )
    opened = _opened(members.join(total, "component", "left_semi"), texts)
    dealt = opened.join(held, "uid").select("uid", "component", "class", "block", "bin", "tokens", F.explode("cells").alias("cell"))
    sides = [F.col(f"cell.{x}.{y}").alias(f"{x}_{y}") for x in "xy" for y in ("class", "block")]
    dealt = dealt.select("uid", "component", "class", "block", "bin", "tokens", *sides)

    def count(part: pd.DataFrame) -> pd.DataFrame:
        uids, links = [], []
        for _, g in part.groupby("component"):
            cell = g.iloc[0]
            alone = cell["x_class"] == cell["y_class"] and cell["x_block"] == cell["y_block"]
            sets = [np.frombuffer(t, np.uint64) for t in g["tokens"]]
            first = ((g["class"] == g["x_class"]) & (g["block"] == g["x_block"])).to_numpy()
            a = [s for s, f in zip(sets, first) if f]
            b = [s for s, f in zip(sets, first) if not f]
            if not a or not b and not alone:
                continue
            of_a, of_b = count_links(a, b or None)
            uids += [g["uid"].to_numpy()[first]] + ([g["uid"].to_numpy()[~first]] if b else [])
            links += [of_a] + ([of_b] if b else [])
        none = [np.zeros(0, np.int64)]
        return pd.DataFrame({"uid": np.concatenate(none + uids), "n_links": np.concatenate(none + links)})

    owner = F.when(F.col("bin").isNull(), F.col("component")).otherwise(F.col("bin"))
    task = [F.col("bin").isNull(), owner, "x_class", "x_block", "y_class", "y_block"]
    counted = dealt.groupBy(*task).applyInPandas(count, "uid long, n_links long")
    counted = counted.groupBy("uid").agg(F.sum("n_links").alias("n_links"))
    pairs = members.join(total, "component", "left_anti").select("uid", F.lit(1).cast("long").alias("n_links"))
    return counted.unionByName(pairs)


def _located(key: Column, text: Column, uid: Column) -> list[Column]:
    """Number, place, key and bytes of a row's text."""
    body = whole(text)
    place = F.xxhash64(key.cast("string"), body)
    return [uid.alias("uid"), place.alias("k"), F.crc32(body).alias("h"), key.alias("key"), F.encode(body, "utf-8").alias("text")]


def _components(texts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The stored rows of ``texts`` (see ``_located``); one row for each set; the sets in
    components of more than one; and each set's component with the first of its rows
    (smallest key, a missing one last, then smallest number) as ``first``."""
    kind = texts.schema["key"].dataType
    order = _count_order(texts.select("text"), texts.count())
    run, schema = _sketch(order, kind.simpleString())
    rows = materialize(texts.mapInArrow(run, schema))
    same = ["n", "d1", "d2"]
    sets = materialize(rows.where("n > 0").groupBy(*same).agg(
        F.min("uid").alias("uid"), F.min(F.struct(F.col("key").isNull().alias("missing"), "key", F.col("uid").alias("row"))).alias("low")
    ))
    one = rows.join(sets.select("uid"), "uid", "left_semi")
    one = materialize(one.select("uid", "k", "h", "n", "v", "tokens", "rests", "map"))

    # groups: each set is compared with the most common set that has one of its tokens,
    # the one with the fewest tokens of its own
    each = F.explode(F.arrays_zip(F.col("tokens").alias("token"), F.col("rests").alias("rest"))).alias("t")
    tokens = one.select("uid", "n", "v", each).select("uid", "n", "v", "t.*")
    central = F.struct((1 - F.col("v") / F.col("n")).alias("own"), "uid", "n", "v", "rest")
    first = tokens.groupBy("token").agg(F.min(central).alias("f"), F.count("*").alias("c")).where("c > 1")
    met = tokens.join(first.select("token", "f"), "token").where(F.col("uid") != F.col("f.uid"))
    met = met.where(_may_link("n", "v", "f.n", "f.v") & _first_common("n", "rest", "f.n", "f.rest"))
    pairs = materialize(met.select(F.col("uid").alias("x"), F.col("f.uid").alias("y")).distinct())
    links = _verify(pairs, one, texts.select("k", "h", "text"))
    grouped = materialize(components(links.select(F.col("x").alias("a"), F.col("y").alias("b"))))

    # the token-group matrix, over tokens that more than one group has
    group = F.coalesce("component", "uid").alias("g")
    owned = one.join(grouped.withColumnRenamed("node", "uid"), "uid", "left").select("uid", "n", "v", "tokens", "rests", "map", group)
    members = materialize(owned)
    owned = members.select("uid", "n", "v", "g", each).select("uid", "n", "v", "g", "t.*")
    shared = owned.groupBy("token").agg(F.min("g").alias("a"), F.max("g").alias("b")).where("a <> b").select("token")
    cells = materialize(owned.join(shared, "token", "left_semi"))
    matrix = cells.groupBy("token", "g").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max("rest").alias("rest"))
    q, m = cells.alias("q"), matrix.alias("m")
    reach = (F.col("m.most") * 100 >= F.col("q.n") * PERCENT) & (F.col("m.least") * PERCENT <= F.col("q.n") * 100)
    reach &= F.col("q.v") * (100 + PERCENT) >= (F.col("q.n") + F.col("m.least")) * PERCENT
    reach &= _first_common("q.n", "q.rest", "m.least", "m.rest")
    qualify = q.join(m, "token").where((F.col("q.g") != F.col("m.g")) & reach)
    qualify = materialize(qualify.select("token", "q.uid", "q.n", "q.v", "q.rest", F.col("m.g").alias("g"), "m.least"))
    # of the groups met, those whose union has enough of a set's tokens
    met = qualify.groupBy("uid", "g").agg(F.min("least").alias("least"))
    qualify = qualify.drop("least").join(_qualifying(met, one, members), ["uid", "g"], "left_semi")
    s = cells.select("token", "g", F.col("uid").alias("y"), F.col("n").alias("ny"), F.col("v").alias("vy"), F.col("rest").alias("ry"))
    opened = qualify.join(s, ["token", "g"]).where((F.col("uid") > F.col("y")) & _may_link("n", "v", "ny", "vy") & _first_common("n", "rest", "ny", "ry"))
    opened = opened.select(F.col("uid").alias("x"), "y").distinct().join(pairs, ["x", "y"], "left_anti")
    more = _verify(materialize(opened), one, texts.select("k", "h", "text"))

    every = links.unionByName(more).select(F.col("x").alias("a"), F.col("y").alias("b"))
    found = materialize(components(every))
    named = sets.join(found.withColumnRenamed("node", "uid"), "uid", "left")
    named = materialize(named.withColumn("component", F.coalesce("component", "uid")))
    low = named.groupBy("component").agg(F.min("low").alias("first"))
    return rows, one, found, named.drop("low").join(low, "component")


def similar_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_shingles, component_id, n_links`` of every row."""
    texts = docs.select(*_located(F.col(key), F.col(text), F.monotonically_increasing_id()))
    rows, one, found, named = _components(texts)
    degree = _count_all(found, one, texts.select("k", "h", "text"))
    same = ["n", "d1", "d2"]
    named = named.join(degree, "uid", "left").select(*same, F.col("first.key").alias("component_id"), "n_links")
    out = rows.select("key", *same).join(named, same, "left")
    return out.select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component with its columns: of those with the smallest id one, of a
    component without ids any one.  Rows without words stay.  Rows are stored with a
    number first, so that repeated and missing ids are rows of their own."""
    stored = materialize(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("uid")))
    rows, _, _, named = _components(stored.select(*_located(F.col("row")[key], F.col("row")[text], F.col("uid"))))
    keep = named.select(F.col("first.row").alias("uid")).distinct().unionByName(rows.where("n = 0").select("uid"))
    return stored.join(keep, "uid", "left_semi").select("row.*")
