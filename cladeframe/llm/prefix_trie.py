"""Prefix trie of conversations from ternary search trees over range shards.

1. A turn is its key: 16 bytes of SHA-256 of role and text and the number of code points
   of the text.  Texts are read once and shuffled never.  A conversation is the array of
   its turns' keys, in order of their turn numbers.
2. Conversations are range-sorted by their keys and ids, so that a shard holds a range of
   sequences.  A shard encodes its keys by a dictionary, builds a ternary search tree of
   its distinct sequences by inserting medians first, and sums members, leaves and savings
   in one pass over the nodes without recursion.
3. Only prefixes of a shard's first and last sequence can be in other shards as well.
   These boundary nodes, two paths a shard, are merged: counts add up, the smallest member
   is the smallest of all, and a second pass over the merged paths adds up subtrees.  All
   other nodes are final in their shard.

Many copies of one conversation, or many with one first turn, are spread over shards like
all others: where a group is larger than a shard it is part of the boundary.  Members that
end in a boundary node are passed on as text, a piece a shard, and hashed one piece after
another.  The largest things in one task are a shard (``SHARD_TURNS``), two paths a shard,
and one conversation's keys, 20 bytes a turn.

Defined results: turns of a conversation follow their numbers, a missing one first and
equal ones in the order of their keys; a repeated row is a turn of its own; a missing role
or text is empty; rows without a conversation id belong to none and are left out; other
columns are not looked at; an empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeframe.runtime import materialize

from .text import whole

#: Turns of a shard, about, and the least for which another shard is made.
SHARD_TURNS = 1_000_000
LEAST_TURNS = 20_000
DIGEST = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()

#: Nodes of a shard; ``kind`` 0: final, 1: boundary, 2: members that end in a boundary node.
NODES = (
    "kind int, shard int, node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, chars long, ends string"
)
NAMES = [c.split()[0] for c in NODES.split(", ")]


def turn_key(role: Column, text: Column) -> Column:
    """16 bytes that tell turns apart and 4 with the code points of the text."""
    role, text = whole(role), whole(text)
    told = F.concat_ws(":", F.length(role).cast("string"), role, text)
    digest = F.substring(F.unhex(F.sha2(told, 256)), 1, DIGEST)
    return F.concat(digest, F.unhex(F.lpad(F.hex(F.length(text)), 8, "0")))


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: the keys of each conversation's turns in order."""
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        turn_key(F.col("role"), F.col("text")).alias("k"),
    )
    held = F.sort_array(F.collect_list(F.struct("turn", "k")))
    return turns.groupBy("conv_id").agg(F.transform(held, lambda t: t["k"]).alias("turns"))


def grafted(sequences: DataFrame, block: int = 100, spread: int = 6) -> DataFrame:
    """Each conversation with its first h turns from the conversation that its block of
    ids starts with, h being the CRC-32 of its decimal id modulo ``spread``; all of them
    where that one is shorter, none where it is missing."""
    base = F.col("conv_id") - F.col("conv_id") % block
    heads = sequences.where(base == F.col("conv_id")).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, spread - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % spread).cast("int")
    none = F.array().cast("array<binary>")
    own = sequences.select("conv_id", "turns", base.alias("base"), h.alias("h"))
    both = own.join(heads, "base", "left")
    kept = F.when(F.size("turns") > F.col("h"), F.slice("turns", F.col("h") + 1, F.size("turns"))).otherwise(none)
    taken = F.when(F.col("h") > 0, F.slice(F.coalesce("head", none), F.lit(1), F.greatest("h", F.lit(1)))).otherwise(none)
    return both.select("conv_id", F.concat(taken, kept).alias("turns"))


class TernaryTree:
    """Sequences of codes; a node stands for one prefix."""

    def __init__(self):
        self.code, self.low, self.equal, self.high = [-1], [-1], [-1], [-1]
        self.parent, self.depth = [-1], [0]

    def _new(self, code: int, parent: int) -> int:
        self.code.append(code)
        for links in (self.low, self.equal, self.high):
            links.append(-1)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        return len(self.code) - 1

    def insert(self, codes: list[int]) -> int:
        """The node of a sequence, with all nodes on its way."""
        code, at = self.code, 0
        for c in codes:
            parent, links, from_node = at, self.equal, at
            while (at := links[from_node]) >= 0 and code[at] != c:
                links, from_node = (self.low if c < code[at] else self.high), at
            if at < 0:
                links[from_node] = at = self._new(c, parent)
        return at

    def insert_sorted(self, sequences: list[list[int]]) -> list[int]:
        """Nodes of ascending distinct sequences, medians inserted first."""
        nodes, spans = [0] * len(sequences), deque([(0, len(sequences))])
        while spans:
            i, j = spans.popleft()
            if i < j:
                middle = (i + j) // 2
                nodes[middle] = self.insert(sequences[middle])
                spans.append((i, middle))
                spans.append((middle + 1, j))
        return nodes

    def path(self, node: int) -> list[int]:
        """The nodes from the root to this one."""
        out = []
        while node >= 0:
            out.append(node)
            node = self.parent[node]
        return out[::-1]

    def upwards(self) -> Iterator[int]:
        """All nodes, children before parents: a node is made after its parent."""
        return iter(range(len(self.code) - 1, -1, -1))


def _coded(column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Codes of all turns, where each sequence starts, and the dictionary; codes ascend
    with the keys."""
    starts = np.asarray(column.offsets).astype(np.int64)
    flat = column.values.slice(starts[0], starts[-1] - starts[0]).dictionary_encode()
    keys = flat.dictionary.to_pylist()
    order = sorted(range(len(keys)), key=keys.__getitem__)
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.arange(len(keys))
    return rank[np.asarray(flat.indices).astype(np.int64)], starts - starts[0], [keys[i] for i in order]


def _name(parent: bytes, key: bytes) -> bytes:
    """A name for a prefix, from that of the prefix without its last turn."""
    return hashlib.sha256(parent + key).digest()[:DIGEST]


def shard_nodes(shard: int, convs: list[int], column: pa.Array) -> dict[str, list]:
    """All nodes of a shard's conversations, which are sorted by turns and id."""
    codes, starts, keys = _coded(column)
    chars = [int.from_bytes(k[DIGEST:], "big") for k in keys]
    codes, starts = codes.tolist(), starts.tolist()
    sequences: list[list[int]] = []
    members: list[list[int]] = []
    for conv, i, j in zip(convs, starts, starts[1:]):
        sequence = codes[i:j]
        if sequences and sequence == sequences[-1]:
            members[-1].append(conv)
        else:
            sequences.append(sequence)
            members.append([conv])
    tree = TernaryTree()
    nodes = tree.insert_sorted(sequences)
    n = len(tree.code)
    ends: dict[int, list[int]] = dict(zip(nodes, members))
    boundary = {*tree.path(nodes[0]), *tree.path(nodes[-1])}
    none = 1 << 63
    count, first, children, leaves, saved = [0] * n, [none] * n, [0] * n, [0] * n, [0] * n
    for v in tree.upwards():
        if own := ends.get(v):
            count[v] += len(own)
            first[v] = min(first[v], own[0])
        inner, parent = v not in boundary, tree.parent[v]
        if inner:
            leaves[v] += not children[v]
            saved[v] += (count[v] - 1) * chars[tree.code[v]]
        if parent >= 0:
            count[parent] += count[v]
            first[parent] = min(first[parent], first[v])
            if inner:  # of boundary nodes, only final children are counted here
                children[parent] += 1
                leaves[parent] += leaves[v]
                saved[parent] += saved[v]
    name = {0: b"\0" * DIGEST}
    for v in sorted(boundary - {0}):
        name[v] = _name(name[tree.parent[v]], keys[tree.code[v]])
    out: dict[str, list] = {c: [] for c in NAMES}

    def row(*values):
        for column, value in zip(out.values(), values):
            column.append(value)

    for v in range(n):
        parent, own = tree.parent[v], ends.get(v, ())
        told = ",".join(map(str, own))
        if v in boundary:
            row(1, shard, name[v], name.get(parent), first[v], tree.depth[v], None, count[v], children[v], leaves[v],
                saved[v], chars[tree.code[v]] if v else 0, None)
            if own:
                row(2, shard, name[v], None, None, None, None, None, None, None, None, None, told)
            continue
        above = name.get(parent)
        row(0, shard, None, above, first[v], tree.depth[v], None if above else first[parent], count[v], children[v],
            leaves[v], saved[v], None, hashlib.sha256(told.encode()).hexdigest())
    return out


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    given = list(batches)
    if not sum(b.num_rows for b in given):
        return
    table = pa.Table.from_batches(given).combine_chunks()
    rows = shard_nodes(
        TaskContext.get().partitionId(), table["conv_id"].to_pylist(), table["turns"].chunk(0)
    )
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    schema = pa.schema([(c.split()[0], types[c.split()[1]]) for c in NODES.split(", ")])
    yield from pa.Table.from_pydict(rows, schema).to_batches(max_chunksize=10_000)


MERGED = (
    "node binary, shards array<int>, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long"
)


def merged_paths(rows: pd.DataFrame) -> pd.DataFrame:
    """Boundary nodes of all shards: the same prefix is one node, and subtrees are added
    up from the deepest on."""
    nodes: dict[bytes, dict] = {}
    for r in rows.itertuples(index=False):
        v = nodes.setdefault(bytes(r.node), {
            "node": bytes(r.node), "shards": [], "conv_id": r.conv_id, "depth": r.depth, "parent": r.parent, "n_convs": 0,
            "n_children": 0, "n_leaves": 0, "saved_tokens": 0, "chars": r.chars,
        })
        v["shards"].append(r.shard)
        v["conv_id"] = min(v["conv_id"], r.conv_id)
        for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
            v[c] += getattr(r, c)
    deepest_first = sorted(nodes.values(), key=lambda v: -v["depth"])
    for v in deepest_first:
        # all deeper nodes are done, so the children of this one are complete
        v["n_leaves"] += not v["n_children"]
        v["saved_tokens"] += (v["n_convs"] - 1) * v["chars"]
        if v["parent"] is not None:
            above = nodes[bytes(v["parent"])]
            above["n_children"] += 1
            above["n_leaves"] += v["n_leaves"]
            above["saved_tokens"] += v["saved_tokens"]
    for v in deepest_first:
        v["parent_conv_id"] = None if v["parent"] is None else nodes[bytes(v["parent"])]["conv_id"]
    columns = [c.split()[0] for c in MERGED.split(", ")]
    out = pd.DataFrame([{c: v[c] for c in columns} for v in deepest_first], columns=columns)
    return out.astype({"parent_conv_id": "Int64"})


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, comma-joined; a node's pieces come one after another."""
    node, state = None, None
    for batch in batches:
        names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        done: dict[str, list] = {"node": [], "ends": []}
        for name, text in zip(names, texts):
            if name != node:
                if node is not None:
                    done["node"].append(node)
                    done["ends"].append(state.hexdigest())
                node, state = name, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield pa.RecordBatch.from_pydict(done, pa.schema([("node", pa.binary()), ("ends", pa.string())]))
    if node is not None:
        yield pa.RecordBatch.from_pydict({"node": [node], "ends": [state.hexdigest()]})


RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def prefix_trie(sequences: DataFrame, shards: int | None = None) -> DataFrame:
    """Every distinct prefix of ``conv_id, turns``: its smallest member ``conv_id``, its
    ``depth``, ``parent_conv_id``, ``n_convs`` members, ``n_children``, ``n_leaves`` of its
    subtree, ``saved_tokens`` (code points that its subtree's nodes save when each turn is
    kept once) and ``ends_sha256`` of the members that end there."""
    if shards is None:
        turns = sequences.agg(F.sum(F.size("turns") + 1).alias("n")).first()["n"] or 0
        wanted = min(sequences.sparkSession.sparkContext.defaultParallelism, turns // LEAST_TURNS)
        shards = max(1, wanted, -(-turns // SHARD_TURNS))
    ranged = sequences.select("conv_id", "turns").repartitionByRange(shards, "turns", "conv_id")
    found = materialize(ranged.sortWithinPartitions("turns", "conv_id").mapInArrow(_shards, NODES))
    paths = found.where("kind = 1").select("shard", "node", "parent", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "chars")
    # two paths a shard
    merged = materialize(paths.groupBy().applyInPandas(merged_paths, MERGED))
    texts = found.where("kind = 2").select("node", "ends", "shard")
    ends = texts.repartition("node").sortWithinPartitions("node", "shard").select("node", "ends")
    ends = ends.mapInArrow(_hashed, "node binary, ends string")
    boundary = merged.join(ends, "node", "left").select(*RESULT, F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))
    # a final node under a boundary node takes its parent's member from the merged one, as
    # its own shard has it: no more rows meet there than a shard holds
    above = merged.select(F.col("node").alias("parent"), F.explode("shards").alias("shard"), F.col("conv_id").alias("above"))
    final = found.where("kind = 0").drop("node", "chars", "kind").withColumnRenamed("ends", "ends_sha256")
    inside = final.where("parent IS NULL").select(*RESULT, "ends_sha256")
    top = final.where("parent IS NOT NULL").join(above, ["parent", "shard"])
    top = top.withColumn("parent_conv_id", F.col("above")).select(*RESULT, "ends_sha256")
    return boundary.unionByName(inside).unionByName(top)


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of the rebuilt conversations (``grafted``)."""
    return prefix_trie(grafted(materialize(turn_sequences(conversations))))


def last_turns(nodes: DataFrame, conversations: DataFrame, block: int = 100, spread: int = 6) -> DataFrame:
    """Nodes of the rebuilt trie with the ``role`` and ``text`` of their last turn, none
    for the root: it is that of turn ``depth`` of the rebuilt ``conv_id``, which is of the
    block's first conversation up to its h-th turn."""
    from pyspark.sql import Window

    key = turn_key(F.col("role"), F.col("text"))
    numbered = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("from_conv"), whole(F.col("role")).alias("role"), whole(F.col("text")).alias("text"),
        F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", key)).cast("long").alias("place"),
    )
    h = F.crc32(F.col("conv_id").cast("string")) % spread
    base = F.col("conv_id") - F.col("conv_id") % block
    held = numbered.where(F.col("from_conv") % block == 0).groupBy(F.col("from_conv").alias("base")).agg(F.max("place").alias("held"))
    placed = nodes.withColumn("h", h).withColumn("base", base).join(held, "base", "left")
    taken = F.least("h", F.coalesce("held", F.lit(0)))
    inside = F.col("depth") <= taken
    placed = placed.withColumn("from_conv", F.when(inside, F.col("base")).otherwise(F.col("conv_id")))
    placed = placed.withColumn("place", F.when(inside, F.col("depth")).otherwise(F.col("depth") - taken + F.col("h")))
    return placed.join(numbered, ["from_conv", "place"], "left").select(*nodes.columns, "role", "text")
