"""Phylogenies as edge tables (``schemas.TREE_EDGES``), any number at a time.

Nothing walks a tree node by node or gathers a tree in one task.  Ancestry and
common ancestors are questions about intervals of entry numbers (``interval_labels``,
``mrca``).  These numbers and sums over clades use pointer doubling: round ``j`` knows the ancestor
``2**j`` steps up, so a tree of depth ``d`` takes about ``log2(d)`` joins,
ladder-shaped trees included.  Each round holds one row per node and is stored
(``runtime.materialize``).  The looked-up side of every join has unique keys;
a polytomy holding a large share of the nodes is joined without a shuffle
(``runtime.join_skewed``), and clade sums are combined map-side.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import DataError, by_rows, join_skewed, materialize, materialize_even

NODE = ["tree_id", "node_id"]

#: Levels up to which a node's whole path to the root is kept in its row.
SHALLOW = 64
#: Compressed bytes of paths that one task joins; hundreds of bytes a path shrink to a few.
PATH_BYTES = 1 << 20
#: Nodes up to which a tree is lifted inside one row.
SMALL = 32
#: Nodes in a block of the range-minimum index.
BLOCK = 256
#: Places of siblings that are summed up by one task.
SIBLINGS = 4096

#: More doubling rounds than any real depth needs.
MAX_ROUNDS = 50


@dataclass
class Lifted:
    """Result of pointer doubling.

    ``final`` has one row per node: ``dist`` (sum of lengths from the node to
    the root, both included), ``hops`` (nodes on that path) and the clade sums.
    ``steps[j]`` gives the ancestor ``2**j`` edges up in ``anc``.
    """

    final: DataFrame
    steps: list[DataFrame] = field(default_factory=list)


def lift(
    edges: DataFrame,
    sums: dict[str, Column] | None = None,
    merges: dict[str, tuple[Column, str]] | None = None,
    carry: tuple[str, ...] = (),
) -> Lifted:
    """Pointer doubling over all trees at once.

    ``sums`` are per-node values added up over each clade; ``merges`` are
    values combined with ``min``, ``max`` or ``bit_xor`` instead.  ``carry`` names
    columns of ``edges`` to keep in ``final``.
    """
    state, kinds = _start(edges, sums, merges, carry)
    return _double(state, kinds, carry)


def lifted(
    edges: DataFrame,
    sums: dict[str, Column] | None = None,
    merges: dict[str, tuple[Column, str]] | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``lift(...).final``: trees of at most ``SMALL`` rows are lifted inside one row each,
    the others by joins."""
    state, kinds = _start(edges, sums, merges, carry)
    total = state.count()
    sizes = state.groupBy("tree_id").agg(F.count("*").alias("n"))
    # a null id joins with nothing, which the joins know
    large = materialize_even(sizes.where((F.col("n") > SMALL) | F.col("tree_id").isNull()))
    n_large = large.agg(F.sum("n")).first()[0] or 0
    if n_large == total:
        return _double(state, kinds, carry).final
    if not n_large:
        return _lift_small(state, kinds, carry, total)
    known = state.where("tree_id is not null")
    small = known.join(large.select("tree_id"), "tree_id", "left_anti")
    rest = known.join(large.select("tree_id"), "tree_id", "left_semi").unionByName(state.where("tree_id is null"))
    done = _double(materialize_even(rest), kinds, carry).final
    return _lift_small(small, kinds, carry, total - n_large).unionByName(done)


def _start(edges: DataFrame, sums, merges, carry) -> tuple[DataFrame, dict[str, str]]:
    """The stored state before the first round, and how each value is combined."""
    values = {name: (value, "sum") for name, value in (sums or {}).items()}
    values.update(merges or {})
    state = materialize_even(
        edges.select(
            *NODE,
            F.col("parent_id").alias("anc"),
            F.coalesce("branch_length", F.lit(0.0)).alias("dist"),
            F.lit(1).cast("bigint").alias("hops"),
            *carry,
            *[value.alias(name) for name, (value, _) in values.items()],
        )
    )
    return state, {name: kind for name, (_, kind) in values.items()}


def _lift_small(state: DataFrame, kinds: dict[str, str], carry: tuple[str, ...], total: int) -> DataFrame:
    """The rounds of ``_double`` on an array of the nodes of each tree."""
    columns = [c for c in state.columns if c != "tree_id"]
    held = by_rows(state, ["tree_id"], total).groupBy("tree_id").agg(F.collect_list(F.struct(*columns)).alias("held"))

    def jumped(held: Column, x: Column) -> Column:
        """A node's pointer moved to where its ancestor points."""
        moved = {"dist": lambda y: x["dist"] + y["dist"], "hops": lambda y: x["hops"] + y["hops"], "anc": lambda y: y["anc"]}
        above = F.filter(held, lambda y: y["node_id"] == x["anc"])
        return F.when(x["anc"].isNull(), F.array(x)).otherwise(
            F.transform(above, lambda y: F.struct(*[moved.get(c, lambda _, c=c: x[c])(y).alias(c) for c in columns]))
        )

    def added(held: Column, x: Column) -> Column:
        """The values of the nodes that pointed at a node added to its own."""
        below = F.filter(held, lambda y: y["anc"] == x["node_id"])
        return F.struct(*[
            (_combine_all(kinds[c], x[c], below[c]) if c in kinds else x[c]).alias(c)
            for c in columns
        ])

    def round_(held: Column) -> Column:
        moved = F.flatten(F.transform(held, lambda x: jumped(held, x)))
        moved = F.transform(moved, lambda x: added(held, x)) if kinds else moved
        return F.when(F.exists(held, lambda x: x["anc"].isNotNull()), moved).otherwise(held)

    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size("held"))).cast("int"))
    walked = F.aggregate(rounds, F.col("held"), lambda held, _: round_(held))
    final = materialize_even(held.select("tree_id", F.inline(walked)).select(state.columns))
    if not final.where("anc is not null").isEmpty():
        raise DataError("the parent links of a tree form a cycle")
    return final


def _combine_all(kind: str, own: Column, below: Column) -> Column:
    if kind in ("min", "max"):
        of = F.array_min if kind == "min" else F.array_max
        return (F.least if kind == "min" else F.greatest)(own, of(below))
    known = F.filter(below, lambda v: v.isNotNull())
    if kind == "sum":
        return F.aggregate(known, own, lambda total, v: total + v)
    return F.aggregate(known, own, lambda total, v: total.bitwiseXOR(v))


def _double(state: DataFrame, kinds: dict[str, str], carry: tuple[str, ...]) -> Lifted:
    """Rounds of joins that double the steps of every pointer."""
    steps, pending = [], state.where("anc is not null")
    while n_pending := pending.count():
        if len(steps) > MAX_ROUNDS:
            raise DataError("the parent links of a tree form a cycle")
        steps.append(state)
        jumped = _jump(pending, state, [*carry, *kinds], n_pending)
        if kinds:
            # clade values of every node change, nodes that are done included
            moved = jumped.unionByName(state.where("anc is null"))
            state = materialize_even(_add_below(moved, pending, kinds))
            pending = state.where("anc is not null")
        else:
            # nodes that have reached their root are not written again
            jumped = materialize_even(jumped)
            state = jumped.unionByName(state.where("anc is null"))
            pending = jumped.where("anc is not null")
    return Lifted(state, steps)


def _jump(pending: DataFrame, state: DataFrame, kept: list[str], total: int) -> DataFrame:
    """Move every pending node's pointer to where its ancestor points."""
    above = state.select(
        "tree_id",
        F.col("node_id").alias("anc"),
        F.col("anc").alias("next_anc"),
        F.col("dist").alias("above_dist"),
        F.col("hops").alias("above_hops"),
    )
    return join_skewed(pending, above, ["tree_id", "anc"], total).select(
        *NODE,
        F.col("next_anc").alias("anc"),
        (F.col("dist") + F.col("above_dist")).alias("dist"),
        (F.col("hops") + F.col("above_hops")).alias("hops"),
        *kept,
    )


def _add_below(moved: DataFrame, pending: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Add the values of the nodes that pointed at a node in this round."""
    below = pending.groupBy("tree_id", F.col("anc").alias("node_id")).agg(
        *[_aggregate(kind)(name).alias(f"below_{name}") for name, kind in kinds.items()]
    )
    same = [c for c in moved.columns if c not in kinds]
    return moved.join(below, NODE, "left").select(
        *same,
        *[
            _combine(kind, F.col(name), F.col(f"below_{name}")).alias(name)
            for name, kind in kinds.items()
        ],
    )


def _aggregate(kind: str):
    return {"sum": F.sum, "min": F.min, "max": F.max, "bit_xor": F.bit_xor}[kind]


def _combine(kind: str, own: Column, below: Column) -> Column:
    if kind == "sum":
        return own + F.coalesce(below, F.lit(0))
    if kind == "bit_xor":
        return own.bitwiseXOR(F.coalesce(below, F.lit(0)))
    return F.least(own, below) if kind == "min" else F.greatest(own, below)


# -- depths and ultrametricity ---------------------------------------------------


def node_depths(edges: DataFrame) -> DataFrame:
    """``tree_id, node_id, depth`` (sum of lengths, root's own included), ``level``
    (0 for the root)."""
    return lifted(edges).select(
        *NODE, F.col("dist").alias("depth"), (F.col("hops") - 1).alias("level")
    )


def tip_depths(edges: DataFrame) -> DataFrame:
    """Root-to-tip distance of every tip."""
    final = lifted(edges, carry=("label", "is_tip"))
    return final.where("is_tip").select(*NODE, "label", F.col("dist").alias("depth"))


def ultrametric_deviation(edges: DataFrame) -> DataFrame:
    """``deviation`` = largest minus smallest tip depth per tree, 0.0 without tips;
    ``height`` = largest."""
    final = lifted(edges, carry=("is_tip",))
    depth = F.when(F.col("is_tip"), F.col("dist"))
    return final.groupBy("tree_id").agg(
        F.coalesce(F.max(depth) - F.min(depth), F.lit(0.0)).alias("deviation"),
        F.max(depth).alias("height"),
    )


def is_ultrametric(edges: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """Per tree, whether the deviation is within ``tolerance`` times the height."""
    scale = F.when(F.col("height") > 0, F.col("height")).otherwise(F.lit(1.0))
    verdict = F.col("deviation") <= F.lit(tolerance) * scale
    verdict = F.when(F.col("height").isNull(), F.lit(False)).otherwise(verdict)
    return ultrametric_deviation(edges).select(
        "tree_id", "deviation", "height", verdict.alias("is_ultrametric")
    )


# -- ancestors and common ancestors ----------------------------------------------


def ancestors(edges: DataFrame) -> DataFrame:
    """Every ``(node, ancestor)`` pair, the node itself included, with the number
    of edges and the length between them.

    The result has one row per node and level; use it on trees whose depth is
    moderate (the other operators here do not need it).
    """
    steps = lift(edges).steps
    closure = edges.select(
        *NODE, F.col("node_id").alias("anc"),
        F.lit(0.0).alias("dist"), F.lit(0).cast("bigint").alias("hops"),
    )
    for step in steps:
        hop = step.where("anc is not null").select(
            "tree_id", F.col("node_id").alias("anc"), F.col("anc").alias("next_anc"),
            F.col("dist").alias("d"), F.col("hops").alias("h"),
        )
        further = closure.join(hop, ["tree_id", "anc"]).select(
            *NODE, F.col("next_anc").alias("anc"),
            (F.col("dist") + F.col("d")).alias("dist"),
            (F.col("hops") + F.col("h")).alias("hops"),
        )
        closure = materialize(closure.unionByName(further))
    return closure


def root_paths(edges: DataFrame, limit: int | None = None) -> DataFrame | None:
    """``tree_id, node_id, path``: the nodes from the root to each node, itself included, as
    ``struct<ord, node, length>``; none if a path has more than ``limit`` nodes
    (``SHALLOW``)."""
    limit = SHALLOW if limit is None else limit
    own = F.array(F.struct(
        F.col("child_ord").cast("int").alias("ord"), F.col("node_id").alias("node"),
        F.coalesce("branch_length", F.lit(0.0)).alias("length"),
    ))
    state = materialize_even(edges.select(*NODE, F.col("parent_id").alias("anc"), own.alias("path")), task_bytes=PATH_BYTES)
    measure = [F.count("anc").alias("n"), F.max(F.size("path")).alias("longest")]
    pending = state.where("anc is not null")
    found = state.agg(*measure).first()
    done = [state.where("anc is null")]
    while found["n"]:
        if found["longest"] > limit:
            return None
        above = state.select("tree_id", F.col("node_id").alias("anc"), F.col("anc").alias("next"), F.col("path").alias("above"))
        jumped = materialize_even(
            join_skewed(pending, above, ["tree_id", "anc"], found["n"]).select(
                *NODE, F.col("next").alias("anc"), F.concat("above", "path").alias("path")
            ),
            task_bytes=PATH_BYTES,
        )
        done.append(jumped.where("anc is null"))
        # nodes that have reached their root are not written again
        state = reduce(DataFrame.unionByName, [jumped, *done[:-1]])
        pending = jumped.where("anc is not null")
        found = jumped.agg(*measure).first()
    if (found["longest"] or 0) > limit:
        return None
    return reduce(DataFrame.unionByName, done).select(*NODE, "path")


def _before(df: DataFrame, keys: list[str], place: Column, value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over the rows before each one among those with equal
    ``keys``, in order of ``place`` (an integer) and node.

    Places are taken ``SIBLINGS`` at a time, so that a node with any number of children
    is summed up by many tasks.
    """
    piece = F.floor(place / SIBLINGS)
    rows = df.withColumn("__place", place).withColumn("__piece", piece)
    earlier = Window.unboundedPreceding, -1
    pieces = rows.groupBy(*keys, "__piece").agg(F.sum(value).alias("__sum"))
    ahead = F.sum("__sum").over(Window.partitionBy(*keys).orderBy("__piece").rowsBetween(*earlier))
    pieces = pieces.select(*keys, "__piece", F.coalesce(ahead, F.lit(0)).alias("__ahead"))
    inside = Window.partitionBy(*keys, "__piece").orderBy("__place", "node_id").rowsBetween(*earlier)
    rows = rows.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    rows = rows.join(pieces, [*keys, "__piece"])
    return rows.withColumn(name, F.col(name) + F.col("__ahead")).drop("__ahead", "__place", "__piece")


def interval_labels(edges: DataFrame) -> DataFrame:
    """``tree_id, node_id, entry, size, level, depth`` and what ``edges`` has of
    ``parent_id, is_tip``: ``entry`` numbers the nodes of a tree from 0 in the order of a
    walk that takes children by ``child_ord``, ``size`` counts the nodes of the clade, and
    ``is_first`` tells the first children.

    A node's clade is the interval from ``entry`` up to ``entry + size``, so ancestry
    is a comparison of numbers (``is_above``).
    """
    own = lifted(
        edges, sums={"size": F.lit(1).cast("bigint")}, carry=("parent_id", "child_ord", "is_tip")
    ).withColumn("parent", F.col("parent_id"))
    placed = _before(
        own.where("parent_id is not null"), ["tree_id", "parent"], F.col("child_ord").cast("bigint"), "size", "earlier"
    )
    # a node comes one after its parent and what is below the siblings before it
    moved = placed.withColumn("step", F.col("earlier") + 1).unionByName(
        own.where("parent_id is null").withColumn("earlier", F.lit(0).cast("bigint")).withColumn("step", F.lit(0).cast("bigint"))
    )
    stepped = moved.select(
        *NODE, "parent_id", F.col("step").cast("double").alias("branch_length"), "is_tip", "size",
        F.col("dist").alias("depth"), (F.col("earlier") == 0).alias("is_first"),
    )
    walked = lifted(stepped, carry=("parent_id", "is_tip", "size", "depth", "is_first"))
    return walked.select(
        *NODE, "parent_id", "is_tip", "is_first", F.col("dist").cast("bigint").alias("entry"), "size",
        (F.col("hops") - 1).alias("level"), "depth",
    )


def is_above(upper: str, lower: str) -> Column:
    """Whether the node with the columns ``<upper>_entry`` and ``<upper>_size`` is the one
    with ``<lower>_entry`` or an ancestor of it."""
    low, at = F.col(f"{upper}_entry"), F.col(f"{lower}_entry")
    return (at >= low) & (at < low + F.col(f"{upper}_size"))


def with_labels(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Node pairs ``tree_id, u, v`` with the interval of both, null for an unknown node."""
    out = pairs
    for node in ("u", "v"):
        out = _lookup(out, labels.select(*NODE, "entry", "size"), node, {"entry": f"{node}_entry", "size": f"{node}_size"})
    return out


def ancestor_pairs(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """Node pairs with ``u_above`` and ``v_above``: whether one is an ancestor of the other
    (of itself, too), by interval labels; null for an unknown node."""
    found = with_labels(pairs, interval_labels(edges))
    return found.select(*pairs.columns, is_above("u", "v").alias("u_above"), is_above("v", "u").alias("v_above"))


def _range_minimum(values: DataFrame, longest: int) -> list[DataFrame]:
    """Blocks of ``values`` (``tree_id, pos, value``, positions from 0 without gaps) as
    ``tree_id, block, held``, then blocks of the blocks' minima, up to one block a tree."""
    out = []
    while True:
        held = F.sort_array(F.collect_list(F.struct("pos", "value")))
        blocks = materialize(
            values.groupBy("tree_id", F.floor(F.col("pos") / BLOCK).alias("block"))
            .agg(F.transform(held, lambda x: x["value"]).alias("held"))
        )
        out.append(blocks)
        longest = -(-longest // BLOCK)
        if longest <= 1:
            return out
        values = blocks.select("tree_id", F.col("block").alias("pos"), F.array_min("held").alias("value"))


def _minimum_between(ranges: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``best``: the smallest value of each range ``low`` to ``high`` of positions; at every
    level a range takes from its two outer blocks and goes on with the blocks between."""
    kept = [c for c in ranges.columns if c not in ("low", "high")]
    work = ranges.withColumn("best", F.lit(None).cast(dict(levels[0].dtypes)["held"][6:-1]))
    for number, blocks in enumerate(levels):
        first, last = F.floor(F.col("low") / BLOCK), F.floor(F.col("high") / BLOCK)
        work = work.withColumn("first", F.when(F.col("low") <= F.col("high"), first))
        work = work.withColumn("last", F.when((F.col("low") <= F.col("high")) & (last > first), last))
        inner = F.when(F.col("last").isNull(), F.col("high") - F.col("low") + 1).otherwise(F.lit(BLOCK)).cast("int")
        from_first = F.array_min(F.slice("held", (F.col("low") % BLOCK + 1).cast("int"), inner))
        from_last = F.array_min(F.slice("held", F.lit(1), (F.col("high") % BLOCK + 1).cast("int")))
        for key, found in (("first", from_first), ("last", from_last)):
            side = blocks.withColumnRenamed("block", key)
            work = work.join(side, ["tree_id", key], "left").withColumn("best", F.least("best", found)).drop("held")
        work = work.select(
            *kept, "best", (F.col("first") + 1).alias("low"), (F.coalesce("last", "first") - 1).alias("high")
        )
        if number + 1 < len(levels):
            work = materialize(work)
    return work.drop("low", "high")


def mrca(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """Most recent common ancestor of node pairs ``(tree_id, pair_id, u, v)``.

    In trees of at most ``SHALLOW`` levels it is the last node that the paths of both to
    the root have in common.  In deeper ones, of the nodes entered after ``u`` up to
    ``v``, the one with the highest parent is a child of the common ancestor: a minimum
    over a range of entry numbers, answered from blocks of ``BLOCK`` nodes, blocks of
    blocks, and so on.  No pair walks up a tree and none meets the root.  Adds ``mrca``
    (node id), ``mrca_depth`` and ``age`` (height of the tree minus that depth); all null
    when a node is unknown.
    """
    paths = root_paths(edges)
    pairs = materialize_even(pairs.select("tree_id", "pair_id", "u", "v"))
    # nodes that are null would all be looked up by one task
    asked, unknown = pairs.where("u is not null and v is not null"), pairs.where("u is null or v is null")
    met, heights = _met_by_entry(edges, asked) if paths is None else _met_by_path(edges, paths, asked)
    types = dict(met.dtypes)
    nothing = {c: F.lit(None).cast(types[c]) for c in ("mrca", "mrca_depth")}
    met = met.unionByName(unknown.withColumns(nothing))
    return met.join(heights, "tree_id", "left").select(
        "tree_id", "pair_id", "u", "v", "mrca", "mrca_depth",
        (F.col("height") - F.col("mrca_depth")).alias("age"),
    )


def _depth(path: Column) -> Column:
    # from the node up, as sums along pointers go
    return F.aggregate(F.reverse(path), F.lit(0.0), lambda total, x: total + x["length"])


def _met_by_path(edges: DataFrame, paths: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    tips = edges.where("is_tip").select(*NODE)
    heights = paths.join(tips, NODE, "left_semi").groupBy("tree_id").agg(F.max(_depth(F.col("path"))).alias("height"))
    found = pairs.select("tree_id", "pair_id", "u", "v")
    for node in ("u", "v"):
        found = _lookup(found, paths, node, {"path": f"{node}_path"})
    both = F.zip_with("u_path", "v_path", lambda x, y: F.coalesce(x["node"] == y["node"], F.lit(False)))
    # nodes of two paths are equal up to the last common one
    shared = F.size(F.filter(both, lambda same: same))
    known = F.col("u_path").isNotNull() & F.col("v_path").isNotNull()
    common = F.when(known, F.slice("u_path", F.lit(1), shared))
    met = found.withColumn("common", common).select(
        "tree_id", "pair_id", "u", "v", F.element_at("common", -1)["node"].alias("mrca"),
        F.when(F.col("common").isNotNull(), _depth(F.col("common"))).alias("mrca_depth"),
    )
    return materialize_even(met, task_bytes=PATH_BYTES), materialize_even(heights, task_bytes=PATH_BYTES)


def _met_by_entry(edges: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    labels = materialize(interval_labels(edges))
    n = labels.count()
    parents = labels.select("tree_id", F.col("node_id").alias("parent_id"), F.col("depth").alias("parent_depth"))
    inner = labels.where("parent_id is not null")
    above = join_skewed(inner, parents, ["tree_id", "parent_id"], n).select(
        "tree_id", F.col("entry").alias("pos"),
        F.struct((F.col("level") - 1).alias("level"), F.col("parent_id").alias("node"), F.col("parent_depth").alias("depth")).alias("value"),
    )
    # the root, at position 0, is in no range
    blank = F.struct(F.lit(2**62).alias("level"), F.lit(None).cast("bigint").alias("node"), F.lit(None).cast("double").alias("depth"))
    roots = labels.where("parent_id is null").select("tree_id", F.col("entry").alias("pos"), blank.alias("value"))
    longest = labels.agg(F.max("size")).first()[0] or 1
    levels = _range_minimum(above.unionByName(roots), longest)

    heights = labels.where("is_tip").groupBy("tree_id").agg(F.max("depth").alias("height"))
    found = pairs.select("tree_id", "pair_id", "u", "v")
    for node in ("u", "v"):
        found = _lookup(found, labels.select(*NODE, "entry", "depth"), node, {"entry": f"{node}_at", "depth": f"{node}_depth"})
    ranges = found.withColumn("low", F.least("u_at", "v_at") + 1).withColumn("high", F.greatest("u_at", "v_at"))
    ranges = ranges.withColumn("known", F.col("u_at").isNotNull() & F.col("v_at").isNotNull())
    ranges = ranges.withColumn("high", F.when(F.col("known"), F.col("high")))
    met = _minimum_between(materialize(ranges), levels)
    same = F.col("u") == F.col("v")
    met = met.withColumn("mrca", F.when(F.col("known"), F.when(same, F.col("u")).otherwise(F.col("best.node"))))
    met = met.withColumn("mrca_depth", F.when(F.col("known"), F.when(same, F.col("u_depth")).otherwise(F.col("best.depth"))))
    return met.select("tree_id", "pair_id", "u", "v", "mrca", "mrca_depth"), heights


def _lookup(df: DataFrame, table: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Left join on a node column; ``table`` has one row per node."""
    side = table.select(
        "tree_id", F.col("node_id").alias(key), *[F.col(a).alias(b) for a, b in columns.items()]
    )
    return df.join(side, ["tree_id", key], "left")


def check_calibrations(
    edges: DataFrame, calibrations: DataFrame, tolerance: float = 1e-6
) -> DataFrame:
    """Compare calibrations ``(tree_id, name, sp1, sp2, age, min_age, max_age)``
    with the ages of a dated tree.

    Adds ``tree_age`` and ``status``: ``ok``, ``violated`` or ``unknown taxon``.
    """
    tips = edges.where("is_tip").select("tree_id", "node_id", "label")
    calibrations = materialize_even(calibrations)
    total, pair = calibrations.count(), calibrations
    for taxon, node in (("sp1", "u"), ("sp2", "v")):
        side = tips.select("tree_id", F.col("label").alias(taxon), F.col("node_id").alias(node))
        pair = pair.join(side, ["tree_id", taxon], "left")
    ages = mrca(edges, pair.select("tree_id", F.col("name").alias("pair_id"), "u", "v"))
    ages = ages.select("tree_id", F.col("pair_id").alias("name"), F.col("age").alias("tree_age"))
    key = ["tree_id", "name"]
    out = by_rows(calibrations, key, total).join(by_rows(ages, key, total), key)
    slack = F.lit(tolerance) * F.greatest(F.abs("tree_age"), F.lit(1.0))
    fits = (
        (F.col("age").isNull() | (F.abs(F.col("tree_age") - F.col("age")) <= slack))
        & (F.col("min_age").isNull() | (F.col("tree_age") >= F.col("min_age") - slack))
        & (F.col("max_age").isNull() | (F.col("tree_age") <= F.col("max_age") + slack))
    )
    status = (
        F.when(F.col("tree_age").isNull(), F.lit("unknown taxon"))
        .when(fits, F.lit("ok"))
        .otherwise(F.lit("violated"))
    )
    return out.withColumn("status", status)


def root_spanning_taxa(edges: DataFrame) -> DataFrame:
    """One tip from each side of the root: the smallest label below each child."""
    tip = F.when(F.col("is_tip"), F.col("label"))
    nodes = lifted(edges, merges={"low_tip": (tip, "min")}, carry=("child_ord",))
    # the children of the root are the nodes whose path to it has two nodes
    return nodes.where("hops = 2").select("tree_id", "child_ord", "low_tip")


# -- clades, topology and pruning ------------------------------------------------


def clade_signatures(edges: DataFrame) -> DataFrame:
    """``sig1, sig2, n_tips`` of the tip set below each node.

    The two signatures are exclusive-or sums of two independent 64-bit hashes
    of the tip labels, so a clade's set is compared in constant space.
    """
    def hashed(seed: int) -> Column:
        h = F.xxhash64(F.lit(seed), F.col("label"))
        return F.when(F.col("is_tip"), h).otherwise(F.lit(0).cast("bigint"))

    count = F.when(F.col("is_tip"), F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    final = lifted(
        edges,
        sums={"n_tips": count},
        merges={"sig1": (hashed(1), "bit_xor"), "sig2": (hashed(2), "bit_xor")},
    )
    return final.select(*NODE, "sig1", "sig2", "n_tips")


def clade_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Clades of one tree that the other lacks: ``tree_id, node_id, side, n_tips``
    with ``side`` ``'only_a'`` or ``'only_b'``; trees are matched by ``tree_id``
    and branch lengths are ignored."""
    sa, sb = clade_signatures(a), clade_signatures(b)
    key = ["tree_id", "sig1", "sig2", "n_tips"]
    sa, sb = (by_rows(side, key, side.count()) for side in (sa, sb))
    only_a = sa.join(sb.select(*key), key, "left_anti").withColumn("side", F.lit("only_a"))
    only_b = sb.join(sa.select(*key), key, "left_anti").withColumn("side", F.lit("only_b"))
    return only_a.unionByName(only_b).select(*NODE, "side", "n_tips")


def same_topology(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per tree, whether tips and clades agree (branch lengths ignored)."""
    differing = clade_differences(a, b).groupBy("tree_id").agg(F.count("*").alias("n"))
    trees = a.select("tree_id").union(b.select("tree_id")).distinct()
    told = trees.join(differing, "tree_id", "left").select(
        "tree_id", F.col("n").isNull().alias("same_topology")
    )
    return materialize_even(told)


def strip_support(edges: DataFrame) -> DataFrame:
    """Remove labels of internal nodes (support values); tips and lengths stay."""
    return edges.withColumn("label", F.when(F.col("is_tip"), F.col("label")))


def prune(edges: DataFrame, tips: DataFrame, mode: str = "time") -> DataFrame:
    """Keep the given tips ``(tree_id, label)`` and the branchings between them.

    Nodes left with a single child collapse into it: ``mode='time'`` adds the
    branch lengths up, ``mode='class'`` keeps the child's value.  A new root has
    no branch length.
    """
    if mode not in ("time", "class"):
        raise ValueError(f"mode must be 'time' or 'class', got {mode!r}")
    wanted = tips.select("tree_id", "label").distinct().withColumn("wanted", F.lit(True))
    flagged = edges.join(wanted, ["tree_id", "label"], "left").withColumn(
        "is_wanted", F.col("is_tip") & F.col("wanted").isNotNull()
    ).drop("wanted")
    count = F.col("is_wanted").cast("bigint")
    carried = ("parent_id", "label", "branch_length", "is_tip", "child_ord")
    counted = lifted(flagged, sums={"n_kept": F.coalesce(count, F.lit(0))}, carry=carried)
    live_edges = counted.where("n_kept > 0").select(*NODE, *carried)
    children = (
        live_edges.where("parent_id is not null")
        .groupBy("tree_id", F.col("parent_id").alias("node_id"))
        .agg(F.count("*").alias("n_children"))
    )
    kept = F.col("is_tip") | (F.coalesce(F.col("n_children"), F.lit(0)) >= 2)
    nodes = materialize(live_edges.join(children, NODE, "left").withColumn("kept", kept))

    parents = nodes.select("tree_id", F.col("node_id").alias("anc"), F.col("kept").alias("anc_kept"))
    state = nodes.withColumn("anc", F.col("parent_id")).join(
        parents, ["tree_id", "anc"], "left"
    ).select(
        *NODE, "label", "is_tip", "kept", "anc", "child_ord",
        F.col("branch_length").alias("own_length"),
        F.coalesce("branch_length", F.lit(0.0)).alias("span"),
        F.col("parent_id").isNull().alias("was_root"),
        (F.col("anc").isNull() | F.col("anc_kept")).alias("done"),
    )
    state = materialize(state)
    while n_pending := state.where("not done").count():
        above = state.select(
            "tree_id", F.col("node_id").alias("anc"), F.col("anc").alias("next_anc"),
            F.col("span").alias("above_span"), F.col("child_ord").alias("above_ord"),
            F.col("done").alias("above_done"),
        )
        pending = state.where("not done")
        jumped = join_skewed(pending, above, ["tree_id", "anc"], n_pending).select(
            *NODE, "label", "is_tip", "kept",
            F.col("next_anc").alias("anc"),
            F.col("above_ord").alias("child_ord"),
            "own_length",
            (F.col("span") + F.col("above_span")).alias("span"),
            "was_root",
            F.col("above_done").alias("done"),
        )
        state = materialize(jumped.unionByName(state.where("done")))
    length = F.col("span") if mode == "time" else F.col("own_length")
    new_root = F.col("anc").isNull() & ~F.col("was_root")
    return state.where("kept").select(
        *NODE,
        F.col("anc").alias("parent_id"),
        "label",
        F.when(new_root, F.lit(None))
        .when(F.col("anc").isNull(), F.col("own_length"))
        .otherwise(length)
        .alias("branch_length"),
        "is_tip",
        F.when(F.col("anc").isNull(), F.lit(0)).otherwise(F.col("child_ord")).cast("int").alias("child_ord"),
    )
