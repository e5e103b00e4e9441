"""Newick text to edge rows and back, in DataFrame operations.

Reading is a balanced-bracket scan: texts become token rows, the depth of a token is a
prefix sum over brackets, and the node that a token belongs to is the last one opened
at its depth.  A text is one cell, so its tokens stay in one partition: all windows and
groups of a tree are worked where it is, with sorts that spill.  Writing gives every node a
place before and a place after its clade and puts the places in the order of a walk: by
the paths to the root, or by entry numbers where trees are deep.  The paths of small trees
are found inside one row a tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.trees import NODE, interval_labels, root_paths
from ..runtime import DataError, materialize

#: Nodes up to which a tree is written from one row.
SMALL = 64
#: Characters of texts that are read by one task; a tree is never cut.
TEXT_CHARS = 1 << 20

#: Every character belongs to a token; a lone bracket or quote is one that never closes.
TOKEN = r"\s+|\[[^\]]*\]|'(?:[^']|'')*'|[(),:;]|[^\s(),:;\[\]']+|[\[\]']"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _tokens(df: DataFrame, tree_id: str, newick: str) -> DataFrame:
    """``tree, tree_id, at, token, before, before2, after`` of the tokens that count, after
    an empty one at -1 that stands for the root; ``tree`` tells rows with equal ids apart.
    All rows of a tree are in one partition from here on."""
    rows = df.select(F.col(tree_id).cast("string").alias("tree_id"), F.col(newick).alias("newick"))
    # a character takes hundreds of bytes as rows of tokens, so tasks are made by length
    rows = materialize(rows.withColumn("tree", F.monotonically_increasing_id()))
    total = rows.agg(F.sum(F.length("newick"))).first()[0] or 0
    rows = rows.repartition(max(1, -(-total // TEXT_CHARS)), "tree")
    found = F.regexp_extract_all(F.coalesce("newick", F.lit("")), F.lit(TOKEN), F.lit(0))
    counted = F.filter(found, lambda t: ~t.rlike(r"^(\s|\[.)"))
    rows = rows.select("tree", "tree_id", F.concat(F.array(F.lit("")), counted).alias("tokens"))
    each = rows.select("tree", "tree_id", "tokens", F.posexplode("tokens").alias("place", "token"))
    return each.select(
        "tree", "tree_id", (F.col("place") - 1).cast("bigint").alias("at"), "token",
        F.get("tokens", F.col("place") - 1).alias("before"), F.get("tokens", F.col("place") - 2).alias("before2"),
        F.get("tokens", F.col("place") + 1).alias("after"),
    )


def _problem() -> Column:
    """What is wrong with a token, by itself, the tokens around it, and the depth."""
    token, before, outer = F.col("token"), F.col("before"), F.col("depth") - F.col("turn")
    structural = token.isin(*"(),:;")
    is_last = F.col("after").isNull()
    after_length = (F.col("before2") == ":") & ~before.isin(*"(),:;")
    opens = before.isin("", "(", ",")
    alone = (F.col("at") == 0) | ((F.col("at") == 2) & (F.col("before2") == ":"))
    return (
        F.when((token == "") & is_last, F.lit("empty tree"))
        .when(token == "", F.lit(None))
        .when(token.isin("[", "]", "'"), F.concat(F.lit("unclosed '"), token, F.lit("'")))
        .when(before == ";", F.concat(F.lit("text after the end of the tree: '"), token, F.lit("'")))
        .when((before == ":") & structural, F.lit("missing branch length"))
        .when((before == ":") & ~token.rlike(NUMBER), F.concat(F.lit("no branch length: '"), token, F.lit("'")))
        .when((token == "(") & ~opens, F.lit("unexpected '('"))
        .when(token.isin(",", ")") & (outer < 1), F.concat(F.lit("unbalanced '"), token, F.lit("'")))
        .when((token == ":") & after_length, F.lit("second branch length"))
        .when((token == ";") & (outer > 0), F.lit("unbalanced '('"))
        .when(
            ~structural & (before != ":") & ~opens & (before != ")"),
            F.concat(F.lit("unexpected '"), token, F.lit("'")),
        )
        .when(is_last & (token != ";") & (F.col("depth") > 0), F.lit("unbalanced '('"))
        .when((token == ";") & alone, F.lit("empty tree"))
        .when(is_last & (token != ";"), F.lit("no ';' at the end"))
    )


def newick_to_edges(df: DataFrame, tree_id="tree_id", newick="newick") -> DataFrame:
    """One row per node of every tree that ends in ``;``, numbered in the order they open,
    with an ``error`` column: a tree that cannot be read gives one row that holds only its
    id and the error, the first one in its text."""
    token, text = F.col("token"), Window.partitionBy("tree")
    along = text.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    turn = F.when(token == "(", 1).when(token == ")", -1).otherwise(0)
    opens = token.isin("(", ",", "")
    scanned = _tokens(df, tree_id, newick).withColumn("turn", turn)
    scanned = scanned.withColumns({"depth": F.sum("turn").over(along), "node_id": F.sum(opens.cast("bigint")).over(along) - 1})
    problem = F.struct("at", _problem().alias("text"))
    first = F.min(F.when(_problem().isNotNull(), problem)).over(text)
    scanned = scanned.withColumn("error", first["text"]).where("error is null or at = -1")

    # what a token asks at a depth, or offers there.  A node that opens is offered to all
    # that come at its depth, and asks one depth further out for its parent; a label or a
    # length asks for its node
    good = F.col("error").isNull()
    blank, nothing = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    inner = F.col("after") == "("

    def role(level: Column, offers: Column, asks: Column, value: Column) -> Column:
        return F.struct(level.cast("int").alias("level"), offers.alias("offers"), asks.alias("asks"), value.alias("value"))

    node = role(F.col("depth"), F.col("node_id"), blank, nothing)
    parent = role(F.col("depth") - 1, blank, F.col("node_id"), F.when(inner, F.lit("(")).otherwise(F.lit("")))
    tells = role(F.col("depth"), blank, blank, token)
    roles = F.when(~good, F.array(parent)).when(opens, F.array(node, parent)).when(
        ~token.isin(*"(),:;"), F.array(tells)
    )
    is_length = F.coalesce(F.col("before") == ":", F.lit(False)).alias("is_length")
    placed = scanned.select("tree", "tree_id", "error", "at", is_length, F.inline(roles))
    # an offer counts for what comes after it
    at_level = Window.partitionBy("tree", "level").orderBy("at", F.col("offers").isNotNull())
    owner = F.max("offers").over(at_level.rowsBetween(Window.unboundedPreceding, 0))
    answered = placed.withColumn("owner", owner).where("offers is null")
    asked, value = F.col("asks").isNotNull(), F.col("value")
    quoted = F.replace(F.expr("substring(value, 2, length(value) - 2)"), F.lit("''"), F.lit("'"))
    label = F.when(value.startswith("'"), quoted).otherwise(value)
    nodes = answered.groupBy("tree", F.coalesce("asks", "owner").alias("node_id")).agg(
        F.first("tree_id").alias("tree_id"), F.max("error").alias("error"),
        F.max(F.when(asked, F.col("owner"))).alias("parent_id"),
        F.max(F.when(~asked & ~F.col("is_length"), label)).alias("label"),
        F.max(F.when(~asked & F.col("is_length"), value.try_cast("double"))).alias("branch_length"),
        F.max(F.when(asked, value)).alias("inner"),
    )
    siblings = Window.partitionBy("tree", "parent_id").orderBy("node_id")
    fine = F.col("error").isNull()
    rank = F.when(F.col("parent_id").isNull(), 0).otherwise(F.row_number().over(siblings) - 1)
    return nodes.withColumn("rank", rank).select(
        "tree_id", F.when(fine, F.col("node_id")).alias("node_id"), "parent_id", "label", "branch_length",
        F.when(fine, F.col("inner") == "").alias("is_tip"), F.when(fine, F.col("rank")).cast("int").alias("child_ord"), "error",
    )


def read_newick(spark: SparkSession, path) -> DataFrame:
    """Trees from text files, one per file, named after the file."""
    texts = spark.read.text(path, wholetext=True).select(
        F.regexp_extract("_metadata.file_name", r"^(.*?)(\.[^.]*)?$", 1).alias("tree_id"),
        F.col("value").alias("newick"),
    )
    return newick_to_edges(texts)


def _quoted(label: Column) -> Column:
    special = label.rlike(r"[\s(),:;\[\]']")
    escaped = F.concat(F.lit("'"), F.replace(label, F.lit("'"), F.lit("''")), F.lit("'"))
    return F.when(special, escaped).otherwise(label)


def format_length(value: Column) -> Column:
    """Shortest decimal text; whole numbers without a fraction."""
    whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
    return F.when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string"))


def edges_to_newick(
    edges: DataFrame, value_col: str = "branch_length", internal_labels: bool = False
) -> DataFrame:
    """``tree_id, newick`` with ``value_col`` in the length slot, children in
    ``child_ord`` order and no root edge.

    A node opens before its clade and closes, with its label and length, after it.  In the
    order of a walk these places are the text of the tree, however deep it is; brackets
    and commas follow from what stands next to each other.
    """
    label = F.col("label") if internal_labels else F.when(F.col("is_tip"), F.col("label"))
    value = F.col(value_col).cast("double")
    suffix = F.when(
        F.col("parent_id").isNotNull() & value.isNotNull(),
        F.concat(F.lit(":"), format_length(value)),
    ).otherwise(F.lit(""))
    tail = F.concat(F.coalesce(_quoted(label), F.lit("")), suffix).alias("tail")
    kept = [*NODE, "parent_id", "child_ord", "branch_length", "is_tip"]
    nodes = materialize(edges.where("tree_id is not null").select(*kept, tail))
    sizes = nodes.groupBy("tree_id").agg(F.count("*").alias("n"))
    if (sizes.agg(F.max("n")).first()[0] or 0) <= SMALL:
        return _small_trees(nodes)
    large = materialize(sizes.where(F.col("n") > SMALL).select("tree_id"))
    small = _small_trees(nodes.join(large, "tree_id", "left_anti"))
    return small.unionByName(_large_trees(nodes.join(large, "tree_id", "left_semi")))


def _text(places: Column) -> Column:
    """The text of a tree from the places ``place, side, tail`` of its nodes, sorted."""

    def told(held: Column, part: Column, i: Column) -> Column:
        """A node that opens after one that closed is its sibling, a node that opens before
        another opens has children, and one that closes after another closed had some."""
        before, after = F.get(held, i - 1)["side"], F.get(held, i + 1)["side"]
        return (
            F.when((part["side"] == 0) & (before == 1) & (after == 0), F.lit(",("))
            .when((part["side"] == 0) & (before == 1), F.lit(","))
            .when((part["side"] == 0) & (after == 0), F.lit("("))
            .when(part["side"] == 0, F.lit(""))
            .when(before == 1, F.concat(F.lit(")"), part["tail"]))
            .otherwise(part["tail"])
        )

    # in an array of one, so that the sorted places are made once
    told_all = F.transform(F.array(places), lambda held: F.array_join(F.transform(held, lambda part, i: told(held, part, i)), ""))
    return F.concat(F.get(told_all, F.lit(0)), F.lit(";"))


def _large_trees(nodes: DataFrame) -> DataFrame:
    tailed, paths = nodes.select(*NODE, "tail"), root_paths(nodes)
    parts = _by_path(paths, tailed) if paths is not None else _by_entry(interval_labels(nodes), tailed)
    held = F.sort_array(F.collect_list(F.struct("place", "side", "tail")))
    return parts.groupBy("tree_id").agg(held.alias("held")).select("tree_id", _text(F.col("held")).alias("newick"))


def _small_trees(nodes: DataFrame) -> DataFrame:
    """Texts of trees of at most ``SMALL`` rows, each from one row that holds its nodes:
    the joins of ``root_paths`` and ``_by_path`` within an array."""
    held = F.collect_list(F.struct("node_id", "parent_id", F.col("child_ord").cast("long").alias("ord"), "tail"))
    rows = nodes.groupBy("tree_id").agg(held.alias("held"))
    own = F.transform("held", lambda x: F.struct(
        x["node_id"].alias("node"), x["parent_id"].alias("anc"),
        F.array(F.struct(x["ord"].alias("ord"), x["node_id"].alias("node"))).alias("path"),
    ))

    def jumped(state: Column) -> Column:
        """Every node's path joined to that of the node its pointer shows."""
        return F.flatten(F.transform(state, lambda x: F.when(x["anc"].isNull(), F.array(x)).otherwise(
            F.transform(F.filter(state, lambda y: y["node"] == x["anc"]), lambda y: F.struct(
                x["node"].alias("node"), y["anc"].alias("anc"), F.concat(y["path"], x["path"]).alias("path"),
            ))
        )))

    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size("held"))).cast("int"))
    rows = rows.select("tree_id", "held", F.aggregate(rounds, own, lambda state, _: jumped(state)).alias("paths"))
    last = F.array(F.struct(F.lit(2**62).alias("ord"), F.lit(0).cast("bigint").alias("node")))
    sides = F.flatten(F.flatten(F.transform("paths", lambda p: F.transform(
        F.filter("held", lambda x: x["node_id"] == p["node"]), lambda x: F.array(
            F.struct(p["path"].alias("place"), F.lit(0).alias("side"), F.lit("").alias("tail")),
            F.struct(F.concat(p["path"], last).alias("place"), F.lit(1).alias("side"), x["tail"].alias("tail")),
        )
    ))))
    cyclic = F.exists("paths", lambda x: x["anc"].isNotNull())
    texts = materialize(rows.select("tree_id", cyclic.alias("cyclic"), F.when(F.size(sides) > 0, _text(F.sort_array(sides))).alias("newick")))
    if not texts.where("cyclic").isEmpty():
        raise DataError("the parent links of a tree form a cycle")
    return texts.where("newick is not null").select("tree_id", "newick")


def _by_path(paths: DataFrame, tailed: DataFrame) -> DataFrame:
    """Both places of every node in the order of a walk: the ranks and numbers on its path,
    and the same with what comes after all below it."""
    step = F.transform("path", lambda x: F.struct(x["ord"].cast("long").alias("ord"), x["node"].alias("node")))
    last = F.array(F.struct(F.lit(2**62).alias("ord"), F.lit(0).cast("bigint").alias("node")))
    sides = F.array(
        F.struct(step.alias("place"), F.lit(0).alias("side"), F.lit("").alias("tail")),
        F.struct(F.concat(step, last).alias("place"), F.lit(1).alias("side"), F.col("tail").alias("tail")),
    )
    return paths.join(tailed, NODE).select("tree_id", F.inline(sides))


def _by_entry(labels: DataFrame, tailed: DataFrame) -> DataFrame:
    """The same for trees of any depth, by entry numbers: a node closes with the last node
    of its clade, the deepest first."""
    place = lambda at, side, up: F.struct(at.alias("at"), side.alias("side"), up.alias("up"))
    none = F.lit(0).cast("bigint")
    closes = F.col("entry") + F.col("size") - 1
    sides = F.array(
        F.struct(place(F.col("entry"), F.lit(0), none).alias("place"), F.lit(0).alias("side"), F.lit("").alias("tail")),
        F.struct(place(closes, F.lit(1), -F.col("level")).alias("place"), F.lit(1).alias("side"), F.col("tail").alias("tail")),
    )
    return labels.join(tailed, NODE).select("tree_id", F.inline(sides))


def write_newick(trees: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One line per tree."""
    trees.select(F.col("newick").alias("value")).write.mode(mode).text(path)
