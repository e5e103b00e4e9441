import random

import pytest
from pyspark.sql import functions as F

from cladeframe import runtime
from cladeframe.operators import checks as V
from cladeframe.operators import trees as T
from cladeframe.sources import newick as N

#: Six leaves on two sides, with numbers, a quoted number and a name as inner labels.
BIRDS = "(((asp:.5,boa:1.250)rank:2,moa:0.75)17:1,(emu:3e-1,(rhea:.2,kiwi:.45)'8 8':1.5):.25);"
BIRD_DEPTHS = {"asp": 3.5, "boa": 4.25, "moa": 1.75, "emu": 0.55, "rhea": 1.95, "kiwi": 2.2}
#: Seven leaves, each 30 below the root.
DATED = "((owl:12,(kite:5,hawk:5):7):18,((eel:3,(ray:2,cod:2):1):9,(newt:8,toad:8):4):18);"
DATED_LEAVES = ["cod", "eel", "hawk", "kite", "newt", "owl", "ray", "toad"]


def codes(report):
    return sorted((r["subject"], r["code"]) for r in report.where("severity = 'ERROR'").collect())


def test_parse_and_write(trees, rows):
    e = trees(a=BIRDS, b=DATED, q="('it''s x':1,b_c[note]:2e-1)r;")
    assert e.where("error is not null").count() == 0
    text = dict(rows(N.edges_to_newick(e)))
    assert text["b"] == DATED
    assert text["a"] == "(((asp:0.5,boa:1.25):2,moa:0.75):1,(emu:0.3,(rhea:0.2,kiwi:0.45):1.5):0.25);"
    labelled = dict(rows(N.edges_to_newick(e, internal_labels=True)))
    assert labelled["a"] == "(((asp:0.5,boa:1.25)rank:2,moa:0.75)17:1,(emu:0.3,(rhea:0.2,kiwi:0.45)'8 8':1.5):0.25);"
    assert labelled["q"].startswith("('it''s x':1,")


@pytest.mark.parametrize("shallow", [64, 1])
def test_texts_of_many_shapes(trees, rows, monkeypatch, shallow):
    """What is read is what was written, by paths and by entry numbers."""
    monkeypatch.setattr(T, "SHALLOW", shallow)
    rng = random.Random(6)
    texts = {f"r{i}": random_tree(rng.randint(2, 25), rng, i % 2 == 0) for i in range(8)}
    texts |= {"one": "x;", "unary": "((((a:1)));", "inner": "((a,b)c,(d)e)f;", "star": "(" + ",".join(f"s{i}" for i in range(30)) + ");"}
    texts["unary"] = "((((a:1))));"
    e = trees(**texts)
    assert e.where("error is not null").count() == 0
    assert dict(rows(N.edges_to_newick(e, internal_labels=True))) == texts


@pytest.mark.parametrize("text", [
    "(p,(q,r);", "(p,q)),r;", "(p:,q);", "(p:long,q);", "", ";", "(p q);", "(p,q);r", "([p,q);", "('p,q);",
    "(p]x,q);", "(p,q)", "(p,q)[unclosed;", "(p:nan,q:1);", "(p:1_0,q:1);", "(p:1:2,q);", "(p,q:1 r);",
])
def test_unreadable_trees(trees, text):
    bad = trees(t=text, ok="(p:1,q[x]:.5e1[]) ;")
    assert [r["tree_id"] for r in bad.where("error is not null").collect()] == ["t"]
    assert codes(V.validate_tree(bad)) == [("t", "unreadable_tree")]


def test_shape(trees):
    e = trees(good=DATED, poly="(p:5,(q:2,r:2,s:2):3);", tri="(p:4,q:4,r:4);", unary="(p:6,(q:5):1);")
    assert codes(V.validate_tree(e)) == [("poly", "polytomy"), ("tri", "not_rooted"), ("tri", "polytomy")]
    info = V.validate_tree(e).where("code = 'unary_nodes'").collect()
    assert [r["subject"] for r in info] == ["unary"]


def test_ultrametric(trees):
    e = trees(a=BIRDS, b=DATED, near="((p:1,q:1):2,(r:.5,s:.503):2.5);", far="((p:1,q:1):2,(r:.5,s:30.5):2.5);")
    got = {r["tree_id"]: r for r in T.is_ultrametric(e).collect()}
    assert {k: r["is_ultrametric"] for k, r in got.items()} == {"a": False, "b": True, "near": True, "far": False}
    assert got["b"]["deviation"] == 0.0 and got["far"]["deviation"] == 30.0
    depths = {r["label"]: r["depth"] for r in T.tip_depths(e.where("tree_id = 'a'")).collect()}
    assert depths == pytest.approx(BIRD_DEPTHS)
    rooted = trees(r="(p:3,q:3):8;")
    assert {r["depth"] for r in T.tip_depths(rooted).collect()} == {11.0}


def test_tips_and_support(trees, table, rows):
    species = table([(x,) for x in ("asp", "boa", "gull", "rhea", "emu", "tern")], "species string")
    assert rows(V.tip_species_diff(trees(t=BIRDS), species), "name", "side") == [
        ("gull", "only_in_list"), ("kiwi", "only_in_tree"), ("moa", "only_in_tree"), ("tern", "only_in_list")]
    stripped = T.strip_support(trees(a=BIRDS))
    assert {r["label"] for r in stripped.collect()} == {None, *BIRD_DEPTHS}
    sides = rows(T.root_spanning_taxa(trees(a=BIRDS, b=DATED)), "tree_id", "low_tip")
    assert sides == [("a", "asp"), ("a", "emu"), ("b", "cod"), ("b", "hawk")]


def test_tips_are_compared_tree_by_tree(trees, table, rows, monkeypatch):
    one = trees(x="(p:1,q:1);", y="(r:1,s:1);")
    swapped = trees(x="(r:1,s:1);", y="(p:1,q:1);").withColumnRenamed("branch_length", "class")
    assert rows(V.validate_class_tree(one.withColumnRenamed("branch_length", "class"), one)) == []
    report = V.validate_class_tree(swapped, one)
    assert rows(report, "subject", "detail") == [
        ("p", "x: only_in_list"), ("p", "y: only_in_tree"), ("q", "x: only_in_list"), ("q", "y: only_in_tree"),
        ("r", "x: only_in_tree"), ("r", "y: only_in_list"), ("s", "x: only_in_tree"), ("s", "y: only_in_list")]
    # one list for all trees, in blocks smaller than the list
    monkeypatch.setattr(V, "BLOCK", 2)
    listed = table([(c,) for c in "oprst"], "species string")
    assert rows(V.tip_species_diff(one, listed)) == [
        ("x", "o", "only_in_list"), ("x", "q", "only_in_tree"),
        *[("x", c, "only_in_list") for c in "rst"], *[("y", c, "only_in_list") for c in "opt"]]
    assert rows(V.tip_species_diff(one, listed.where("false")), "tree_id", "name") == [
        ("x", "p"), ("x", "q"), ("y", "r"), ("y", "s")]
    unread = trees(z="(p,q")
    assert rows(V.tip_species_diff(unread, listed.where("species < 'q'")), "name") == [("o",), ("p",)]


def random_tree(n, rng, ladder=False):
    nodes = [f"t{i}:{rng.randint(1, 9)}" for i in range(n)]
    while len(nodes) > 2:
        a = nodes.pop(0 if ladder else rng.randrange(len(nodes)))
        b = nodes.pop(0 if ladder else rng.randrange(len(nodes)))
        nodes.insert(0 if ladder else rng.randrange(len(nodes) + 1), f"({a},{b}):{rng.randint(1, 9)}")
    return f"({nodes[0]},{nodes[1]});"


def chains(rows_):
    parent = {r["node_id"]: r["parent_id"] for r in rows_}
    out = {}
    for n in parent:
        path, x = [], n
        while x is not None:
            path.append(x)
            x = parent[x]
        out[n] = path
    return out


@pytest.mark.parametrize("ladder, shallow", [(False, 64), (True, 64), (False, 3)])
def test_ancestors_mrca_and_pruning_against_walking(trees, spark, ladder, shallow, monkeypatch):
    monkeypatch.setattr(T, "SHALLOW", shallow)
    # the hot-key path of the joins, for a tree far below its threshold
    monkeypatch.setattr(runtime, "HOT_ROWS", 4)
    monkeypatch.setattr(runtime, "HOT_SHARE", 20)
    rng = random.Random(5)
    e = trees(t=random_tree(40, rng, ladder)).drop("error").cache()
    nodes = e.collect()
    path = chains(nodes)
    length = {r["node_id"]: r["branch_length"] or 0.0 for r in nodes}
    got = {(r["node_id"], r["anc"], r["hops"]) for r in T.ancestors(e).collect()}
    assert got == {(n, a, i) for n, p in path.items() for i, a in enumerate(p)}
    pairs = [(i, rng.choice(nodes)["node_id"], rng.choice(nodes)["node_id"]) for i in range(60)]
    df = spark.createDataFrame([("t", *p) for p in pairs], "tree_id string, pair_id int, u long, v long")
    met = {r["pair_id"]: r["mrca"] for r in T.mrca(e, df).collect()}
    assert met == {i: next(a for a in path[u] if a in path[v]) for i, u, v in pairs}

    below = {n: {m for m, p in path.items() if n in p} for n in path}
    labels = {r["node_id"]: r for r in T.interval_labels(e).collect()}
    for n, r in labels.items():
        inside = {m for m, x in labels.items() if r["entry"] <= x["entry"] < r["entry"] + r["size"]}
        assert inside == below[n] and r["level"] == len(path[n]) - 1
        assert r["depth"] == pytest.approx(sum(length[x] for x in path[n]))
    above = {r["pair_id"]: (r["u_above"], r["v_above"]) for r in T.ancestor_pairs(e, df).collect()}
    assert above == {i: (u in path[v], v in path[u]) for i, u, v in pairs}

    tips = [r for r in nodes if r["is_tip"]]
    wanted = [r for r in tips if rng.random() < 0.3] or tips[:2]
    keep = spark.createDataFrame([("t", r["label"]) for r in wanted], "tree_id string, label string")
    for mode in ("time", "class"):
        pruned = {r["node_id"]: r for r in T.prune(e, keep, mode).collect()}
        below = {}
        for r in wanted:
            for child, anc in zip([None, *path[r["node_id"]]], path[r["node_id"]]):
                below.setdefault(anc, set()).add(child)
        expected = {n for n, c in below.items() if c == {None} or len(c) > 1}
        assert set(pruned) == expected
        for n, r in pruned.items():
            up = next((a for a in path[n][1:] if a in expected), None)
            assert r["parent_id"] == up
            if up is not None:
                span = sum(length[x] for x in path[n][: path[n].index(up)])
                assert r["branch_length"] == (span if mode == "time" else length[n])
    with pytest.raises(ValueError):
        T.prune(e, keep, "other")


def test_mrca_over_many_blocks(trees, spark, monkeypatch):
    """Three levels of blocks; several trees; unknown nodes; a node with itself."""
    monkeypatch.setattr(T, "BLOCK", 4)
    monkeypatch.setattr(T, "SIBLINGS", 3)
    monkeypatch.setattr(T, "SHALLOW", 1)
    rng = random.Random(9)
    star = "(" + ",".join(f"t{i}:{i + 1}" for i in range(30)) + "):2;"
    texts = {"a": random_tree(30, rng), "b": random_tree(25, rng, True), "star": star, "leaf": "x;"}
    e = trees(**texts).drop("error").cache()
    nodes = e.collect()
    expected, pairs = {}, []
    for tree in texts:
        path = chains([r for r in nodes if r["tree_id"] == tree])
        for u in [*path, None, 999]:
            for v in rng.sample([*path, 999], min(4, len(path) + 1)):
                key = len(pairs)
                pairs.append((tree, key, u, v))
                known = u in path and v in path
                expected[key] = next(a for a in path[u] if a in path[v]) if known else None
    df = spark.createDataFrame(pairs, "tree_id string, pair_id int, u long, v long")
    got = T.mrca(e, df).collect()
    assert {r["pair_id"]: r["mrca"] for r in got} == expected
    assert all((r["mrca"] is None) == (r["mrca_depth"] is None) for r in got)
    entries = sorted((r["tree_id"], r["entry"]) for r in T.interval_labels(e).collect())
    sizes = {tree: sum(r["tree_id"] == tree for r in nodes) for tree in texts}
    assert entries == sorted((tree, i) for tree, n in sizes.items() for i in range(n))


def test_topology(trees, rows):
    a = trees(x="(r:2,(p:7,q:7):1);", y="(r,(p,q));", z="(r,(p,q));")
    b = trees(x="((q:3,p:3):3,r:8);", y="(p,(r,q));", z="(s,(p,q));")
    assert rows(T.same_topology(a, b)) == [("x", True), ("y", False), ("z", False)]


def test_calibrations_against_tree(trees, table, rows):
    from cladeframe.functions.specs import parse_calibrations

    e = trees(t=DATED)
    cals = table(
        [("t", "raptors", "hawk", "kite", 5.0, None, None), ("t", "birds", "kite", "owl", 11.0, None, None),
         ("t", "root", "owl", "toad", None, 40.0, 45.0), ("t", "water", "cod", "newt", None, 10.0, None),
         ("t", "fish", "eel", "ray", None, None, 2.5), ("t", "odd", "eel", "gull", 3.0, None, None)],
        "tree_id string, name string, sp1 string, sp2 string, age double, min_age double, max_age double")
    got = T.check_calibrations(e, cals)
    assert rows(got, "name", "tree_age", "status") == [
        ("birds", 12.0, "violated"), ("fish", 3.0, "violated"), ("odd", None, "unknown taxon"),
        ("raptors", 5.0, "ok"), ("root", 30.0, "violated"), ("water", 12.0, "ok")]
    specs = table([("pair:ray,cod:2",), ("x:eel,gull:12",), ("y:owl:3",), ("z:tern,gull:1-2",)], "spec string")
    report = V.validate_calibrations(parse_calibrations(specs), e)
    assert rows(report, "code", "subject", "detail") == [
        ("malformed", "y:owl:3", "not two taxa"), ("unknown_taxon", "x", "t: gull"),
        ("unknown_taxon", "z", "t: gull"), ("unknown_taxon", "z", "t: tern")]
    # a calibration belongs to all trees, or to the one it names
    both = trees(t=DATED, u="((gull:1,eel:1):1,tern:2);")
    own = parse_calibrations(specs.where("spec like 'x%'"))
    assert rows(V.validate_calibrations(own, both), "detail") == [("t: gull",)]
    scoped = own.withColumn("tree_id", F.lit("u"))
    assert V.validate_calibrations(scoped, both).count() == 0
    none = V.validate_calibrations(parse_calibrations(specs.where("false")), e)
    assert [r["code"] for r in none.collect()] == ["root_anchor"]


def classes(*odd):
    """The dated tree with classes 1 to 3 by leaf name; ``odd`` are exchanged texts."""
    text = "((owl:3,(kite:1,hawk:1):1):2,((eel:2,(ray:2,cod:2):2):2,(newt:3,toad:1):1):2);"
    for old, new in odd:
        text = text.replace(old, new)
    return text


def test_class_and_turnover_checks(trees, table, rows):
    t = trees(t=DATED)

    def report(*odd):
        return V.validate_class_tree(trees(t=classes(*odd)).withColumnRenamed("branch_length", "class"), t)

    assert report().count() == 0
    assert rows(report(("kite:1", "kite:1.25"), ("toad:1", "toad:2.5")), "code", "subject") == [
        ("non_integer_class", "kite"), ("non_integer_class", "toad")]
    assert rows(report(("eel", "gull")), "subject") == [("eel",), ("gull",)]
    cells = table([("f", s, "1") for s in DATED_LEAVES], "family_id string, species string, cell string")
    assert not V.has_errors(V.validate_turnover_inputs(cells, t))
    assert ("a", "not_ultrametric") in codes(V.validate_turnover_inputs(cells, trees(a=BIRDS)))


def test_star_tree_through_the_hot_path(trees, monkeypatch):
    monkeypatch.setattr(runtime, "HOT_ROWS", 4)
    monkeypatch.setattr(runtime, "HOT_SHARE", 20)
    star = "(" + ",".join(f"t{i}:{i + 1}" for i in range(60)) + "):2;"
    got = {r["label"]: r["depth"] for r in T.tip_depths(trees(s=star)).collect()}
    assert got == {f"t{i}": i + 3.0 for i in range(60)}


def test_cycle_is_an_error(spark):
    from cladeframe.runtime import DataError

    e = spark.createDataFrame([("t", 1, 2), ("t", 2, 1)], "tree_id string, node_id long, parent_id long")
    e = e.withColumn("branch_length", F.lit(0.0))
    T_rounds = T.MAX_ROUNDS
    T.MAX_ROUNDS = 4
    try:
        with pytest.raises(DataError, match="cycle"):
            T.lift(e)
    finally:
        T.MAX_ROUNDS = T_rounds


def test_small_and_large_trees_are_written_alike(spark, trees, rows, monkeypatch):
    """In one row, by joins, and mixed; a cycle is an error in all."""
    from cladeframe.runtime import DataError

    rng = random.Random(11)
    texts = {f"r{i}": random_tree(rng.randint(2, 20), rng, i % 2 == 0) for i in range(6)} | {"one": "x;"}
    edges = trees(**texts)
    twice = edges.unionByName(edges.where("node_id = 1 and tree_id = 'r1'"))
    lost = edges.where("node_id <> 2 or tree_id <> 'r2'")
    ring = spark.createDataFrame([("t", 1, 2, "a"), ("t", 2, 1, "b")], "tree_id string, node_id long, parent_id long, label string")
    ring = ring.selectExpr("*", "0.0D as branch_length", "0 as child_ord", "false as is_tip")
    with pytest.raises(DataError, match="cycle"):
        N.edges_to_newick(ring).collect()
    written = [rows(N.edges_to_newick(e)) for e in (twice, lost)]
    monkeypatch.setattr(N, "SMALL", 10)
    assert dict(rows(N.edges_to_newick(edges, internal_labels=True))) == texts
    monkeypatch.setattr(N, "SMALL", 0)
    assert [rows(N.edges_to_newick(e)) for e in (twice, lost)] == written


def test_texts_are_read_by_tasks_of_bounded_length(spark, rows, monkeypatch):
    monkeypatch.setattr(N, "TEXT_CHARS", 64)
    texts = spark.range(40).selectExpr("cast(id as string) as tree_id", "'(a:1,(b:2,c:3)d:4);' as newick")
    assert N._tokens(texts, "tree_id", "newick").rdd.getNumPartitions() == -(-40 * 19 // 64)
    assert N.newick_to_edges(texts).count() == 40 * 5


def test_small_trees_are_lifted_as_by_joins(spark, rows):
    made = [("t", 1, None, "r", None, False, 0), ("t", 2, 1, "a", 2.0, True, 0), ("t", 3, 1, "b", None, True, 1)]
    made += [("u", 1, None, "r", 0.5, True, 0)] + made[1:2] + [(None, 1, None, "r", 1.0, False, 0), (None, 2, 1, "a", 1.0, True, 0)]
    made += [("lost", 5, 4, "x", 1.0, True, 0)]
    made += [("deep", n, n - 1 or None, f"n{n}", 1.0, n == 90, 0) for n in range(1, 91)]
    e = spark.createDataFrame(made, "tree_id string, node_id bigint, parent_id bigint, label string, branch_length double, is_tip boolean, child_ord int")
    sums = {"n": F.lit(1).cast("bigint")}
    merges = {"low": (F.col("label"), "min"), "high": (F.col("branch_length"), "max"), "x": (F.xxhash64("label"), "bit_xor")}
    columns = ["tree_id", "node_id", "anc", "dist", "hops", "label", "n", "low", "high", "x"]
    for values in ({}, {"sums": sums, "merges": merges}):
        kept = columns if values else columns[:6]
        assert rows(T.lifted(e, carry=("label",), **values), *kept) == rows(T.lift(e, carry=("label",), **values).final, *kept)
    ring = spark.createDataFrame([("t", 1, 2, 1.0), ("t", 2, 1, 1.0)], "tree_id string, node_id bigint, parent_id bigint, branch_length double")
    with pytest.raises(runtime.DataError):
        T.lifted(ring)


def test_calibrations_are_parsed_once(spark):
    from cladeframe.functions.specs import parse_calibrations

    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(spec):
        seen.add(1)
        return spec

    e = spark.createDataFrame([("t", 1, None, "a", True)], "tree_id string, node_id bigint, parent_id bigint, label string, is_tip boolean")
    specs = spark.createDataFrame([("x:a,b:1",), ("y:a,c:old",)], "spec string").select(counted.asNondeterministic()("spec").alias("spec"))
    V.validate_calibrations(parse_calibrations(specs), e).collect()
    assert seen.value == 2


def test_tasks_hold_a_share_of_the_rows(spark):
    same = spark.range(400_000).select((F.col("id") % 1000).alias("key"), F.lit("much the same").alias("text"))
    dealt = runtime.by_rows(same, ["key"], 400_000, 20_000).groupBy("key").count()
    assert len(dealt.select(F.spark_partition_id()).distinct().collect()) == 20
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    runtime.materialize_even(dealt)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before


def test_parsed_arguments_have_no_negative_zero(spark):
    from types import SimpleNamespace

    from cladeframe.catalog.trees import parsed_specs

    orders = spark.createDataFrame([(3, 7, 60.0), (3, 7, 60.0), (9, 7, 60.0)], "o_orderkey bigint, o_custkey bigint, o_totalprice double")
    got = parsed_specs(SimpleNamespace(orders=orders)).select(F.col("age").cast("string"), "name").collect()
    assert set(map(tuple, got)) == {(None, None), ("0.0", "cal_3")} and len(got) == 2


def test_pairs_of_unknown_nodes_are_kept_and_not_looked_up(spark, rows, monkeypatch):
    e = spark.createDataFrame(
        [("t", 1, None, None, False, 0), ("t", 2, 1, 2.0, True, 0), ("t", 3, 1, 3.0, True, 1)],
        "tree_id string, node_id bigint, parent_id bigint, branch_length double, is_tip boolean, child_ord int",
    )
    made = [("t", 1, 2, 3), ("t", 2, None, 3), ("t", 3, 2, None), ("t", 4, 9, 2), (None, 5, None, None)]
    pairs = spark.createDataFrame(made, "tree_id string, pair_id bigint, u bigint, v bigint")
    asked, by_path = [], T._met_by_path
    monkeypatch.setattr(T, "_met_by_path", lambda edges, paths, p: asked.append(p.count()) or by_path(edges, paths, p))
    assert rows(T.mrca(e, pairs), "pair_id", "mrca", "age") == [(1, 1, 3.0), (2, None, None), (3, None, None), (4, None, None), (5, None, None)]
    assert asked == [2]
