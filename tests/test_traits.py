import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from cladeframe.functions import rates as X
from cladeframe.operators import ancestral as B
from cladeframe.operators import phenotype as H
from cladeframe.operators import summary as S
from cladeframe.operators.checks import has_errors
from cladeframe.plans.phenotypes import build_class_tree
from cladeframe.plans.results import summary_tables
from cladeframe.runtime import DataError

TREE = "(((a:1,b:2):1.5,c:3):0.5,(d:1,e:1):2);"
STATES = {"a": 1, "b": 2, "c": 3, "d": 3, "e": 1}


def brute_force(nodes, states, q):
    """Posterior per internal node and log-likelihood by summing over every
    assignment of internal states."""
    k = len(q)
    inner = [r["node_id"] for r in nodes if not r["is_tip"]]
    tips = {r["node_id"]: states[r["label"]] - 1 for r in nodes if r["is_tip"]}
    p = {r["node_id"]: X.expm_batch(q, np.array([r["branch_length"]]))[0]
         for r in nodes if r["parent_id"] is not None}
    total, post = 0.0, {n: np.zeros(k) for n in inner}
    for choice in itertools.product(range(k), repeat=len(inner)):
        s = {**tips, **dict(zip(inner, choice))}
        w = 1.0 / k
        for r in nodes:
            if r["parent_id"] is not None:
                w *= p[r["node_id"]][s[r["parent_id"]], s[r["node_id"]]]
        total += w
        for n in inner:
            post[n][s[n]] += w
    return {n: v / total for n, v in post.items()}, np.log(total)


def tip_states(e, spark, states):
    named = spark.createDataFrame(list(states.items()), "label string, state int")
    return e.where("is_tip").join(named, "label").select(
        F.lit("x").alias("trait_id"), "tree_id", "node_id", "state")


@pytest.mark.parametrize("model", ["ER", "ARD"])
def test_message_passing_against_enumeration(spark, trees, model):
    e = trees(t=TREE).cache()
    tips = tip_states(e, spark, STATES)
    if model == "ER":
        q = X.er_matrix(3, 0.1)
        rated, column = tips.withColumn("rate", F.lit(0.1)), "rate"
    else:
        q = X.rate_matrix(3, "ARD", [0.1, 0.2, 0.05, 0.3, 0.15, 0.07])
        rated, column = tips.withColumn("q", F.array(*[F.lit(float(x)) for x in q.ravel()])), "q"
    forward = B.forward_liks(e, rated, 3, ["trait_id"], column)
    posterior, log_likelihood = brute_force(e.collect(), STATES, q)
    assert B.log_likelihoods(forward).first()["log_likelihood"] == pytest.approx(log_likelihood, abs=1e-9)
    got = B.marginal_states(forward).collect()
    assert len(got) == len(posterior)
    for r in got:
        assert [r["l_1"], r["l_2"], r["l_3"]] == pytest.approx(list(posterior[r["node_id"]]), abs=1e-9)


def peeled(nodes, states, q):
    """Likelihoods, posteriors and log-likelihood of one problem by walking the tree."""
    k = len(q)
    children = {}
    for r in nodes:
        children.setdefault(r["parent_id"], []).append(r)
    p = {r["node_id"]: X.expm_batch(q, np.array([r["branch_length"] or 0.0]))[0] for r in nodes}
    lik, scale, order, stack = {}, {}, [], list(children[None])
    while stack:
        r = stack.pop()
        order.append(r)
        stack += children.get(r["node_id"], [])
    for r in reversed(order):
        n = r["node_id"]
        if r["is_tip"]:
            state = states.get(r["label"])
            lik[n], scale[n] = (np.ones(k) if state is None else np.eye(k)[state - 1]), 0.0
            continue
        own = np.ones(k)
        scale[n] = sum(scale[c["node_id"]] for c in children[n])
        for c in children[n]:
            own = own * (p[c["node_id"]] @ lik[c["node_id"]])
            scale[n] += np.log(own.sum())
            own = own / own.sum()
        lik[n] = own
    post = {}
    for r in order:
        n = r["node_id"]
        if r["parent_id"] is None:
            post[n] = lik[n] / lik[n].sum()
        elif not r["is_tip"]:
            step = p[n] * lik[n] / (p[n] @ lik[n])[:, None]
            post[n] = post[r["parent_id"]] @ step
    root = children[None][0]["node_id"]
    return post, scale[root] + np.log(lik[root].sum() / k)


def random_newick(n, rng, ladder=False, unary=False):
    parts = [f"t{i}:{rng.uniform(0.1, 3):.3f}" for i in range(n)]
    while len(parts) > 2:
        take = 1 if unary and rng.random() < 0.3 else rng.choice([2, 2, 3])
        took = [parts.pop(0 if ladder else rng.randrange(len(parts))) for _ in range(min(take, len(parts) - 1))]
        parts.insert(0 if ladder else rng.randrange(len(parts) + 1), f"({','.join(took)}):{rng.uniform(0.1, 3):.3f}")
    return f"({','.join(parts)});"


@pytest.mark.parametrize("model, shallow", [("ER", 0), ("SYM", 0), ("SYM", 64)])
def test_messages_against_walking(spark, trees, monkeypatch, model, shallow):
    """By contraction and by levels: bushy, ladder-shaped and chain trees, two traits, tips without a state."""
    monkeypatch.setattr(B, "SHALLOW", shallow)
    rng = random.Random(4)
    texts = {"bushy": random_newick(30, rng), "ladder": random_newick(25, rng, True), "chains": random_newick(18, rng, unary=True)}
    e = trees(**texts).drop("error").cache()
    nodes = e.collect()
    q = X.er_matrix(3, 0.2) if model == "ER" else X.rate_matrix(3, "SYM", [0.1, 0.4, 0.2])
    rows_, states = [], {}
    for trait in ("x", "y"):
        for r in nodes:
            if r["is_tip"] and rng.random() < 0.8:
                state = rng.randint(1, 3)
                rows_.append((trait, r["tree_id"], r["node_id"], state))
                states.setdefault((trait, r["tree_id"]), {})[r["label"]] = state
    tips = spark.createDataFrame(rows_, "trait_id string, tree_id string, node_id long, state int")
    rated = tips.withColumn("rate", F.lit(0.2)) if model == "ER" else tips.withColumn("q", F.array(*[F.lit(float(x)) for x in q.ravel()]))
    forward = B.forward_liks(e, rated, 3, ["trait_id"], "rate" if model == "ER" else "q")
    logs = {(r["trait_id"], r["tree_id"]): r["log_likelihood"] for r in B.log_likelihoods(forward).collect()}
    got = B.marginal_states(forward).collect()
    assert len(logs) == 6
    for (trait, tree), known in states.items():
        post, log_likelihood = peeled([r for r in nodes if r["tree_id"] == tree], known, q)
        assert logs[trait, tree] == pytest.approx(log_likelihood, abs=1e-9)
        mine = {r["node_id"]: [r["l_1"], r["l_2"], r["l_3"]] for r in got if (r["trait_id"], r["tree_id"]) == (trait, tree)}
        assert mine and set(mine) <= set(post)
        for n, x in mine.items():
            assert x == pytest.approx(list(post[n]), abs=1e-9)


def test_a_long_ladder_takes_few_rounds(spark, trees, monkeypatch):
    n, stored = 400, []
    text = "(" * n + "t0:1" + "".join(f",t{i}:1):1" for i in range(1, n + 1)) + ";"
    e = trees(t=text).drop("error").cache()
    states = {f"t{i}": 1 + (i // 7) % 2 for i in range(n + 1)}
    rated = tip_states(e, spark, states).withColumn("rate", F.lit(0.05))
    kept = B.materialize
    monkeypatch.setattr(B, "materialize", lambda df, **k: stored.append(1) or kept(df, **k))
    forward = B.forward_liks(e, rated, 2)
    post, log_likelihood = peeled(e.collect(), states, X.er_matrix(2, 0.05))
    assert B.log_likelihoods(forward).first()["log_likelihood"] == pytest.approx(log_likelihood, abs=1e-8)
    got = {r["node_id"]: [r["l_1"], r["l_2"]] for r in B.marginal_states(forward).collect()}
    assert set(got) == set(post)
    assert all(got[i] == pytest.approx(list(post[i]), abs=1e-9) for i in post)
    assert len(stored) <= 40  # 400 levels


def test_two_tips_and_many_traits(spark, trees, rows):
    e = trees(t="(a:1,b:1);", u="((a:1,b:1):1,c:1);").cache()
    tips = e.where("is_tip")
    first = tips.select(F.lit("p").alias("trait_id"), "tree_id", "node_id", F.lit(2).alias("state"))
    second = tips.select(F.lit("q").alias("trait_id"), "tree_id", "node_id",
                         F.when(F.col("label") == "a", 1).otherwise(2).alias("state"))
    both = first.unionByName(second).withColumn("rate", F.lit(0.1))
    states = B.node_states(B.marginal_states(B.forward_liks(e, both, 2)), 2)
    assert rows(states) == [("p", "t", 0, 2), ("p", "u", 0, 2), ("p", "u", 1, 2),
                            ("q", "t", 0, 1), ("q", "u", 0, 2), ("q", "u", 1, 2)]
    long = B.long_states(B.marginal_states(B.forward_liks(e, both, 2)), 2)
    assert long.groupBy("trait_id", "tree_id", "node_id").agg(F.sum("lik").alias("s")).where(
        "abs(s - 1) > 1e-12").count() == 0


def test_impossible_transitions_are_reported(spark, trees):
    e = trees(t="((a:1,b:1):1,c:1);").cache()
    tips = tip_states(e, spark, {"a": 1, "b": 2, "c": 1})
    rated = tips.withColumn("q", F.array(*[F.lit(0.0)] * 4))
    post = B.marginal_states(B.forward_liks(e, rated, 2, ["trait_id"], "q"))
    assert B.unresolved_states(post).count() >= 1
    assert None in {r["class"] for r in B.node_states(post, 2).collect()}


def test_exponential():
    q = X.rate_matrix(3, "SYM", [0.2, 0.5, 1.5])
    p = X.expm_batch(q, np.array([0.0, 0.3, 40.0]))
    assert np.allclose(p[0], np.eye(3)) and np.allclose(p.sum(axis=2), 1.0)
    w, v = np.linalg.eigh(q)
    assert np.allclose(p[1], v @ np.diag(np.exp(w * 0.3)) @ v.T)
    assert np.allclose(p[2], 1 / 3, atol=1e-6)


def test_rate_fit_finds_the_maximum(spark, trees):
    e = trees(t="(((a:1,b:1):1,c:2):1,((d:1,e:1):1,f:2):1);").cache()
    states = {"a": 1, "b": 1, "c": 1, "d": 2, "e": 2, "f": 1}
    got = B.fit_mk(e, tip_states(e, spark, states), 2, "ER", root_prior="flat", rounds=3).first()
    nodes = e.collect()
    grid = np.geomspace(0.005, 3, 300)
    best = max(brute_force(nodes, states, X.er_matrix(2, r))[1] for r in grid)
    assert got["log_likelihood"] == pytest.approx(best, abs=2e-3)
    other = B.fit_mk(e, tip_states(e, spark, states), 2, "ARD", root_prior="flat", rounds=1).first()
    assert other["log_likelihood"] >= got["log_likelihood"] - 1e-2
    assert len(other["rates"]) == 2
    with pytest.raises(ValueError):
        B.fit_mk(e, tip_states(e, spark, states), 2, "JC")


def top(likelihood, low, high):
    """Largest value of a function of one rate: thirds of the best cell of a fine grid."""
    grid = np.geomspace(low, high, 120)
    at = int(np.argmax([likelihood(r) for r in grid]))
    a, b = np.log(grid[max(at - 1, 0)]), np.log(grid[min(at + 1, 119)])
    for _ in range(40):
        third = (b - a) / 3
        a, b = (a + third, b) if likelihood(np.exp(a + third)) < likelihood(np.exp(b - third)) else (a, b - third)
    return np.exp((a + b) / 2), likelihood(np.exp((a + b) / 2))


def test_the_fit_query_goes_on_until_the_maximum(spark, tmp_path):
    """Segments that change along the tree of customers; before, two grids were scanned, the last
    in steps of 44 percent of the rate."""
    rng = random.Random(7)
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    own = {1: 0}
    for n in range(2, 64):
        own[n] = rng.randrange(5) if rng.random() < 0.12 else own[n // 2]
    customers = [(n - 1, f"c{n}", 1, 0.0, segments[own[n]]) for n in own]
    schema = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    spark.createDataFrame(customers, schema).write.parquet(f"{tmp_path}/customer.parquet")
    nodes = [{"node_id": n, "parent_id": n // 2 or None, "branch_length": ((n - 1) % 7 + 1) * 1.0 if n > 1 else None,
              "is_tip": n > 31, "label": f"c{n}"} for n in own]
    states = {f"c{n}": own[n] + 1 for n in own if n > 31}

    def likelihood(rate):
        post, flat = peeled(nodes, states, X.er_matrix(5, rate))
        return flat + np.log(5 * (post[1] ** 2).sum())  # the root's states by their likelihoods

    rate, best = top(likelihood, 1e-3, 1.0)
    got = queries()["fit_mk"](spark, str(tmp_path)).collect()
    assert len(got) == 1 and got[0]["log_likelihood"] == pytest.approx(best, abs=1e-8)
    assert got[0]["rates"] == pytest.approx([rate], rel=1e-4)
    assert got[0]["q"] == pytest.approx(list(X.er_matrix(5, got[0]["rates"][0]).ravel()))


def test_every_problem_is_fitted_to_its_own_end(spark, trees):
    """A trait with a maximum inside, a tip's that says nothing of the rate, and one that never changes."""
    rng = random.Random(11)
    e = trees(t=random_newick(12, rng), u="((a:1,b:2):1,c:0.5);").drop("error").cache()
    nodes = [r for r in e.collect() if r["tree_id"] == "t"]
    tips = [r for r in nodes if r["is_tip"]]
    inside = {r["label"]: 1 + (i % 4 == 0) for i, r in enumerate(sorted(tips, key=lambda r: r["node_id"]))}
    named = spark.createDataFrame([(x, t, label, s) for x, t, states in [
        ("inside", "t", inside), ("constant", "t", dict.fromkeys(inside, 2)), ("one", "u", {"a": 1}),
    ] for label, s in states.items()], "trait_id string, tree_id string, label string, state int")
    states = e.where("is_tip").join(named, ["tree_id", "label"]).select("trait_id", "tree_id", "node_id", "state")
    got = {r["trait_id"]: r for r in B.fit_mk(e, states, 2, root_prior="flat").collect()}
    rate, best = top(lambda r: peeled(nodes, inside, X.er_matrix(2, r))[1], 1e-4, 10.0)
    assert got["inside"]["log_likelihood"] == pytest.approx(best, abs=1e-8)
    assert got["inside"]["rates"][0] == pytest.approx(rate, rel=1e-3)
    assert got["constant"]["log_likelihood"] == pytest.approx(np.log(0.5), abs=1e-10)
    assert got["one"]["log_likelihood"] == pytest.approx(np.log(0.5), abs=1e-12)


@pytest.mark.parametrize("likelihood, rate, largest", [
    (lambda x: -((x - 1.234567) ** 2) - 900, np.exp(1.234567), -900),
    (lambda x: -np.cosh(3 * (x + 20)), np.exp(-20), -1),  # beyond the grid
    (lambda x: -np.exp(x), None, 0),  # the smaller, the better
    (lambda x: -5 - np.exp(-np.exp(x)), None, -5),  # the larger, the better
    (lambda x: max(-100 - (x + 2) ** 2, -99.5 - 4 * (x - 0.6) ** 2), np.exp(0.6), -99.5),  # the higher one of two, lower on the grid
    (lambda x: -3.0, 1, -3),  # no rate is better than others
    (lambda x: float("nan") if x > 2 else -((x - 1) ** 2) - 1, np.exp(1), -1),
    (lambda x: float("nan"), 1, None),
])
def test_rates_are_looked_at_until_the_maximum(likelihood, rate, largest):
    rates, rounds = np.array([3.0**i for i in range(-6, 7)]), 1
    while True:
        found = [likelihood(x) for x in np.log(rates)]
        at, more = X.next_rates(rates, found)
        if not len(more):
            break
        rates, rounds = np.sort(np.concatenate([rates, more])), rounds + 1
        assert rounds <= 12
    if rate is not None:
        assert rates[at] == pytest.approx(rate, rel=1e-4)
    if largest is not None:
        assert found[at] == pytest.approx(largest, rel=1e-10, abs=1e-10)


PHENOTYPES = [("human", "Omnivore"), ("cat", "Carnivore"), ("dog", "Carnivore/Piscivore"),
              ("dog", "Carnivore/Piscivore"), ("seal", "Piscivore"), ("frog", None)]
SPECIES = "(((human:1,cat:1):1,dog:2):1,(seal:1,newt:1):2);"


def test_duplicates_and_conflicts(table, rows):
    p = table(PHENOTYPES + [("frog", "Insectivore")], "species string, phenotype string")
    assert dict(rows(H.resolve_phenotypes(p)))["frog"] == "Insectivore"
    bad = p.union(table([("dog", "Herbivore")], "species string, phenotype string"))
    with pytest.raises(DataError, match="dog"):
        H.resolve_phenotypes(bad)
    s = table([("human",), ("cat",), ("newt",)], "species string")
    assert tuple(H.phenotype_coverage(s, p).first()) == (2, 1, 3)


def test_class_tree_chain(trees, table, rows):
    e = trees(t=SPECIES).drop("error").cache()
    p = table(PHENOTYPES, "species string, phenotype string")
    merges = dict(merge_only=[("Carnivore", "Piscivore")], substitutions=[("Piscivore", "Carnivore")])
    built = build_class_tree(e, p, rate=0.05, **merges)
    assert rows(built.legend) == [(1, "Carnivore", 3), (2, "Omnivore", 1), (3, "background", 1)]
    assert not has_errors(built.report)
    assert dict(rows(built.edges.where("is_tip"), "label", "class")) == {
        "human": 2, "cat": 1, "dog": 1, "seal": 1, "newt": 3}
    assert built.newick.first()["newick"].startswith("(((human:2,cat:1):")
    forced = build_class_tree(e, p, anc_category="Omnivore", **merges)
    assert {r["class"] for r in forced.edges.where("not is_tip").collect()} == {2}
    with pytest.raises(DataError):
        build_class_tree(e, p, anc_category="Nothing", **merges)
    matrix = table([("f", 1, 2, 3, 4, 5)], "family_id string, human int, cat int, dog int, seal int, newt int")
    dropped = build_class_tree(e, p, unclassified="drop", rate=0.05, matrix=matrix, **merges)
    assert dropped.matrix.columns == ["family_id", "human", "cat", "dog", "seal"]
    assert {r["label"] for r in dropped.edges.where("is_tip").collect()} == {"human", "cat", "dog", "seal"}
    one = table([(s, "same") for s in ("human", "cat", "dog", "seal", "newt")], "species string, phenotype string")
    with pytest.raises(DataError, match="at least 2"):
        build_class_tree(e, one, rate=0.05)
    with pytest.raises(DataError, match="polytomy|not_rooted"):
        build_class_tree(trees(t="(a:1,b:1,c:1);").drop("error"), p)


def test_summaries(table, rows):
    counts = table([("f", "a", 1), ("f", "b", 3), ("f", "c", 5), ("g", "a", 2), ("g", "b", 2), ("g", "c", 2)],
                   "family_id string, species string, copies long")
    changes = table([("f", "x", 2), ("f", "y", -1), ("g", "x", -3)], "family_id string, branch string, change long")
    labels = table([("a", "p"), ("b", "q"), ("c", "q")], "species string, phenotype string")
    pv = table([("f", 0.01), ("g", 0.5)], "family_id string, pvalue double")
    assert rows(S.turnover_by_branch(changes)) == [("x", 1, 1, 2, 3), ("y", 0, 1, 0, 1)]
    out = summary_tables(counts, pv, labels, changes)
    assert rows(out["gene_family_summary"]) == [("f", 1, 5, 3.0, 2, 1, 0.01), ("g", 2, 2, 2.0, 0, 3, 0.5)]
    assert rows(out["significant_families"], "family_id", "phenotype", "mean_copies") == [("f", "p", 1.0), ("f", "q", 4.0)]
    assert rows(out["turnover_by_phenotype"], "phenotype", "total_copies") == [("p", 1), ("q", 8)]
    got = {(r["family_id"], r["phenotype"]): r for r in S.associate(S.add_phenotype(counts, labels)).collect()}
    assert got["f", "q"]["mean_difference"] == 3.0
    assert got["f", "q"]["correlation"] == pytest.approx(np.corrcoef([1, 3, 5], [0, 1, 1])[0, 1])
    assert got["g", "p"]["correlation"] is None
    bins = dict(rows(S.size_histogram(counts, 0, 9, 3)))
    assert bins == {3: 1, 4: 1}
    assert rows(S.phenotype_quantiles(S.add_phenotype(counts, labels))) == [("p", 1.0, 1.25, 1.5, 1.75, 2.0), ("q", 2.0, 2.0, 2.5, 3.5, 5.0)]
