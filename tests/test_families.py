import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cladeframe import runtime
from cladeframe.operators import families as E
from cladeframe.operators import turnover as G
from cladeframe.plans.families import infer_families


def components(links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in list(parent)}


@pytest.mark.parametrize("links", [
    [(i, i + 1) for i in range(40)],
    [(0, i) for i in range(1, 200)] + [(500, i) for i in range(501, 520)],
    [(5, 5), (7, 6), (6, 7)],
    [(random.Random(i).randrange(300), random.Random(i + 999).randrange(300)) for i in range(220)],
])
@pytest.mark.parametrize("hot_rows", [None, 3])
def test_connected_components(spark, links, hot_rows, monkeypatch):
    if hot_rows:
        monkeypatch.setattr(runtime, "HOT_ROWS", hot_rows)
        monkeypatch.setattr(runtime, "HOT_SHARE", 20)
    got = E.connected_components(spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == components(links)


def test_tokens(spark):
    df = spark.createDataFrame([("MKTLLL",), ("MK",)], "s string")
    assert [r[0] for r in df.select(E.kmers(F.col("s"), 5)).collect()] == [["MKTLL", "KTLLL"], ["MK"]]
    text = spark.createDataFrame([(" a  b\nc d e f ",), ("a b",)], "s string")
    assert [r[0] for r in text.select(E.word_shingles(F.col("s"), 5)).collect()] == [
        ["a b c d e", "b c d e f"], ["a b"]]
    import hashlib

    value = spark.createDataFrame([("abc",)], "s string").select(E.token_hash(F.col("s"))).first()[0]
    assert value == int(hashlib.md5(b"abc").hexdigest()[:15], 16)


def protein(rng, n=120):
    return "".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(n))


def mutate(rng, s, n):
    s = list(s)
    for i in rng.sample(range(len(s)), n):
        s[i] = rng.choice("ACDEFGHIKLMNPQRSTVWY")
    return "".join(s)


def test_families_of_related_proteins(spark):
    rng = random.Random(3)
    data, truth = [], {}
    for family in range(6):
        ancestor = protein(rng)
        for sp in range(4):
            truth[len(data)] = family
            data.append((len(data), f"sp{sp}", 120, mutate(rng, ancestor, 3)))
    data.append((len(data), "sp0", 120, protein(rng)))
    seqs = spark.createDataFrame(data, "seq_id long, species string, length int, sequence string")
    got = infer_families(seqs, k=5)
    members = {r["seq_id"]: r["family_id"] for r in got.members.collect()}
    groups = defaultdict(set)
    for s, f in members.items():
        groups[f].add(truth.get(s))
    assert all(len(g) == 1 for g in groups.values())
    sizes = Counter(members.values())
    assert sizes["OG0000000"] == 4 and len(sizes) == 7
    assert got.counts.agg(F.sum("copies")).first()[0] == 25


@pytest.mark.parametrize("hot_rows", [None, 5])
def test_copies_are_one_in_the_search(spark, hot_rows, monkeypatch):
    """Half of all sequences are copies: hits stay linear, families whole."""
    if hot_rows:
        monkeypatch.setattr(runtime, "HOT_ROWS", hot_rows)
    rng = random.Random(4)
    same = protein(rng)
    data = [(i, f"sp{i % 3}", 120, same) for i in range(60)] + [
        (100 + i, f"sp{i % 3}", 120, protein(rng)) for i in range(60)]
    seqs = spark.createDataFrame(data, "seq_id long, species string, length int, sequence string")
    sk = E.sketch(seqs, E.kmers(F.col("sequence"), 5)).cache()
    hits = E.kmer_hits(sk).cache()
    assert sorted((h["query"], h["target"]) for h in hits.collect()) == [
        (0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1)]
    found = E.families(E.family_links(hits, sk), seqs.select("seq_id"))
    sizes = sorted(r["count"] for r in found.groupBy("family_id").count().collect())
    assert sizes == [1] * 60 + [60]


def grams(s):
    return {s[i:i + 5] for i in range(len(s) - 4)}


@pytest.mark.parametrize("block", [E.BLOCK, 2])
def test_hits_against_all_pairs(spark, block):
    """No hit is lost, however small the blocks; nearly all similar pairs are hits."""
    rng = random.Random(9)
    data = []
    for _ in range(4):
        ancestor = protein(rng)
        data += [(len(data) + i, f"sp{i % 3}", mutate(rng, ancestor, i % 9)) for i in range(14)]
    data += [(len(data), None, data[0][2]), (len(data) + 1, None, data[0][2])]
    seqs = spark.createDataFrame(data, "seq_id long, species string, sequence string")
    sk = E.sketch(seqs, E.kmers(F.col("sequence"), 5)).cache()
    first = {}
    for r in sorted(sk.collect()):
        first.setdefault((r["species"], r[2:]), r["seq_id"])
    reps = {i: (species, values) for (species, values), i in first.items()}
    expected = set()
    for a, (sa, x) in reps.items():
        for b, (sb, y) in reps.items():
            same = [u == v for u, v in zip(x, y)]
            if a != b and sum(same) >= 8 and any(same[i] and same[i + 1] for i in range(0, 32, 2)):
                expected.add((a, sa, b, sb, sum(same)))
    got = [tuple(r) for r in E.kmer_hits(sk, block=block).collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    near = {
        (a, b) for a in reps for b in reps if a != b
        and 5 * len(grams(data[a][2]) & grams(data[b][2])) >= 2 * len(grams(data[a][2]) | grams(data[b][2]))
    }
    found = near & {(g[0], g[2]) for g in got}
    assert len(near) > 100 and len(found) >= 0.9 * len(near)


def test_a_chance_band_does_not_merge(spark):
    names = ", ".join(f"h_{i} long" for i in range(32))
    data = [(1, "x", *range(32)), (2, "y", 0, 1, *range(102, 132)), (3, "y", *range(8), *range(208, 232))]
    sk = spark.createDataFrame(data, f"seq_id long, species string, {names}").cache()
    hits = E.kmer_hits(sk).cache()
    assert {(h["query"], h["target"], h["score"]) for h in hits.collect()} == {(1, 3, 8), (3, 1, 8)}
    links = E.family_links(hits, sk)
    assert [tuple(r) for r in links.collect()] == [(1, 3)]
    with pytest.raises(ValueError, match="min_score"):
        E.kmer_hits(sk, min_score=2)


def test_near_copies_are_not_met_at_every_position(spark):
    """A large bucket is split only where that leaves fewer pairs."""
    names = ", ".join(f"h_{i} long" for i in range(32))
    near = [(n, "x", *[1000 * n + i if i == n % 32 else i for i in range(32)]) for n in range(1, 65)]
    chance = [(n, "y", 7, 8, *[1000 * n + i for i in range(2, 32)]) for n in range(101, 165)]
    sk = spark.createDataFrame(near + chance, f"seq_id long, species string, {names}").cache()
    with runtime.stored_tables() as made:
        hits = [tuple(r) for r in E.kmer_hits(sk, block=8).collect()]
        stored = [spark.read.parquet(path).count() for path in made]
    assert len(hits) == len(set(hits)) == 64 * 63
    assert {h[4] for h in hits} == {30, 31}
    assert max(stored) < 64 * 16 * 4  # every position of all near copies: 64 * 16 * 30


def test_shingles_of_odd_texts(spark):
    texts = ["", " ", "a", "a b c d e", " a\tb\n c  d e f ", "é ü 𝄞 ñ ß\u00a0x y", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(E.word_shingles(F.col("t"), 5)).collect()]
    assert got == [[""], [""], ["a"], ["a b c d e"], ["a b c d e", "b c d e f"],
                   ["é ü 𝄞 ñ ß\u00a0x", "ü 𝄞 ñ ß\u00a0x y"], [None]]


def test_reciprocal_best(spark, rows):
    hits = spark.createDataFrame(
        [(1, "x", 10, "y", 5), (1, "x", 11, "y", 7), (11, "y", 1, "x", 7), (10, "y", 1, "x", 5),
         (2, "x", 12, "y", 3), (12, "y", 1, "x", 4), (12, "y", 2, "x", 4), (1, "x", 2, "x", 9)],
        "query long, query_species string, target long, target_species string, score int")
    assert rows(E.reciprocal_best(hits)) == [(1, 11, 7)]


# -- turnover ------------------------------------------------------------------------

TREE = "((a:10,b:10):5,c:15);"


def direct(p, counts, largest):
    """Likelihoods of all (root, inner) sizes for the three-tip tree."""
    a, b, c = counts
    return {
        (r, i): p["i"][r, i] * p["a"][i, a] * p["b"][i, b] * p["c"][r, c]
        for r in range(1, largest + 1) for i in range(largest + 1)
    }


def matrices(rate, largest):
    t = {"a": 10, "b": 10, "i": 5, "c": 15}
    return {n: G.size_transitions(rate, x, largest) for n, x in t.items()}


def test_likelihood_and_reconstruction_against_enumeration(trees):
    tree = G.species_tree(trees(t=TREE))
    counts = np.array([[1, 2, 1], [0, 0, 3], [4, 5, 2], [0, 0, 0]])
    largest, rate = 12, 0.03
    p = matrices(rate, largest)
    got = G.profile_log_likelihoods(tree, [rate], counts, largest)
    sizes = G.reconstruct_sizes(tree, [rate], counts, largest)
    root, inner = tree.node_ids.index(0), tree.node_ids.index(1)
    for row, ll, size in zip(counts, got, sizes):
        every = direct(p, row, largest)
        assert ll == pytest.approx(np.log(sum(every.values()) / largest))
        best = max(every.values())
        assert every[size[root], size[inner]] == pytest.approx(best)


def test_transitions():
    p = G.size_transitions(0.02, 10, 60)
    assert np.allclose(p[:10].sum(axis=1), 1.0, atol=1e-6)
    sizes = np.arange(61)
    assert p[5] @ sizes == pytest.approx(5.0, abs=1e-4)
    assert np.allclose(G.size_transitions(0.02, 0.0, 5), np.eye(6))


def test_fit_and_changes(spark, trees, table, rows):
    rng = np.random.default_rng(1)
    edges = trees(t=TREE).cache()
    data, true = [], 0.02
    p = {n: G.size_transitions(true, x, 40) for n, x in {"a": 10, "b": 10, "i": 5, "c": 15}.items()}
    for f in range(600):
        def step(m, s):
            return int(rng.choice(41, p=m[s] / m[s].sum()))
        root = int(rng.integers(1, 6))
        inner = step(p["i"], root)
        for sp, s in (("a", step(p["a"], inner)), ("b", step(p["b"], inner)), ("c", step(p["c"], root))):
            if s:
                data.append((f"f{f}", sp, s))
    counts = table(data, "family_id string, species string, copies long").cache()
    fit = G.fit_turnover(counts, edges, rounds=3).first()
    assert fit["rate"] == pytest.approx(true, rel=0.25)
    classes = edges.withColumn("class", F.when(F.col("label") == "c", 2).otherwise(1))
    both = {r["class"]: r["rate"] for r in G.fit_turnover(counts, classes, "class", rounds=2).collect()}
    assert set(both) == {1, 2} and both[1] == pytest.approx(true, rel=0.5)
    changes = G.branch_changes(counts, edges, [true])
    assert changes.where("node_id = 0 and change is not null").count() == 0
    tips = edges.where("is_tip").select("node_id", F.col("label").alias("species"))
    seen = changes.join(tips, "node_id").where("copies > 0").select("family_id", "species", "copies")
    assert rows(seen) == rows(counts)


def test_too_large_families_are_refused(spark, trees, table):
    from cladeframe.runtime import DataError

    counts = table([("f", "a", 5000)], "family_id string, species string, copies long")
    with pytest.raises(DataError, match="split large families"):
        G.branch_changes(counts, trees(t=TREE), [0.01])
