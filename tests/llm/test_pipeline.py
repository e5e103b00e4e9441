"""Every stage of the corpus pipeline, and all of them, against brute force."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from awkward import SCHEMA, odd_rows, prose
from pyspark.sql import functions as F
from test_operators import brute_components, brute_hits, labelled, shingles, split

import corpus_pipeline
from cladeframe.llm import mixing, subword_quality
from cladeframe.llm.catalog import remainder

EXTRA = "size row uid key text_hash positions n_words score k h".split()
ITEMS = [(1, prose(1, 300)[40:400]), (2, "one, TWO!"), (None, "süß"), (3, None)]


@pytest.fixture()
def corpus(spark, tmp_path):
    """Good and bad documents, awkward ones, copies with and without ids, in a folder."""
    good = [(1000 + i, t, "en", f"s{i % 3}", q) for i, (_, t, _, _, q) in enumerate(labelled(160))]
    rows = [*odd_rows(), *good, good[0], (None, good[0][1], None, None, 1), (None, good[2][1] + " tail", "en", "s1", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    df.select("*", *[F.lit("x").alias(c) for c in EXTRA]).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(k, int(1000 <= k < 1080), 0) for k, *_ in good] + [(None, 1, 0), (5, None, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_stages(spark, corpus):
    given = spark.read.parquet(f"{corpus}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == [
        "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights", "token-ID output"]

    def run(name, docs, number):
        out = stages[name](spark, docs, corpus)
        path = f"{corpus}/stage{number}"
        out.write.parquet(path)
        return spark.read.parquet(path)

    good = run("quality classifier", given, 0)
    assert good.columns == given.columns
    labels = spark.read.parquet(f"{corpus}/labels.parquet")
    model = subword_quality.fit(given, labels, learn=remainder("doc_id", 4) != 2)
    scorer = subword_quality.Scorer(model)
    assert pairs(good) == sorted(((k, t) for k, t in pairs(given) if scorer.score([t])[0] >= 0.7), key=repr)
    ids = {k for k, _ in pairs(good)}
    assert len(ids & set(range(1000, 1080))) > 70 and not ids & set(range(1080, 1160))

    # from here on with all awkward rows, whatever the classifier thinks of them
    one = run("n-gram Jaccard join", given, 1)
    assert one.columns == given.columns
    kept, rows = pairs(one), pairs(given)
    by_group = Counter(g for _, _, g in brute_components_rows(rows))
    groups = {i: g for i, (_, _, g) in enumerate(brute_components_rows(rows))}
    empty = [r for r in rows if not split(r[1])]
    assert sorted([r for r in kept if not split(r[1])], key=repr) == sorted(empty, key=repr)
    left = [r for r in kept if split(r[1])]
    assert len(left) == len({g for i, g in groups.items() if split(rows[i][1])}) and not set(left) - set(rows)
    assert sum(by_group.values()) == len(rows)
    for group in {g for i, g in groups.items() if split(rows[i][1])}:
        members = [rows[i] for i, g in groups.items() if g == group]
        chosen = [r for r in left if r in members]
        assert len(chosen) == 1
        low = min((k for k, _ in members if k is not None), default=None)
        assert chosen[0][0] == low

    clean = run("benchmark decontamination", given, 2)
    assert clean.columns == given.columns
    bad = {(k, n) for k, n, h, _ in brute_hits(rows, ITEMS) if h and 20 * h >= n}
    import re

    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    n_words = lambda t: len(re.findall(word, (t or "").lower() if (t or "").isascii() else (t or "")))
    assert len(pairs(clean)) == len(rows) - sum(h > 0 and 20 * h >= n for _, n, h, _ in brute_hits(rows, ITEMS))
    assert bad and n_words("a b") == 2

    mixed = run("mixing sources to target weights", given, 3)
    assert mixed.columns == given.columns
    target = {r.source: (r.target, r.source_size) for r in mixing.plan(given).collect()}
    taken = Counter()
    for r in mixed.collect():
        taken[r.source] += len(split(r.text))
    largest = max(len(split(t)) for _, t in rows)
    assert all(abs(taken[s] - want) <= largest / 2 + 1e-6 for s, (want, _) in target.items())
    assert max(Counter(pairs(mixed)).values()) <= 2 * max(Counter(rows).values())

    tokens = stages["token-ID output"](spark, given, corpus).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in tokens), key=repr) == encoded(rows)
    at = 0
    for r in sorted(tokens, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens


def brute_components_rows(rows):
    """Component number of each row: rows with similar sets are linked."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    assert len(brute_components(rows)) == len(rows)
    return [(k, len(s), find(i)) for i, ((k, _), s) in enumerate(zip(rows, sets))]


def encoded(rows):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for k, t in rows:
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((k, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return sorted(out, key=repr)


def test_run_is_its_stages(spark, corpus):
    """``run`` gives the tokens of what the stages leave one after another."""
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, corpus).write.parquet(f"{corpus}/run{number}")
        docs = spark.read.parquet(f"{corpus}/run{number}")
    got = [(r.doc_id, r.n_tokens, r.ids_crc32) for r in corpus_pipeline.run(spark, corpus).collect()]
    assert sorted(got, key=repr) == encoded(pairs(docs)) and len(got) > 50


def test_stages_on_empty_tables(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, corpus).count() == 0
