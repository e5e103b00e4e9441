"""Every operator against brute force in plain Python, on rows chosen to be awkward."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from awkward import SCHEMA, odd_rows, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cladeframe.llm import (
    cross_parsing, decontaminate, jaccard_join, mixing, quality_rules, repeats, sharding, subword_quality, token_files,
    url_filter,
)

WORD = r"[^\x20\x09-\x0D]+"


def split(text):
    return re.findall(WORD, text or "")


def key(row):
    return repr(row)


# sharding


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_shards_hold_equal_bytes(spark, shards):
    rows = [(i, 1000 if i % 3 == 0 else i % 50, i // 2) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, size long, h long").repartition(5)
    got = sharding.histogram_shards(df, ["h", "doc_id"], "size", shards, probes=64).collect()
    assert sorted((r.doc_id, r.size) for r in got) == sorted((i, s) for i, s, _ in rows)
    held, slots = Counter(), defaultdict(list)
    for r in got:
        held[r.shard] += r.size
        slots[r.shard].append((r.slot, r.h))
    mean = sum(held.values()) / shards
    assert max(abs(held[s] - mean) for s in range(shards)) <= max(0.02 * mean, 2000)
    for s, places in slots.items():
        assert [p for p, _ in sorted(places)] == list(range(len(places)))
    order = [h for s in sorted(slots) for _, h in sorted(slots[s])]
    assert order == sorted(order)


def test_one_key_is_cut(spark):
    df = spark.createDataFrame([(7, 10)] * 400 + [(i, 10) for i in range(100)], "k long, size long")
    got = sharding.histogram_shards(df, ["k"], "size", 10, probes=32).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    assert {r.shard: r.b for r in got} == {s: 500 for s in range(10)}


def test_equal_texts_stay_together(spark):
    df = spark.createDataFrame([(i // 4, 10) for i in range(40_000)], "k long, size long")
    got = sharding.histogram_shards(df, ["k"], "size", 8)
    assert got.select("k", "shard").distinct().count() == 10_000


def test_shards_of_odd_rows(clashing, empty):
    df = clashing.withColumn("bytes", F.length("text"))
    got = sharding.histogram_shards(df, ["doc_id"], "bytes", 4)
    assert got.count() == len(odd_rows()) and set(got.columns) == set(df.columns)
    assert sharding.histogram_shards(empty, ["doc_id"], "n_chars", 4).count() == 0


# mixing


def test_mix(clashing, empty):
    got = mixing.plan(clashing).collect()
    assert len(got) == len(odd_rows())
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken in (0, r.size, 2 * r.size) and r.taken == r.size * len(r.positions)
        assert list(r.positions) == sorted(r.positions)
    weights = dict(zip(sorted(x for x in sizes if x) + [None], (5, 2, 1, 5, 2, 1)))
    want, capped = {}, set()
    while True:
        free = 1.5 * sum(sizes.values()) - sum(2 * sizes[x] for x in capped)
        left = sum(weights[x] for x in sizes if x not in capped)
        want = {x: 2.0 * sizes[x] if x in capped else free * weights[x] / left for x in sizes}
        above = {x for x in sizes if x not in capped and want[x] > 2 * sizes[x]}
        if not above:
            break
        capped |= above
    for x in sizes:
        assert target[x] == pytest.approx(want[x])
        assert abs(taken[x] - target[x]) <= max([r.size for r in got if r.source == x]) / 2 + 1e-6
    assert [tuple(r) for r in mixing.plan(clashing).orderBy("size", "doc_id", "source").collect()] == sorted(
        map(tuple, got), key=lambda r: (r[2], r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert mixing.plan(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_curriculum_moves_shares(spark):
    rows = [(i, "w " * 20, "en", f"s{i % 2}", 40) for i in range(4000)]
    order = mixing.training_order(mixing.plan(spark.createDataFrame(rows, SCHEMA), weights=(1.0, 1.0), tilt=0.5)).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    early = sum(r.doc_id % 2 == 0 for r in order[: len(order) // 10]) / (len(order) // 10)
    late = sum(r.doc_id % 2 == 0 for r in order[-len(order) // 10 :]) / (len(order) // 10)
    assert 0.68 < early < 0.78 and 0.22 < late < 0.32


def test_mixed_repeats_rows(odd):
    want = {r.doc_id: len(r.positions) for r in mixing.plan(odd).collect() if r.doc_id not in (9, None)}
    got = Counter(r.doc_id for r in mixing.mixed(odd).collect())
    assert mixing.mixed(odd).columns == odd.columns
    assert all(got[k] == n for k, n in want.items())


def repeated_ids():
    """Repeated and missing ids in several sources; every text is of one row only."""
    rows = [(5 if i % 3 else None, f"t{i} " + "w " * (i % 7), "en", f"s{i % 3}") for i in range(90)]
    rows += [(100 + i, f"u{i} w w", "en", f"s{i % 3}") for i in range(30)]
    return [(*r, len(r[1])) for r in rows]


def test_mixed_takes_rows_one_by_one(spark):
    rows = repeated_ids()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    target = {r.source: r.target for r in mixing.plan(df).collect()}
    taken, copies = Counter(), Counter()
    for r in mixing.mixed(df).collect():
        taken[r.source] += len(split(r.text))
        copies[r.text] += 1
    largest = max(len(split(r[1])) for r in rows)
    assert all(abs(taken[x] - target[x]) <= largest / 2 + 1e-6 for x in target)
    for x in target:
        n = [copies[r[1]] for r in rows if r[3] == x]
        assert max(n) - min(n) <= 1
    assert {r[0] for r in rows if copies[r[1]] > 0} >= {5, None}


# quality classifier and language


def labelled(n):
    good = [(i, prose(i, 60), "en", "a", 1) for i in range(0, n, 2)]
    bad = [(i, "$$$ | ".join(prose(i, 60).upper().split()), "en", "a", 1) for i in range(1, n, 2)]
    return good + bad


def test_quality(spark, clashing, empty):
    docs = spark.createDataFrame(labelled(400), SCHEMA)
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(400)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    model = subword_quality.fit(docs, labels, learn=F.col("doc_id") < 300, sample=200)
    got = docs.select("doc_id", subword_quality.score(F.col("text"), model).alias("s")).where("doc_id >= 300").collect()
    assert all((r.s > 0.7) == (r.doc_id % 2 == 0) for r in got)
    again = subword_quality.fit(docs, labels, learn=F.col("doc_id") < 300, sample=200)
    assert np.array_equal(model.odds, again.odds)
    odd = clashing.select(subword_quality.score(F.col("text"), model).alias("s")).collect()
    assert len(odd) == len(odd_rows()) and all(0 <= r.s <= 1 for r in odd)
    nothing = subword_quality.fit(empty, labels)
    assert {r.s for r in clashing.select(subword_quality.score(F.col("text"), nothing).alias("s")).collect()} == {0.5}


def test_learned_texts_are_packed(spark, monkeypatch):
    """The driver holds them one after another, not as thousands of small parts."""
    docs = spark.createDataFrame(labelled(100), SCHEMA)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(100)], "doc_id long, quality int")
    given = []
    monkeypatch.setattr(subword_quality, "train", given.extend)
    subword_quality.fit(docs, labels)
    assert len(given) == 100 and sum(y for _, _, y in given) == 50
    for parts in ([t[0] for t in given], [t[1] for t in given]):
        starts = sorted((p.__array_interface__["data"][0], p.nbytes) for p in parts)
        assert all(low + n == high for (low, n), (high, _) in zip(starts, starts[1:]))
    texts = {str(i): t for i, t, *_ in labelled(100)}
    for (buckets, weights, y), key in zip(given, sorted(texts)):
        want = subword_quality.document(texts[key])
        assert np.array_equal(buckets, want[0]) and np.array_equal(weights, want[1]) and y == 1 - int(key) % 2


def test_word_features_are_plain_hashes():
    words = ["a", "stone", "süß", "日本語日本語", "a" * 300]
    together, sizes = subword_quality.word_features(words)
    apart = [subword_quality.word_features([w]) for w in words]
    assert np.array_equal(together, np.concatenate([b for b, _ in apart]))
    assert sizes.tolist() == [n.item() for _, n in apart]
    assert sizes[1] == 1 + sum(max(0, 7 - n + 1) for n in subword_quality.GRAMS)


def test_score_is_softmax_of_the_average(spark):
    """The score of a text from its own average of word vectors, taken word by word."""
    docs = spark.createDataFrame(labelled(200), SCHEMA)
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    model = subword_quality.fit(docs, labels)
    texts = [r[1] for r in odd_rows()] + ["again again more", "one line\none line\nother", "x"]
    scored = subword_quality.Scorer(model).score(texts)
    for text, got in zip(texts, scored):
        words = (text or "").split()
        lines, seen, marks = [x for x in (text or "").split("\n") if x.strip()], set(), []
        for x in lines:
            marks += [subword_quality.LINE_AGAIN] * (len(x.split()) if x in seen else 0)
            seen.add(x)
        marks += [subword_quality.AGAIN for a, b in zip(words, words[1:]) if a == b] + [subword_quality.END]
        vectors = []
        for w in [*words, *marks]:
            buckets, _ = subword_quality.word_features([w])
            vectors.append(np.mean([model.odds[b] for b in buckets.tolist()], dtype=np.float64))
        z = float(np.mean(vectors))
        assert got == pytest.approx(np.exp(z) / (1 + np.exp(z)), abs=1e-6)


def test_large_alphabets_take_little_memory():
    """A script of thousands of characters beside one of ten letters."""
    many = "".join(chr(0x4E00 + (i * i * 7 + i) % 6000) + (" " if i % 5 == 0 else "") for i in range(24_000))
    model = cross_parsing.build({"han": [many], "few": ["abcdefghij " * 1000]})
    held = [a.keys.nbytes + a.to.nbytes + (a.table.nbytes if a.table is not None else 0) for a in model.automata]
    assert max(held) < 32 << 20 and model.automata[0].width != model.automata[1].width
    words = many.split()[40:60]
    counts = model.phrases([*words, "abcdefghij"])
    assert counts[:20, 1].tolist() == [1] * 20 and (counts[:20, 0] > 1).all() and counts[20, 0] == 1


def test_every_drawn_text_is_learned(spark):
    """One very long text is no language's whole model."""
    rows = [(i, f"word{'abcdefghij'[i % 10]} " * 30, "en", "s", 1) for i in range(60)] + [(99, "long " * 100_000, "en", "s", 1)]
    model = cross_parsing.fit(spark.createDataFrame(rows, SCHEMA))
    tails = {c for c in "abcdefghij" if model.phrases([f"word{c}"])[0, 0] == 1}
    assert len(tails) == 10


@pytest.mark.parametrize("dense", [1 << 22, 0])
@settings(max_examples=40, deadline=None)
@given(body=st.text("abc", max_size=30), words=st.lists(st.text("abcd", max_size=12), max_size=6))
def test_phrases_are_greedy_longest_matches(dense, body, words):
    kept = cross_parsing.DENSE
    cross_parsing.DENSE = dense
    try:
        model = cross_parsing.build({"x": [body], "y": ["b a c"]})
    finally:
        cross_parsing.DENSE = kept
    text = "".join(" " + w for w in body.split())

    def count(word):
        rest, n = " " + word, 0
        while rest and word:
            m = max((i for i in range(len(rest) + 1) if rest[:i] in text), default=0)
            rest, n = rest[max(1, m) :], n + 1
        return n

    if words:
        assert model.phrases(words)[:, 0].tolist() == [count(w) for w in words]


def test_languages(spark, clashing, empty):
    texts = {"en": "the river under the green stone walks again over north", "de": "der fluss unter dem grünen stein läuft wieder über norden"}
    rows = [(i, " ".join(texts[x].split()[i % 5 : i % 5 + 5]), x, "s", 1) for i in range(40) for x in texts]
    model = cross_parsing.fit(spark.createDataFrame(rows, SCHEMA), learn=F.col("doc_id") < 30)
    held = spark.createDataFrame(rows, SCHEMA).where("doc_id >= 30").select("lang", cross_parsing.identify(F.col("text"), model).alias("f"))
    assert all(r.lang == r.f.lang_pred and 0 < r.f.score <= 1 for r in held.collect())
    got = clashing.select("text", cross_parsing.identify(F.col("text"), model).alias("f")).collect()
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.f.lang_pred != "und") == letters and 0 <= r.f.score <= 1
    none = cross_parsing.fit(empty)
    assert {r.f.lang_pred for r in clashing.select(cross_parsing.identify(F.col("text"), none).alias("f")).collect()} == {"und"}


# similar documents


def shingles(text):
    words = split((text or "").translate({i: i + 32 for i in range(65, 91)}))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (k, _) in enumerate(rows):
        groups[find(i)].append(k)
    low = {g: min([k for k in ks if k is not None], default=None) for g, ks in groups.items()}
    return sorted(((k, len(sets[i]), low[find(i)]) for i, (k, _) in enumerate(rows)), key=key)


def near_copies():
    base = prose(11, 200).split()
    rows = []
    for i in range(120):
        words = list(base)
        for j in range(i % 9):
            words[(17 * i + 31 * j) % len(words)] = f"new{i}x{j}"
        rows.append((i, " ".join(words)))
    line = prose(12, 40)
    rows += [(200 + i, prose(100 + i, 60) + " " + line) for i in range(40)]
    return rows


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=60), min_size=2, max_size=6))
def test_union_maps_bound_the_overlap(sets):
    own, *group = [np.sort(np.array(list(s), np.uint64)) for s in sets]
    union = jaccard_join.joined_maps([jaccard_join.bit_map(g) for g in group])
    common = len(np.intersect1d(own, np.concatenate(group)))
    assert common <= jaccard_join.most_in_union(len(own), jaccard_join.bit_map(own), union) <= len(own)
    # an element that is in the union costs nothing
    whole_map = jaccard_join.joined_maps([union, jaccard_join.bit_map(own)])
    assert jaccard_join.most_in_union(len(own), jaccard_join.bit_map(own), whole_map) == len(own)


def test_words_that_cancel_out_are_told_apart(spark):
    """Words of two letters by the parity of ones in the place and its complement, of which
    polynomial hashes modulo a power of two are equal."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    rows = [(1, one), (2, other), (3, one + " and more words here"), (4, other + " and more words here")]
    got = jaccard_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.doc_id, r.component_id) for r in got.collect()} == {(i, i) for i in range(1, 5)}


def test_components(spark, clashing, empty):
    for df, rows in (
        (spark.createDataFrame(near_copies(), "doc_id long, text string"), near_copies()),
        (clashing, [r[:2] for r in odd_rows()]),
    ):
        got = jaccard_join.similar_documents(df).select("doc_id", "n_shingles", "component_id").collect()
        assert sorted(map(tuple, got), key=key) == brute_components(rows)
    assert jaccard_join.similar_documents(empty).count() == 0


def test_keep_one(clashing):
    got = jaccard_join.keep_one(clashing)
    assert got.columns == clashing.columns
    ids = Counter(r.doc_id for r in got.collect())
    assert ids[0] == 1 and not ids[1] and ids[3] == ids[4] == ids[5] == 1 and ids[8] == 1 and not ids[9]


def test_keep_one_row_of_each_component(spark):
    x, y, z = prose(21, 120), prose(22, 120), prose(23, 120)
    near = lambda t, i: t + f" more{i}"
    rows = [(None, x), (None, near(x, 1)), (None, near(x, 2)), (3, x), (5, near(x, 3)), (5, y), (5, y), (5, near(y, 1)), (7, y),
            (None, z), (None, z), (None, near(z, 1)), (None, ""), (None, None), (9, " "), (9, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [tuple(r) for r in jaccard_join.keep_one(df).collect()]
    left = [r for r in got if split(r[1])]
    assert sorted((k, t.split()[:120]) for k, t in left if k) == sorted([(3, x.split()), (5, y.split())])
    assert [t.split()[:120] for k, t in left if k is None] == [z.split()]
    assert sorted((r for r in got if not split(r[1])), key=key) == sorted([(None, ""), (None, None), (9, " "), (9, " ")], key=key)


def test_components_with_hot_tokens_last(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FREQUENT", 5)
    got = jaccard_join.similar_documents(spark.createDataFrame(near_copies(), "doc_id long, text string"))
    got = got.select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=key) == brute_components(near_copies())


def brute_links(rows):
    """Similar texts other than the row's own; copies are one."""
    texts = {s for s in (shingles(t) for _, t in rows) if s}
    near = lambda s, t: s != t and 100 * len(s & t) >= 80 * len(s | t)
    links = {s: sum(near(s, t) for t in texts) for s in texts}
    return sorted(((k, links.get(shingles(t), 0)) for k, t in rows), key=key)


def sizes_in_a_chain():
    """Texts that grow by a twelfth: neighbours are similar, over several classes of sizes."""
    words = prose(13, 900).split()
    rows = [(i, " ".join(words[: int(40 * 1.08**i)])) for i in range(40)]
    return rows + [(50 + i, " ".join(words[:200]) + f" tail{i}") for i in range(20)] + [(80, rows[30][1])]


@pytest.mark.parametrize("block, dense", [(1024, 16), (7, 3)])
def test_links(spark, clashing, monkeypatch, block, dense):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", block)
    monkeypatch.setattr(jaccard_join, "DENSE", dense)
    monkeypatch.setattr(jaccard_join, "COLUMNS", 50)
    for rows in (near_copies() + [(300 + i, t) for i, t in sizes_in_a_chain()], [r[:2] for r in odd_rows()]):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = jaccard_join.similar_documents(df).select("doc_id", "n_links").collect()
        assert sorted(map(tuple, got), key=key) == brute_links(rows)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("aB \t\n\x0bé", max_size=40), min_size=1, max_size=5))
def test_shingle_sets(texts):
    sets = jaccard_join.shingle_sets([t.encode() for t in texts])
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            same = len(np.intersect1d(sets[i], sets[j]))
            assert same == len(shingles(a) & shingles(b))
            n, m = len(sets[i]), len(sets[j])
            assert jaccard_join.most_common(n, jaccard_join.bit_map(sets[i]), m, jaccard_join.bit_map(sets[j])) >= same


# token files


def test_token_files(spark, clashing, empty, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    file = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(file)
    docs = clashing.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    got = token_files.encode_and_index(docs, file, str(tmp_path / "t")).orderBy("doc_id").collect()
    start, texts = 0, {r[0]: r[1] or "" for r in odd_rows()}
    for r in got:
        ids = plain.encode(texts[r.doc_id], add_special_tokens=False).ids + [0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    read = token_files.read_tokens(spark, str(tmp_path / "t"), [6, 15], "doc_id").collect()
    assert sorted(r.doc_id for r in read) == [6, 15]
    every = token_files.encode_and_index(clashing, file).collect()
    assert len(every) == len(odd_rows()) and max(r.start for r in every if r.doc_id is None) < min(r.start for r in every if r.doc_id is not None)
    assert token_files.encode_and_index(empty, file).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("aé'st1.! \n\t\x00 <|", max_size=25), min_size=1, max_size=4))
def test_pieces_are_encoded_as_the_whole(texts):
    import public_tokenizers

    known = token_files._encoder(public_tokenizers.path("byte_bpe_50k.json"))
    ids, starts = known.encode(pa.array(texts), 0)
    for k, text in enumerate(texts):
        assert ids[starts[k] : starts[k + 1]].tolist() == [*np.frombuffer(known.ids(text), np.int32).tolist(), 0]


def test_remembered_pieces_are_bounded_and_asked_once(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(token_files, "REMEMBERED", 6)
    known, asked = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json")), []
    learn = known.learn
    known.learn = lambda new: asked.append(new.to_pylist()) or learn(new)
    batches = [["a bb", "bb\nccc a"], ["a bb", None], [f"w{i} a" for i in range(9)], ["a  odd " * 40, "a"], ["a bb"], ["a"]]
    for texts in batches:
        ids, starts = known.encode(pa.array([t or "" for t in texts], pa.string()), 0)
        for k, text in enumerate(texts):
            assert ids[starts[k] : starts[k + 1]].tolist() == [*np.frombuffer(known.ids(text or ""), np.int32).tolist(), 0]
    assert asked[0] == ["\n\na", "bb", "\n\nbb", "\nccc", "a"] and asked[1] == ["\n\n"]
    assert sum("a" in new for new in asked) == 1
    assert max(map(len, known.pieces.to_pylist())) < 100 and len(known.pieces) <= 6 + 2


def test_starts_follow_the_rows_of_the_files(spark, tmp_path):
    """Rows with one id, or none, stand in the files in the order of their starts."""
    import public_tokenizers

    rows = [(3, f"text {i} " + "w " * (i % 11)) for i in range(300)] + [(None, f"none {i}") for i in range(50)] + [(9, "last")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = token_files.encode_and_index(df, public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "t")).collect()
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    names = sorted(p for p in (tmp_path / "t").iterdir() if p.name.startswith("part-"))
    stored = [r for p in names for r in spark.read.orc(str(p)).orderBy(token_files.ROW).collect()]
    crc = [zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in stored]
    assert crc == [r.ids_crc32 for r in sorted(got, key=lambda r: r.start)]


# decontamination


def brute_hits(docs, items):
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lower = {i: i + 32 for i in range(65, 91)}
    windows = defaultdict(set)
    for k, t in items:
        w = re.findall(word, (t or "").translate(lower))
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[i : i + n])].add("null" if k is None else str(k))
    out = []
    for k, t in docs:
        w = re.findall(word, (t or "").translate(lower))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out.append((k, len(w), len(hit), sorted(found)))
    return sorted(out, key=key)


ITEMS = [(1, prose(1, 300)[40:400]), (2, "one, TWO!"), (3, None), (4, ""), (None, "süß"), (5, prose(9, 30)), (5, prose(9, 30)), (21, prose(1, 300)[40:400])]


@pytest.mark.parametrize("max_set", [50_000, 3])
def test_benchmark_hits(spark, clashing, empty, max_set):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("len", F.lit("x")).withColumn("mark", F.lit(1))
    got = decontaminate.scan(clashing, items, max_set=max_set).select("doc_id", "n_words", "n_hit", "items").collect()
    assert sorted(map(tuple, got), key=key) == brute_hits([r[:2] for r in odd_rows()], ITEMS)
    assert decontaminate.scan(empty, items).count() == 0
    assert {r.n_hit for r in decontaminate.scan(clashing, items.limit(0)).collect()} == {0}


def test_removal(spark, clashing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = {r.doc_id: (r.n_hit, r.n_words) for r in decontaminate.scan(clashing, items).collect()}
    kept = decontaminate.drop_documents(clashing, items)
    assert kept.columns == clashing.columns
    bad = {k for k, (h, n) in found.items() if h and 20 * h >= n}
    assert {r.doc_id for r in kept.collect()} == set(found) - bad and {0, 6} <= bad
    cut = decontaminate.cut_spans(clashing, items)
    assert cut.columns == clashing.columns and cut.count() == len(odd_rows())
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[6] == "" and texts[7] == {r[0]: r[1] for r in odd_rows()}[7]
    assert all(r.n_words == found[r.doc_id][1] - found[r.doc_id][0] for r in decontaminate.scan(cut, items.limit(0)).collect() if r.doc_id is not None)


# quality rules


def test_rules(clashing, empty):
    got = {(r.doc_id, r.n_words): r for r in quality_rules.judge(clashing).collect()}
    for k, text, *_ in odd_rows():
        words = split(text)
        r = got[k, len(words)]
        lines = [x for x in (text or "").split("\n") if split(x)]
        spots = defaultdict(list)
        for i in range(len(words) - 7):
            spots[tuple(words[i : i + 8])].append(i)
        again = {p for at in spots.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
        assert (r.word_chars, r.n_symbols) == (sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(again))
        assert r.base_failed == (len(words) < 20 or 100 * len(again) > 30 * len(words))
        assert not (r.kept and r.base_failed)
    assert quality_rules.judge(empty).count() == 0


# url filters


def test_urls(spark):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block")]
    urls = [None, "", "no scheme", "http://", "http://com", "http://com/", "HTTPS://WWW.Example.com/en/1?x#y", "http://m.example.com/en/2",
            "http://example.com/fr", "x://a.net/es/", "x://a.net/es", "x://net?a/es/", "x://b.org/es/", "http://example.com/en/\n://z", "x://notexample.com.net/es/#"]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(3, "http://com/")], "page_id long, url string").withColumn("host", F.lit("x")).withColumn("key", F.lit(1))
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")

    def brute(url):
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].translate({i: i + 32 for i in range(65, 91)}), m[2]) if m else ("", "")
        fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return host, path, *(max(fit)[1:] if fit else (None, "allow"))

    for limit in (64 << 20, 0):
        got = url_filter.judge(pages, listed, max_bytes=limit).collect()
        assert sorted(map(tuple, got), key=key) == sorted([(i, *brute(u)) for i, u in [*enumerate(urls), (3, "http://com/")]], key=key)
    assert url_filter.judge(pages.limit(0), listed).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, listed.limit(0)).collect()} == {"allow"}


def test_cascade_is_exact(spark):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("a"), F.xxhash64("id", F.lit(1)).alias("b"), "id")
    cascade = url_filter.build_cascade(keys.where("id % 9 = 0"), keys)
    rows = keys.toPandas()
    assert np.array_equal(cascade.test(rows["a"].to_numpy(), rows["b"].to_numpy()), (rows["id"] % 9 == 0).to_numpy())
    assert len(cascade.levels) > 2 and sum(map(len, cascade.levels)) * 64 < 40 * 20_000 / 9


# repeated passages


def brute_removed(rows):
    texts = [(k, (t or "").encode()) for k, t in rows]
    seen = Counter(t[i : i + 400] for _, t in texts for i in range(len(t) - 399))
    out = []
    for k, t in texts:
        mark = bytearray(len(t))
        for i in range(len(t) - 399):
            if seen[t[i : i + 400]] > 1:
                mark[i : i + 400] = b"\x01" * 400
        kept = bytes(b for b, m in zip(t, mark) if not m)
        out.append((k, len(t), sum(mark), len(re.findall(b"\x01+", bytes(mark))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=key)


def passages():
    a, b, c = prose(31, 90), prose(32, 70), prose(33, 400)
    rows = [(100 + i, prose(40 + i, 80) + x + prose(60 + i, 50) + y) for i, (x, y) in enumerate([(a, b), (a, ""), (b, a), (a[:399], b[:410]), (c, c), (c[100:900], b[3:]), (c[50:], a[1:])])]
    return rows + [(120 + i, c[: 700 + 13 * i] + "x" + c[700 + 13 * i + 1 :]) for i in range(12)] + [(140, "ab" * 900), (141, "z" * 400), (142, "z" * 399)]


@pytest.mark.parametrize("chunk", [1 << 19, 1000])
def test_repeats(spark, clashing, empty, monkeypatch, chunk):
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    for df, rows in ((spark.createDataFrame(passages(), "doc_id long, text string"), passages()), (clashing, [r[:2] for r in odd_rows()])):
        got = repeats.remove_repeats(df).select("doc_id", "n_bytes", "n_removed", F.size("starts"), F.sha2("kept", 256)).collect()
        assert sorted(map(tuple, got), key=key) == brute_removed(rows)
    assert repeats.remove_repeats(empty).count() == 0


def same_crc32(a, b):
    """Both texts with endings that give them the same crc32."""
    ends = [" " + hashlib.md5(b"%d" % i).hexdigest() for i in range(300_000)]
    seen = {zlib.crc32(e.encode(), zlib.crc32(a.encode())): e for e in ends}
    last = zlib.crc32(b.encode())
    other = next(e for e in ends if zlib.crc32(e.encode(), last) in seen)
    return a + seen[zlib.crc32(other.encode(), last)], b + other


def test_repeats_of_texts_with_one_crc32(spark):
    again = prose(71, 90)
    for k in (None, 4):
        x, y = same_crc32(prose(72, 80) + again + prose(73, 50), prose(74, 300))
        assert x != y and zlib.crc32(x.encode()) == zlib.crc32(y.encode())
        rows = [(k, x), (k, y), (1, prose(75, 60) + again + prose(76, 60))]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = repeats.remove_repeats(df).select("doc_id", "n_bytes", "n_removed", F.size("starts"), F.sha2("kept", 256)).collect()
        assert sorted(map(tuple, got), key=key) == brute_removed(rows)
