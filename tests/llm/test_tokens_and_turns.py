"""Alignment, prefix trie and packing against brute force in plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from awkward import SCHEMA, odd_rows, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cladeframe.llm import catalog, packing, pieces, prefix_trie, token_alignment

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")

TRICKY = [
    "a\nb", "\na", "a\n", "a  b", "a b ", "   x", "=" * 3000, " a", "x▁y z", "don't <0x41> <unk> <s> x\n<|endoftext|>\nй",
    "日本語 テキスト\n語", "one\ttab", "café café", "İstanbul I'LL <|startoftext|>x a,b..c 12ab", "\x00", " ",
]


def texts():
    return [r[1] for r in odd_rows()] + TRICKY


def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def brute_groups(text, a, b):
    """Groups of a text as lists of ids, by the offsets at which both end."""
    if not text:
        return []
    spelled = (" " + text).encode()
    tokens_a = a.encode(" " + text, add_special_tokens=False)
    ids_b = b.encode(text)
    table = a.decoder  # byte-level: decoding single ids gives their bytes
    assert table is not None
    bytes_a = [token_alignment._byte_of()[c] for t in tokens_a.tokens for c in t]
    ends_a = np.cumsum([len(t) for t in tokens_a.tokens]).tolist()
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
    ends_b = np.cumsum(list(map(len, bytes_b))).tolist()
    if bytes(bytes_a) != spelled or b"".join(bytes_b) != spelled:
        return []
    groups, low = [], 0
    for end in sorted(set(ends_a) & set(ends_b)):
        groups.append(([i for i, e in zip(tokens_a.ids, ends_a) if low < e <= end], [i for i, e in zip(ids_b, ends_b) if low < e <= end]))
        low = end
    return groups


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=80))
def test_runs_and_irregular_groups(kinds):
    # 0: both end, 1: only A, 2: only B, 3: neither
    ends_a = [i for i, k in enumerate(kinds) if k in (0, 1)] + [len(kinds)]
    ends_b = [i for i, k in enumerate(kinds) if k in (0, 2)] + [len(kinds)]
    stops_a, stops_b = token_alignment.align(ends_a, ends_b)
    both = [i for i, k in enumerate(kinds) if k == 0] + [len(kinds)]
    assert [ends_a[s - 1] for s in stops_a] == both == [ends_b[s - 1] for s in stops_b]


def test_long_groups_give_all_links():
    a, b = np.array([1, 2] * 100 + [5]), np.array([7] * 60 + [8] * 60 + [9, 9])
    keys, times, group = token_alignment.links(a, b, np.array([200, 1]), np.array([120, 2]))
    got = Counter()
    for k, n, g in zip(keys.tolist(), times.tolist(), group.tolist()):
        got[g, k >> 32, k & 0xFFFFFFFF] += n
    assert got == Counter({(0, x, y): 100 * 60 for x in (1, 2) for y in (7, 8)} | {(1, 5, 9): 2})


def test_pieces_align_as_whole_texts():
    aligner = token_alignment.Aligner(BYTES, PIECES)
    a, b = tokenizers()
    given = [t or "" for t in texts()]
    codes, starts, found = aligner.cut(pa.array(given))
    told = aligner.texts(aligner.align(found))
    for k, text in enumerate(given):
        if len(text) > 20_000:
            continue
        parts = [told[c][:-1] for c in codes[starts[k] : starts[k + 1]]]
        expected = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in brute_groups(text, a, b))
        assert ";".join(parts) == expected, text[:40]


def brute_alignment(rows):
    """The contract's columns by document, from a plain pass over all rows."""
    a, b = tokenizers()
    groups = [brute_groups(text, a, b) for _, text in rows]
    linked = [Counter((x, y) for g, h in doc for x in g for y in h) for doc in groups]
    held = Counter(pair for doc in linked for pair in doc)
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for (key, _), doc, links in zip(rows, groups, linked):
        told = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in doc)
        out.append((
            key, sum(len(g) for g, _ in doc), sum(len(h) for _, h in doc), len(doc), sum(links.values()),
            sum(n for (x, y), n in links.items() if held[x, y] == best[x]), sum(n * held[p] for p, n in links.items()),
            hashlib.sha256(told.encode()).hexdigest() if doc else "",
        ))
    return sorted(out, key=repr)


ALIGNED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def alignment_rows():
    rows = [(i, t) for i, t in enumerate(texts()) if len(t or "") < 5000]
    return rows + [(3, "again and again"), (3, "again and again"), (None, "again"), (None, None)]


def test_op11_is_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", 300)  # many blocks
    rows = alignment_rows()
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.QUERIES["op11_run_skipping"](spark, str(tmp_path))
    assert got.columns == ALIGNED
    assert sorted(map(tuple, got.collect()), key=repr) == brute_alignment(rows)


def test_alignment_ignores_other_columns(spark, clashing, empty):
    rows = [(r.doc_id, r.text) for r in clashing.collect() if len(r.text or "") < 5000]
    got = token_alignment.alignment_statistics(clashing.where("coalesce(length(text), 0) < 5000"), BYTES, PIECES)
    assert sorted(map(tuple, got.select(ALIGNED).collect()), key=repr) == brute_alignment(rows)
    assert token_alignment.alignment_statistics(empty, BYTES, PIECES).count() == 0


def test_aligned_documents_hold_tokens_and_groups(spark):
    a, b = tokenizers()
    rows = [(i, t) for i, t in enumerate(texts()) if len(t or "") < 5000]
    for r in token_alignment.aligned_documents(spark.createDataFrame(rows, "doc_id long, text string"), BYTES, PIECES).collect():
        groups = brute_groups(dict(rows)[r.doc_id], a, b)
        assert (r.a_ids, r.b_ids) == ([i for g, _ in groups for i in g], [i for _, g in groups for i in g])
        assert (r.group_a, r.group_b) == ([len(g) for g, _ in groups], [len(g) for _, g in groups])


# prefix trie


def crc(number):
    return zlib.crc32(str(number).encode())


def rebuilt(rows):
    """Rebuilt conversations from (conv_id, turn, role, text)."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(role, text) for _, _, role, text in sorted(t)] for c, t in turns.items()}
    return {c: (turns.get(c - c % 100, [])[: crc(c) % 6] + t[crc(c) % 6 :]) for c, t in turns.items()}


def brute_trie(conversations):
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        leaf = {n for n in below if not any(m[:-1] == n for m in below if m)}
        ends = ",".join(map(str, sorted(c for c in convs if len(conversations[c]) == len(node))))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            sum(len(n) == len(node) + 1 for n in below), len(leaf),
            sum((len(members[n]) - 1) * (len(n[-1][1]) if n else 0) for n in below), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


TURNS = "conv_id long, turn long, role string, text string"
TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversation_rows(seed=3, n=330):
    draw = random.Random(seed)
    rows = []
    for c in range(90, 90 + n):
        if c == 200:
            continue  # a block without its first conversation
        for turn in range(draw.choice([1, 1, 2, 3, 7, 9])):
            rows.append((c, turn, draw.choice(["user", "bot", None]), draw.choice(["hi", "hé\U0001f600", None, "", "hi there"])))
    rows += [(7, None, "user", "first"), (7, 0, "user", "second"), (7, None, None, None), (8, 1, "a:1", "x"), (8, 1, "a:1", "x")]
    rows += [(None, 0, "user", "lost"), (100_000, 0, "user", "\x00" * 3)]
    return rows


@pytest.mark.parametrize("shards", [1, 4, 60])
def test_trie_is_brute_force(spark, shards):
    rows = conversation_rows()
    sequences = prefix_trie.grafted(prefix_trie.turn_sequences(spark.createDataFrame(rows, TURNS)))
    got = prefix_trie.prefix_trie(sequences, shards).select(TRIE).collect()
    assert sorted(map(tuple, got), key=repr) == brute_trie(rebuilt(rows))


def test_op12_is_brute_force(spark, tmp_path):
    rows = conversation_rows(5)
    spark.createDataFrame(rows, TURNS).withColumn("node", F.lit("x")).withColumn("base", F.lit(1)).write.parquet(f"{tmp_path}/conversations.parquet")
    got = catalog.QUERIES["op12_ternary_trees"](spark, str(tmp_path))
    assert sorted(got.columns) == sorted(TRIE)
    assert sorted(map(tuple, got.select(TRIE).collect()), key=repr) == brute_trie(rebuilt(rows))


def test_copies_fill_many_shards(spark):
    """A group of copies larger than a shard is boundary in each of them."""
    same = [("user", "q"), ("bot", "answer"), ("user", "more")]
    rows = [(c * 100, t, *turn) for c in range(1, 400) for t, turn in enumerate(same)]
    rows += [(c * 100, t, *turn) for c in range(400, 420) for t, turn in enumerate(same[:2])]
    rows += [(c * 100, t, *turn) for c in range(420, 430) for t, turn in enumerate([*same, ("bot", str(c))])]
    sequences = prefix_trie.grafted(prefix_trie.turn_sequences(spark.createDataFrame(rows, TURNS)))
    got = prefix_trie.prefix_trie(sequences, 16).select(TRIE).collect()
    assert sorted(map(tuple, got), key=repr) == brute_trie(rebuilt(rows))


def test_long_conversation_and_empty_table(spark):
    rows = [(100, t, "user", f"turn {t}") for t in range(3000)] + [(100 + c, 0, "user", "turn 0") for c in range(1, 30)]
    got = prefix_trie.rebuilt_trie(spark.createDataFrame(rows, TURNS)).agg(F.count("*"), F.max("depth"), F.max("n_convs")).first()
    expected = rebuilt(rows)
    assert tuple(got) == (len({tuple(t[:d]) for t in expected.values() for d in range(len(t) + 1)}), 3000, 30)
    assert prefix_trie.rebuilt_trie(spark.createDataFrame(rows, TURNS).limit(0)).count() == 0


def test_nodes_get_their_last_turn(spark):
    rows = conversation_rows(8)
    df = spark.createDataFrame(rows, TURNS)
    conversations = rebuilt(rows)
    got = prefix_trie.last_turns(prefix_trie.rebuilt_trie(df), df).collect()
    for r in got:
        assert (r.role, r.text) == (conversations[r.conv_id][r.depth - 1] if r.depth else (None, None))


def test_ternary_tree_is_balanced_and_whole():
    sequences = sorted({tuple(random.Random(i).choices(range(50), k=i % 5)) for i in range(800)})
    tree = prefix_trie.TernaryTree()
    nodes = tree.insert_sorted([list(s) for s in sequences])
    assert len(set(nodes)) == len(sequences)
    assert [[tree.code[v] for v in tree.path(n)[1:]] for n in nodes] == [list(s) for s in sequences]
    assert len(tree.code) == len({s[:d] for s in sequences for d in range(len(s) + 1)})


# packing


def check_packing(rows, capacity):
    """Gapless sequences of at most ``capacity``, every piece in one of them."""
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 40), max_size=20))
def test_plan_uses_every_piece_once(counts):
    fillings = packing.plan(counts, 30)
    used = Counter()
    for pattern, many in fillings:
        assert many > 0 and sum(n * m for n, m in pattern.items()) <= 30
        for n, m in pattern.items():
            used[n] += m * many
    assert used == Counter(counts)
    total = sum(n * m for n, m in counts.items())
    least = -(-total // 30)
    singles = sum(m for n, m in counts.items() if n > 15)
    assert max(least, singles) <= sum(many for _, many in fillings) <= 2 * max(least, singles)


def test_long_pieces_without_complement_keep_their_partners():
    # 11 of 16 + 10, the other ten of length 10 by threes
    assert sum(many for _, many in packing.plan({10: 21, 16: 11}, 30)) == 15


def test_exact_complements_leave_no_gap():
    # 50 + 30 + 20, 61 + 39, 97 + 1 + 1 + 1
    fillings = packing.plan({50: 4, 30: 4, 20: 4, 61: 7, 39: 7, 97: 2, 1: 6}, 100)
    assert sum(many for _, many in fillings) == 13
    assert all(sum(n * m for n, m in p.items()) == 100 for p, _ in fillings)


def test_words_encode_as_whole_texts():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    given = [t or "" for t in texts()]
    ids, starts = packing.encode_words(pa.array(given), WORDS, 1)
    for k, text in enumerate(given):
        assert ids[starts[k] : starts[k + 1]].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]


def brute_pieces(rows, capacity=4096):
    from tokenizers import Tokenizer

    tokenizer, out = Tokenizer.from_file(WORDS), []
    for key, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for p, low in enumerate(range(0, len(ids), capacity)):
            piece = np.array(ids[low : low + capacity], "<u4")
            out.append((key, p, low, len(piece), zlib.crc32(piece.tobytes())))
    return sorted(out, key=repr)


def test_op13_is_brute_force(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(texts())] + [(3, "again"), (3, "again"), (None, "again"), (None, None)]
    rows += [(1000 + i, prose(i, 1 + i % 90)) for i in range(300)] + [(2000 + i, "same few words here") for i in range(500)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.QUERIES["op13_exact_complements"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got = got.collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute_pieces(rows)
    assert check_packing(got, 4096) == -(-sum(r.length for r in got) // 4096)


def test_packed_sequences_hold_the_ids(spark, clashing, empty):
    made = packing.encode_pieces(clashing, WORDS, capacity=100)
    packed = packing.pack(made, 100).collect()
    check_packing(packed, 100)
    expected = defaultdict(list)
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        expected[r.sequence_id].extend(r.ids)
    again = packing.pack(made, 100)
    assert sorted(map(len, expected.values())) == sorted(len(r.ids) for r in packing.sequences(again).collect())
    assert sorted((tuple(r)[:5] for r in packed), key=repr) == brute_pieces([(r.doc_id, r.text) for r in clashing.collect()], 100)
    assert packing.pack(packing.encode_pieces(empty, WORDS)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(0,), (101,)], "length long"), 100)


def test_remembered_pieces_come_and_go():
    asked = []
    known = pieces.Known(lambda new: asked.append(list(new)) or [p.upper() for p in new], 4)
    for some in (["a", "b"], ["b", "c"], ["d", "a"], ["e", "f", "a"], ["b", "g"], ["a", "c"]):
        assert known.of(some) == [p.upper() for p in some]
        assert len(known.now) <= 6
    assert asked[0] == ["a", "b"] and asked[1] == ["c"]
    long = "x" * (pieces.LONG + 1)
    assert known.of([long, "a"]) == [long.upper(), "A"] and long not in known.now


def test_batches_hold_bounded_texts():
    sizes = [10, 500, 0, 30, 30, 30, 200, 1, 1]
    batch = pa.RecordBatch.from_pydict({"k": list(range(9)), "text": ["x" * n if n else None for n in sizes]})
    parts = list(pieces.batches(batch, 1, 100))
    assert [k for p in parts for k in p.column(0).to_pylist()] == list(range(9))
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column(1).to_pylist()) <= 100 for p in parts)
    assert SCHEMA.startswith("doc_id")
