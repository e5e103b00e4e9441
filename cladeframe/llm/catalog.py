"""The registered queries of the operators and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import functions as F

from cladeframe.catalog.registry import Tables

from . import (
    cross_parsing, decontaminate, jaccard_join, mixing, packing, prefix_trie, quality_rules, repeats, sharding,
    subword_quality, token_alignment, token_files, url_filter,
)
from .text import whole

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


WORDS = rf"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query("op2_curriculum", rf"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 't' ELSE 's' || source END AS src,
    len({WORDS}) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS name FROM documents),
s AS (SELECT src, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY src),
r AS (SELECT *, CASE row_number() OVER (ORDER BY src) % 3 WHEN 1 THEN 5.0::DOUBLE WHEN 2 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM s),
l AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY source_size / weight, src
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY source_size / weight, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
c AS (SELECT *, 2.0::DOUBLE * source_size <= weight * level AS capped FROM l),
t AS (SELECT src, source_size, CASE WHEN capped THEN 2.0::DOUBLE * source_size
    ELSE weight * max(CASE WHEN NOT capped THEN level END) OVER () END AS target FROM c),
o AS (
  SELECT d.*, source_size, target, CAST(coalesce(sum(size) OVER (PARTITION BY src ORDER BY name, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS start FROM d JOIN t USING (src))
SELECT doc_id, size, source_size, target,
  CASE WHEN source_size = 0 THEN 0 ELSE size * (CAST(floor(target / source_size) AS BIGINT)
    + CASE WHEN start + size / 2.0::DOUBLE < target - source_size * floor(target / source_size) THEN 1 ELSE 0 END) END AS taken
FROM o""")
def _(t):
    planned = mixing.plan(t.documents)
    first = F.get("positions", 0)
    return planned.orderBy(first.asc_nulls_last(), "doc_id").select("doc_id", "size", "source_size", "target", "taken")


@query("op6_broadcast_set", rf"""
WITH dw AS (
  SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bp AS (SELECT item, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM bw WHERE len(w) > 0),
bn AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM bp),
dp AS (SELECT uid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, (SELECT DISTINCT n FROM bn) WHERE len(w) >= n),
h AS (SELECT uid, i, p.n, item FROM (SELECT uid, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM dp) p JOIN bn ON p.g = bn.g AND p.n = bn.n),
c AS (SELECT uid, count(DISTINCT p) AS n_hit FROM (SELECT uid, unnest(range(i, i + n)) AS p FROM h) GROUP BY uid),
k AS (SELECT uid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY uid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN c USING (uid) LEFT JOIN k USING (uid)""")
def _(t):
    found = decontaminate.scan(t.documents, t.benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


STOP = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)


@query("op7_threshold_table", rf"""
WITH d AS (
  SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS body, {WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS plain
  FROM documents),
g AS (SELECT uid, i, array_to_string(w[i:i + 7], ' ') AS win FROM (SELECT uid, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
a AS (SELECT uid, i FROM g QUALIFY count(*) OVER (PARTITION BY uid, win) > 1),
r AS (SELECT uid, count(DISTINCT p) AS n FROM (SELECT uid, unnest(range(i, i + 8)) AS p FROM a) GROUP BY uid),
m AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    len(lines) AS n_lines, len(list_filter(plain, lambda x: x IN ({STOP}))) AS n_stop
  FROM d LEFT JOIN r USING (uid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * word_chars BETWEEN 200 * n_words AND 1500 * n_words AND 100 * n_symbols <= 10 * n_words
    AND 100 * n_stop >= 5 * n_words AND 100 * n_dup_lines <= 30 * n_lines AS kept
FROM b""")
def _(t):
    return quality_rules.judge(t.documents).drop("failed_rules")


RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)


@query("op9_filter_cascade", rf"""
WITH rules(h, p, v) AS (VALUES {', '.join(map(str, RULES))}),
u AS (
  SELECT row_number() OVER () AS uid, page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
f AS (SELECT uid, h || p AS rule, v FROM u JOIN rules ON (host = h OR suffix(host, '.' || h)) AND prefix(path, p)
  QUALIFY row_number() OVER (PARTITION BY uid ORDER BY length(h || p) DESC, length(h) DESC) = 1)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN f USING (uid)""")
def _(t):
    rules = t.spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return url_filter.judge(t.pages, rules)


@query("op1_histogram_sort")
def _(t):
    size = F.octet_length(whole(F.col("text"))).cast("long") + 16
    narrow = t.documents.select(
        "doc_id", size.alias("size"), F.crc32(whole(F.col("text"))).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"),
    )
    sharded = sharding.histogram_shards(narrow, ["text_hash", "doc_id"], "size", shards=40)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def remainder(key, n: int):
    return F.pmod(F.crc32(F.col(key).cast("string")), F.lit(n))


@query("op3_subword_embeddings")
def _(t):
    model = subword_quality.fit(t.documents, t.labels, learn=remainder("key", 4) != 2)
    scored = t.documents.select(
        "doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        subword_quality.score(F.col("text"), model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query("op5_orc_files")
def _(t):
    import public_tokenizers

    return token_files.encode_and_index(t.documents, public_tokenizers.path("byte_bpe_50k.json"))


@query("op8_cross_parsing")
def _(t):
    model = cross_parsing.fit(t.documents, learn=remainder("doc_id", 3) != 1)
    judged = t.documents.select(
        "doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        cross_parsing.identify(F.col("text"), model).alias("found"),
    )
    return judged.select("doc_id", "held_out", "found.lang_pred", "found.score")


@query("op10_radix_suffixes")
def _(t):
    cut = repeats.remove_repeats(t.documents)
    return cut.select(
        "doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op4_token_group_matrix")
def _(t):
    return jaccard_join.similar_documents(t.documents)


@query("op11_run_skipping")
def _(t):
    import public_tokenizers

    return token_alignment.alignment_statistics(
        t.documents, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )


#: CRC-32 of a decimal number, bit by bit.
CRC32 = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ord(x)::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)))"""


@query("op12_ternary_trees", rf"""
WITH c AS (SELECT conv_id, {CRC32} % 6 AS h FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
t AS (
  SELECT conv_id, sha256(coalesce(role, '')) || sha256(coalesce(text, '')) AS turn_key, length(coalesce(text, '')) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p FROM conversations WHERE conv_id IS NOT NULL),
r AS (
  SELECT c.conv_id, 0 AS part, p, turn_key, chars FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND p <= h
  UNION ALL SELECT c.conv_id, 1, p, turn_key, chars FROM c JOIN t ON t.conv_id = c.conv_id AND p > h),
s AS (
  SELECT c.conv_id, coalesce(keys, []) AS keys, coalesce(sizes, []) AS sizes FROM c LEFT JOIN (
    SELECT conv_id, list(turn_key ORDER BY part, p) AS keys, list(chars ORDER BY part, p) AS sizes FROM r GROUP BY conv_id) USING (conv_id)),
d AS (SELECT conv_id, keys, sizes, unnest(range(0, len(keys) + 1)) AS depth FROM s),
m AS (
  SELECT conv_id, depth, sha256(array_to_string(keys[1:depth], '')) AS node, CASE WHEN depth > 0 THEN sha256(array_to_string(keys[1:depth - 1], '')) END AS parent,
    CASE WHEN depth > 0 THEN sizes[depth] ELSE 0 END AS chars, depth = len(keys) AS ends FROM d),
n AS (
  SELECT node, parent, depth, chars, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM m GROUP BY node, parent, depth, chars),
k AS (SELECT n.*, coalesce(n_children, 0) AS n_children, up.conv_id AS parent_conv_id FROM n
  LEFT JOIN (SELECT parent, count(*) AS n_children FROM n GROUP BY parent) AS below ON below.parent = n.node
  LEFT JOIN (SELECT node, conv_id FROM n) AS up ON up.node = n.parent),
a AS (SELECT DISTINCT x.node AS above, y.node FROM m AS x JOIN m AS y ON x.conv_id = y.conv_id AND x.depth <= y.depth),
u AS (SELECT above, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum((n_convs - 1) * chars) AS BIGINT) AS saved_tokens FROM a JOIN k USING (node) GROUP BY above)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM k JOIN u ON above = node""")
def _(t):
    return prefix_trie.rebuilt_trie(t.conversations)


@query("op13_exact_complements")
def _(t):
    import public_tokenizers

    pieces = packing.encode_pieces(t.documents, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)
    return packing.pack(pieces)
