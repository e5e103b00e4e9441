"""Benchmark decontamination: a hash set of normalised test n-grams scanned over
training token windows, hits verified, spans or documents removed.

Windows of a document are met where they stand, inside its row: three word hashes of a
window are looked up in the set, and only the windows that pass are written out as text
and joined with the test n-grams, which verifies them.  The set travels inside the
plan and is used up to ``MAX_SET`` n-grams; a larger benchmark takes the other way, a
shuffled join of all windows' hashes.  Everything is a DataFrame operation.

Defined results: a missing or empty text has no words and is clean; an item without
words has no window; an item of fewer than 13 words is one window.  A missing item id
counts as the text ``null``.  Repeated rows are judged one by one, repeated items count
once per id.  An empty table on either side gives no hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeframe.runtime import materialize

from .text import NOT_ALNUM, covered, lower_ascii, whole, words

WINDOW = 13
#: Test n-grams that may travel in the plan, some 16 bytes each.
MAX_SET = 50_000


def tokens(text: Column) -> Column:
    return words(lower_ascii(whole(text)), NOT_ALNUM)


def _mark(hashes: str, i: Column, n: int) -> Column:
    """Hash of three words of the window of ``n`` words at ``i``."""
    return F.xxhash64(*[F.get(hashes, i + j) for j in (0, n // 2, n - 1)])


def item_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct ``item, len, mark, window`` of a benchmark."""
    b = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"), tokens(F.col(text)).alias("w")
    ).where(F.size("w") > 0)
    b = b.withColumn("len", F.least(F.size("w"), F.lit(WINDOW)))
    b = b.select("item", "w", "len", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("len"))).alias("i"))
    b = b.select("item", "len", F.slice("w", F.col("i") + 1, F.col("len")).alias("w"))
    at = [F.get("w", j) for j in (F.lit(0), F.floor(F.col("len") / 2).cast("int"), F.col("len") - 1)]
    mark = F.xxhash64(*[F.xxhash64(x) for x in at])
    return b.select("item", "len", mark.alias("mark"), F.array_join("w", " ").alias("window")).distinct()


def _places(n: int) -> Column:
    """All windows of ``n`` words of a row, without their words."""
    spot = F.transform(F.sequence(F.lit(0), F.size("h") - n), lambda i: F.struct(
        F.lit(n).alias("len"), i.alias("pos"), _mark("h", i, n).alias("mark")))
    none = F.array().cast("array<struct<len:int,pos:int,mark:bigint>>")
    return F.when(F.size("h") >= n, spot).otherwise(none)


def _spots(n: int, listed: list[int]) -> Column:
    """The windows of ``n`` words of a row whose mark is listed."""
    places = F.filter(F.sequence(F.lit(0), F.size("h") - n), lambda i: _mark("h", i, n).isin(listed))
    spot = F.transform(places, lambda i: F.struct(
        F.lit(n).alias("len"), i.alias("pos"), _mark("h", i, n).alias("mark"),
        F.array_join(F.slice("w", i + 1, n), " ").alias("window")))
    none = F.array().cast("array<struct<len:int,pos:int,mark:bigint,window:string>>")
    return F.when(F.size("h") >= n, spot).otherwise(none)


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    max_set: int = MAX_SET,
) -> DataFrame:
    """Per row of ``docs``: its key, ``text_hash``, ``n_words``, ``n_hit``, ``items``
    (sorted ids) and ``spans``, the verified windows as ``struct<pos, len>`` in words."""
    windows = materialize(item_windows(benchmark, item, item_text))
    lengths = sorted(r["len"] for r in windows.select("len").distinct().collect())  # 13 at most
    marks = windows.select("len", "mark").distinct()
    listed = marks.take(max_set + 1)
    d = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(key).alias("key"),
        F.xxhash64(F.col(text)).alias("text_hash"), tokens(F.col(text)).alias("w"),
    ).withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
    row = ["uid", "key", "text_hash", F.size("w").cast("long").alias("n_words")]
    if len(listed) <= max_set:
        spots = [_spots(n, [r["mark"] for r in listed if r["len"] == n]) for n in lengths]
        none = F.array().cast("array<struct<len:int,pos:int,mark:bigint,window:string>>")
        rows = materialize(d.select(*row, reduce(F.concat, spots, none).alias("spots")))
        found = rows.select("uid", F.explode("spots").alias("s")).select("uid", "s.*")
    else:
        # the other way: the marks of all windows, shuffled to those of the benchmark; only
        # hits go back to their documents for the words
        rows = materialize(d.select(*row, "w", "h"))
        places = F.explode(F.concat(*[_places(n) for n in lengths]))
        hit = rows.select("uid", places.alias("s")).select("uid", "s.*").join(marks, ["len", "mark"], "left_semi")
        at = hit.groupBy("uid").agg(F.collect_list(F.struct("len", "pos", "mark")).alias("at"))  # of one document
        found = rows.join(at, "uid").select("uid", "w", F.explode("at").alias("s")).select(
            "uid", "s.*", F.array_join(F.slice("w", F.col("s.pos") + 1, F.col("s.len")), " ").alias("window")
        )
    hits = found.join(windows.select("item", "len", "window"), ["len", "window"])
    spans = hits.groupBy("uid").agg(
        F.collect_set(F.struct("pos", "len")).alias("spans"), F.collect_set("item").alias("items")
    )
    return rows.select("uid", "key", "text_hash", "n_words").join(spans, "uid", "left").select(
        F.col("key").alias(key), "text_hash", "n_words",
        F.coalesce(covered(F.col("spans")), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.sort_array("items"), F.array().cast("array<string>")).alias("items"),
        F.sort_array("spans").alias("spans"),
    )


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """A twentieth of the words or more lie in test windows."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def _by_row(docs: DataFrame, found: DataFrame, key: str, text: str, how: str) -> DataFrame:
    row = docs.select(
        F.struct("*").alias("row"), F.col(key).alias("k"), F.xxhash64(F.col(text)).alias("hash")
    ).alias("r")
    same = F.col("r.k").eqNullSafe(F.col("f.k")) & (F.col("r.hash") == F.col("f.hash"))
    return row.join(found.alias("f"), same, how)


def drop_documents(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns."""
    bad = scan(docs, benchmark, key, text).where(contaminated(F.col("n_hit"), F.col("n_words")))
    bad = bad.select(F.col(key).alias("k"), F.col("text_hash").alias("hash")).distinct()
    return _by_row(docs, bad, key, text, "left_anti").select("row.*")


def cut_spans(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows of ``docs``, the words of test windows cut out of their texts together
    with the separators before each."""
    hit = scan(docs, benchmark, key, text).where(F.size("spans") > 0)
    hit = hit.groupBy(F.col(key).alias("k"), F.col("text_hash").alias("hash")).agg(F.first("spans").alias("spans"))
    joined = _by_row(docs, hit, key, text, "left")
    letters = NOT_ALNUM.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")
    body = F.col("row").getField(text)
    parts = F.regexp_extract_all(body, F.lit(f"(?:{letters})?" + letters.replace("[", "[^", 1)), F.lit(0))
    out = lambda i: F.exists("f.spans", lambda s: (s["pos"] <= i) & (i < s["pos"] + s["len"]))
    tail = F.regexp_extract(body, f"(?:{letters})?$", 0)
    left = F.concat(F.array_join(F.filter(parts, lambda p, i: ~out(i)), ""), tail)
    new = F.when(F.col("f.spans").isNotNull(), left).otherwise(body).alias(text)
    return joined.select(*[new if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])
