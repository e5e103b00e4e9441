"""Quality rules: one threshold table compiled into one projection.

Every metric is a column expression and every rule a comparison of two metrics, so
that a scan, one projection and no exchange judge any number of documents.

Defined results: a missing or empty text has no words, fails the base rule and is not
kept.  Repeated rows are judged alike.  Only the two named columns are read, whatever
other columns the table has.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import UPPER, WHITE_CHARS, whole, words

#: Very common words of four languages, the default stop-word list.
STOP_WORDS = (
    "the of and to in a is was with that by for as on it or are be this from "
    "der die das und zu den von mit ein eine im ist nicht des auf sich "
    "le la les de des et un une du en est que pour dans pas par "
    "el los las y del por con se su una no"
).split()

SYMBOLS = "#*$%&|<>"
#: Words of a window whose repetition counts.
WINDOW = 8


@dataclass(frozen=True)
class Threshold:
    """``low <= 100 * part / of <= high``; a side that is None is open."""

    name: str
    part: str
    of: str
    low: int | None = None
    high: int | None = None

    def failed(self) -> Column:
        part, of = 100 * F.col(self.part), F.col(self.of)
        tests = [part < self.low * of] if self.low is not None else []
        tests += [part > self.high * of] if self.high is not None else []
        return tests[0] | tests[1] if len(tests) == 2 else tests[0]


#: Ratios in per cent: word length from 2 to 15 characters, at most one symbol in ten
#: words, at least one stop word in twenty, at most three repeated lines in ten.
THRESHOLDS = (
    Threshold("word_length", "word_chars", "n_words", 200, 1500),
    Threshold("symbols", "n_symbols", "n_words", None, 10),
    Threshold("stop_words", "n_stop_words", "n_words", 5, None),
    Threshold("repeated_lines", "n_dup_lines", "n_lines", None, 30),
)

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def metrics(docs: DataFrame, key: str = "doc_id", text: str = "text", stop_words=STOP_WORDS) -> DataFrame:
    """``key`` and the metrics of every text.

    ``n_repeat_words`` counts the words inside windows of eight words that occur twice
    or more in the text.  Windows are compared by 64-bit hashes, within one text only.
    """
    body = F.col("body")
    plain = F.translate(body, UPPER + ".,;:!?", UPPER.lower())
    d = docs.select(F.col(key).alias("key"), whole(F.col(text)).alias("body")).select(
        "key",
        words(body).alias("words"),
        F.filter(F.split(body, "\n"), lambda x: F.length(F.translate(x, WHITE_CHARS, "")) > 0).alias("lines"),
        F.length(F.translate(body, WHITE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size(F.filter(words(plain), lambda w: w.isin(list(stop_words)))).cast("long").alias("n_stop_words"),
    )
    d = d.select(
        "key",
        "word_chars",
        "n_symbols",
        "n_stop_words",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    starts = F.sequence(F.lit(1), F.col("n_words").cast("int") - (WINDOW - 1))
    d = d.withColumn(
        "windows",
        F.when(
            F.col("n_words") >= WINDOW,
            F.transform(starts, lambda i: F.xxhash64(F.slice("hashes", i, WINDOW))),
        ).otherwise(F.array().cast("array<bigint>")),
    ).drop("hashes")
    # sorted with their places, only where some window occurs twice
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("pos"))))
    d = d.withColumn(
        "placed", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), placed)
    ).drop("windows")
    same = lambda x, j: F.coalesce(F.get("placed", j)["h"] == x["h"], F.lit(False))
    again = F.filter("placed", lambda x, i: same(x, i - 1) | same(x, i + 1))
    d = d.withColumn("again", F.sort_array(F.transform(again, lambda x: x["pos"]))).drop("placed")
    step = lambda acc, p: F.struct(
        (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last")
    )
    nothing = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    repeated = F.aggregate("again", nothing, step, lambda acc: acc["n"])
    return d.select(
        F.col("key").alias(key), *BASE[:4], "n_lines", "n_stop_words",
        F.coalesce(repeated, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", thresholds=THRESHOLDS, stop_words=STOP_WORDS) -> DataFrame:
    """Metrics, ``base_failed``, ``kept`` and the names of the rules a text fails."""
    m = metrics(docs, key, text, stop_words)
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    broken = F.array_compact(F.array(*[F.when(t.failed(), F.lit(t.name)) for t in thresholds]))
    return m.select(
        key, *BASE, base.alias("base_failed"),
        (~base & (F.size(broken) == 0)).alias("kept"),
        F.array_join(broken, ",").alias("failed_rules"),
    )
