"""URL filters by a cascade of Bloom filters.

The first filter holds the listed keys, the second those keys of the corpus that pass
the first by mistake, the third the listed keys that pass the second by mistake, and
so on until no mistake is left.  As the cascade is built over every key that occurs in
the corpus, it answers exactly for all of them, and no page is joined with the list.

Bits are gathered by one aggregate per level; the filters travel to the tasks, where
numpy tests arrays of keys.  They are sized before they are built: beyond
``MAX_BYTES`` keys are looked up by a shuffled join instead.

Defined results: a missing url, or one without ``://``, has an empty host and path and
matches no rule.  Repeated pages are judged alike.  An empty list allows everything,
an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeframe.runtime import materialize

from .text import lower_ascii, whole

#: All filters of a cascade together, as sent to each executor.
MAX_BYTES = 64 << 20
HASHES = 8


@dataclass
class Cascade:
    """Filters as arrays of 64-bit words; the first is over the listed keys."""

    levels: list[np.ndarray] = field(default_factory=list)

    def __contains__(self, key: tuple[int, int]) -> bool:
        return bool(self.test(np.array([key[0]]), np.array([key[1]]))[0])

    def test(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which keys, given by two 64-bit hashes, are listed."""
        answer = np.zeros(len(a), bool)
        open_ = np.arange(len(a))
        for level, bits in enumerate(self.levels):
            passed = _passes(bits, level, a[open_], b[open_])
            answer[open_[~passed]] = level % 2 == 1
            open_ = open_[passed]
        answer[open_] = len(self.levels) % 2 == 1
        return answer


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = x.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(n_bits: int, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bit places of keys, one row per hash function."""
    x, y = _mix(a, 2 * level + 1), _mix(b, 2 * level + 2) | np.uint64(1)
    return np.stack([(x + np.uint64(i) * y) % np.uint64(n_bits) for i in range(HASHES)])


def _passes(bits: np.ndarray, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    at = _places(64 * len(bits), level, a, b)
    return ((bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)


def _filter_of(keys: DataFrame, level: int, words: int) -> np.ndarray:
    """The filter of stored keys: words of bits gathered by one aggregate."""

    def place(batches):
        for d in batches:
            at = _places(64 * words, level, d["a"].to_numpy(), d["b"].to_numpy()).ravel()
            bit = np.left_shift(np.uint64(1), at & np.uint64(63)).view(np.int64)
            yield pd.DataFrame({"word": (at >> np.uint64(6)).astype(np.int64), "bits": bit})

    got = keys.mapInPandas(place, "word long, bits long").groupBy("word").agg(F.expr("bit_or(bits)").alias("bits"))
    bits = np.zeros(words, np.uint64)
    for word, value in got.toLocalIterator():  # at most MAX_BYTES / 8 rows
        bits[word] = np.uint64(value % 2**64)
    return bits


def build_cascade(listed: DataFrame, universe: DataFrame, max_bytes: int = MAX_BYTES) -> Cascade | None:
    """The cascade of ``listed`` (``a, b``) that is exact over ``universe`` (``a, b``);
    None when it would take more than ``max_bytes``."""
    include = materialize(listed.select("a", "b").distinct())
    exclude = materialize(universe.select("a", "b").distinct().join(include, ["a", "b"], "left_anti"))
    cascade = Cascade()
    n, rest = include.count(), exclude.count()
    while n:
        rate = min(0.5, max(1e-9, n * math.sqrt(0.5) / max(rest, 1))) if not cascade.levels else 0.5
        # bits for that rate with a fixed number of hash functions
        size = -HASHES * n / math.log(1 - rate ** (1 / HASHES))
        words = max(1, math.ceil(size / 64))
        if 8 * (words + sum(map(len, cascade.levels))) > max_bytes:
            return None
        level = len(cascade.levels)
        bits = _filter_of(include, level, words)
        cascade.levels.append(bits)

        def mistakes(batches, bits=bits, level=level):
            for d in batches:
                yield d[_passes(bits, level, d["a"].to_numpy(), d["b"].to_numpy())]

        include, exclude = materialize(exclude.mapInPandas(mistakes, "a long, b long")), include
        n, rest = include.count(), n
    return cascade


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key).alias("a"), F.xxhash64(F.concat(key, F.lit("\0"))).alias("b")


def parts(url: Column) -> tuple[Column, Column]:
    """Host (``A-Z`` lower-cased) and path of a url."""
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    return lower_ascii(F.regexp_extract(whole(url), pattern, 1)), F.regexp_extract(whole(url), pattern, 2)


def judge(
    pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", max_bytes: int = MAX_BYTES
) -> DataFrame:
    """Verdict of every page: ``key, host, path, rule, verdict``.

    ``rules`` has ``host, path, verdict`` (``allow`` or ``block``).  A rule fits its host
    and all subdomains when the page's path starts with the rule's; the longest wins,
    of equally long ones that with the longer host.  A page without a rule is on no
    list and allowed.  A rule listed both ways blocks.
    """
    rules = rules.select(F.concat("host", "path").alias("rule"), F.length("path").alias("n"), "verdict")
    lengths = sorted(r["n"] for r in rules.select("n").distinct().collect())  # lengths of paths: few
    host, path = parts(F.col(url))
    p = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.")
    tails = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    heads = F.array_compact(F.array(*[
        F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths
    ])) if lengths else F.array().cast("array<string>")
    keys = F.flatten(F.transform(tails, lambda t: F.transform(
        heads, lambda h: F.struct(F.length(F.concat(t, h)).alias("len"), F.length(t).alias("h"), F.concat(t, h).alias("rule")))))
    keys = F.when(F.col("host") != "", F.sort_array(keys, asc=False))
    p = p.withColumn("keys", F.transform(keys, lambda k: k["rule"]))
    universe = p.select(F.explode("keys").alias("k")).select(*_hashes(F.col("k")))
    listed = {v: rules.where(F.col("verdict") == v).select(*_hashes(F.col("rule"))) for v in ("allow", "block")}
    stored = materialize(universe.distinct()) if lengths else universe
    cascades = {v: build_cascade(of, stored, max_bytes) for v, of in listed.items()}
    if None in cascades.values():
        return _judge_by_join(p, rules, key)

    @F.pandas_udf("array<boolean>")
    def on_list(a: pd.Series, b: pd.Series, which: pd.Series) -> pd.Series:
        cascade, sizes = cascades[which.iat[0]], a.str.len().to_numpy()
        flat = [np.concatenate(x.to_list()).astype(np.int64) if sizes.sum() else np.zeros(0, np.int64) for x in (a, b)]
        answer = cascade.test(*flat)
        return pd.Series(np.split(answer, np.cumsum(sizes)[:-1])) if len(sizes) else pd.Series([], dtype=object)

    some = F.coalesce("keys", F.array().cast("array<string>"))
    a, b = F.transform(some, lambda k: _hashes(k)[0]), F.transform(some, lambda k: _hashes(k)[1])
    p = p.withColumn("blocks", on_list(a, b, F.lit("block"))).withColumn("allows", on_list(a, b, F.lit("allow")))
    hits = F.filter(
        F.arrays_zip(some.alias("rule"), F.col("blocks").alias("block"), F.col("allows").alias("allow")),
        lambda x: x["block"] | x["allow"],
    )
    best = F.get(hits, 0)
    return p.select(
        F.col("key").alias(key), "host", "path", best["rule"].alias("rule"),
        F.when(F.coalesce(best["block"], F.lit(False)), "block").otherwise("allow").alias("verdict"),
    )


def _judge_by_join(p: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """The same verdicts for lists too long to send: a shuffled join of the keys."""
    p = materialize(p.withColumn("uid", F.monotonically_increasing_id()))
    rules = rules.groupBy("rule").agg(F.max("verdict").alias("verdict"))  # block > allow
    keys = p.select("uid", F.posexplode("keys").alias("order", "rule"))
    best = keys.join(rules, "rule").groupBy("uid").agg(F.min(F.struct("order", "rule", "verdict")).alias("best"))
    return p.join(best, "uid", "left").select(
        F.col("key").alias(key), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit("allow")).alias("verdict"),
    )
