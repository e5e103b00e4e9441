"""Exact order statistics without sorting: counting below pivots.

Every wanted rank has an open interval of values that it must lie in.  A round takes
pivots from the values inside (a mergeable sketch, which only decides how fast intervals
shrink), counts exactly what lies below, at and above the two around the rank, and either
finds the value or goes on with a part of the interval.  Counts and sketches are combined
map-side; no task sees more than its part of the rows, whatever the ties.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import MAX_SMALL_ROWS, DataError, materialize, small_rows

#: Pivots of a round; an interval shrinks by about a third of this.
PIVOTS = 512
MAX_ROUNDS = 200
#: Values around all wanted ranks that are brought to the driver at the end.
FEW = 20_000


def order_statistics(values: DataFrame, keys: list[str], fractions: list[float]) -> DataFrame:
    """``keys, q``: for each group of ``keys, value, n`` (``n`` equal values) the quantiles
    at ``fractions``, linear between the two neighbouring ranks.  Groups and ranks are a
    dimension (``runtime.MAX_SMALL_ROWS``); null values count for nothing."""
    spark = values.sparkSession
    kinds = [f"`{k}` {values.schema[k].dataType.simpleString()}" for k in keys]
    rows = materialize(values.where("value is not null and n > 0").select(*keys, F.col("value").cast("double"), "n"))
    grid = F.array(*[F.lit(i / PIVOTS) for i in range(PIVOTS + 1)])
    held, pivots = F.sum("n").alias("held"), F.percentile_approx("value", grid, 4 * PIVOTS).alias("pivot")
    # the first round has no bounds yet
    first = small_rows(rows.groupBy(*keys).agg(held, pivots), "groups of quantiles", MAX_SMALL_ROWS // PIVOTS)
    totals = {tuple(r[k] for k in keys): r["held"] for r in first if r["held"]}
    start = {tuple(r[k] for k in keys): list(r["pivot"]) for r in first if r["held"]}
    wanted = {
        (g, r): (None, None, 0, total)
        for g, total in totals.items() for f in fractions
        for r in (math.floor(f * (total - 1)), math.ceil(f * (total - 1)))
    }
    found: dict[tuple, float] = {}
    cuts = {(g, r): _around(start[g], r, totals[g]) for g, r in wanted}
    names = ", ".join([*kinds, "rank bigint, low double, high double, below bigint, a double, b double"])

    def meet(state: DataFrame) -> DataFrame:
        same = F.lit(True)
        for k in keys:
            # a group without a value of the key is a group too
            same = same & F.col(f"v.{k}").eqNullSafe(F.col(f"s.{k}"))
        inside = "(low is null or value > low) and (high is null or value < high)"
        # one row for each wanted rank
        joined = rows.alias("v").join(F.broadcast(state.alias("s")), same & F.expr(inside))
        return joined.select(*[F.col(f"s.{k}").alias(k) for k in keys], "rank", "a", "b", "value", "n")

    for _ in range(MAX_ROUNDS):
        if not wanted:
            break
        state = spark.createDataFrame([(*g, r, low, high, below, *cuts[g, r]) for (g, r), (low, high, below, _) in wanted.items()], names)
        tests = (("under_a", "value < a"), ("to_a", "value <= a"), ("under_b", "value < b"), ("to_b", "value <= b"))
        counted = meet(state).groupBy(*keys, "rank", "a", "b").agg(
            *[F.sum(F.when(F.expr(test), F.col("n")).otherwise(0)).alias(name) for name, test in tests]
        )
        for c in small_rows(counted, "ranks of quantiles"):
            key = (tuple(c[k] for k in keys), c["rank"])
            low, high, below, held_in = wanted.pop(key)
            at = c["rank"] - below
            if c["under_a"] <= at < c["to_a"]:
                found[key] = c["a"]
            elif c["under_b"] <= at < c["to_b"]:
                found[key] = c["b"]
            elif at < c["under_a"]:
                wanted[key] = (low, c["a"], below, c["under_a"])
            elif at < c["under_b"]:
                wanted[key] = (c["a"], c["b"], below + c["to_a"], c["under_b"] - c["to_a"])
            else:
                wanted[key] = (c["b"], high, below + c["to_b"], held_in - c["to_b"])
        if not wanted:
            break
        state = spark.createDataFrame([(*g, r, low, high, below, None, None) for (g, r), (low, high, below, _) in wanted.items()], names)
        left = meet(state)
        if sum(n for *_, n in wanted.values()) <= FEW:
            # a bounded number of values is left around all ranks
            each: dict[tuple, list] = {}
            for c in left.groupBy(*keys, "rank", "value").agg(F.sum("n").alias("n")).collect():
                each.setdefault((tuple(c[k] for k in keys), c["rank"]), []).append((c["value"], c["n"]))
            for key, (_, _, below, _) in list(wanted.items()):
                for value, n in sorted(each[key]):
                    below += n
                    if key[1] < below:
                        found[key] = value
                        wanted.pop(key)
                        break
            break
        cuts = {}
        for c in small_rows(left.groupBy(*keys, "rank").agg(held, pivots), "ranks of quantiles", MAX_SMALL_ROWS // PIVOTS):
            key = (tuple(c[k] for k in keys), c["rank"])
            cuts[key] = _around(list(c["pivot"]), c["rank"] - wanted[key][2], c["held"])
    if wanted:
        raise DataError("values that are no numbers in order have no quantiles")
    out = []
    for g, total in totals.items():
        q = []
        for f in fractions:
            place = f * (total - 1)
            low, high = found[g, math.floor(place)], found[g, math.ceil(place)]
            q.append(low + (high - low) * (place - math.floor(place)))
        out.append((*g, q))
    return spark.createDataFrame(out, ", ".join([*kinds, "q array<double>"]))


def _around(pivots: list[float], rank: int, held: int) -> tuple[float, float]:
    """Two pivots, one surely below the rank or about there, the other above."""
    place = rank * PIVOTS // held
    return pivots[max(place - 1, 0)], pivots[min(place + 2, PIVOTS)]
