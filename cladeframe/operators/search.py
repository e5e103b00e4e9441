"""Search plan of the all-vs-all step: costs, completeness, throughput.

The plan is a given list of ordered species pairs; nothing here multiplies the
species with themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.specs import pair_cost
from ..runtime import global_rank
from .checks import report_rows, union_reports
from .selection import order_statistics


def proteome_volume(inventory: DataFrame) -> DataFrame:
    """Total bytes, largest file and number of files."""
    zero = F.lit(0).cast("bigint")
    return inventory.agg(
        F.coalesce(F.sum("length"), zero).alias("total_bytes"),
        F.coalesce(F.max("length"), zero).alias("largest_bytes"),
        F.count("*").alias("n_files"),
    )


def pair_costs(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """Planned pairs with the sizes of both proteomes and their exact product.

    A pair whose species has no size keeps null sizes and a null cost.
    """
    query = sizes.select(F.col("id").alias("qid"), F.col("size_bytes").alias("query_bytes"))
    database = sizes.select(F.col("id").alias("did"), F.col("size_bytes").alias("db_bytes"))
    joined = pairs.join(query, "qid", "left").join(database, "did", "left")
    return joined.withColumn("cost", pair_cost("query_bytes", "db_bytes"))


def missing_pairs(ids: DataFrame, results: DataFrame) -> DataFrame:
    """Ordered pairs ``qid, did`` (self included) without a non-empty result.

    Every species gets its position among all; the results present for a query
    leave gaps between positions, and only the gaps are expanded, so the work is
    that of the results present plus the pairs missing.
    """
    ranked = global_rank(ids.select("id").distinct(), [F.col("id")], "pos")
    n = ranked.count()
    known = (
        results.where("length > 0").select("qid", "did").distinct()
        .join(ranked.select(F.col("id").alias("did"), "pos"), "did")
        .select("qid", "pos")
        .join(ranked.select(F.col("id").alias("qid")), "qid", "left_semi")
    )
    ends = ranked.select(
        F.col("id").alias("qid"),
        F.explode(F.array(F.lit(-1).cast("bigint"), F.lit(n).cast("bigint"))).alias("pos"),
    )
    before = F.lag("pos").over(Window.partitionBy("qid").orderBy("pos"))
    gaps = known.unionByName(ends).select("qid", "pos", before.alias("before"))
    holes = gaps.where("pos - before > 1").select(
        "qid", F.explode(F.sequence(F.col("before") + 1, F.col("pos") - 1)).alias("pos")
    )
    return holes.join(ranked.select("pos", F.col("id").alias("did")), "pos").select("qid", "did")


def completeness(ids: DataFrame, missing: DataFrame) -> DataFrame:
    """``n_expected, n_present, n_missing`` of the search results."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    species = ids.select("id").distinct().select(one.alias("id"), zero.alias("gap"))
    gaps = missing.select(zero.alias("id"), one.alias("gap"))
    counted = species.unionByName(gaps).agg(F.sum("id").alias("n"), F.sum("gap").alias("n_missing"))
    expected = F.col("n") * F.col("n")
    return counted.select(
        expected.alias("n_expected"), (expected - F.col("n_missing")).alias("n_present"), "n_missing"
    )


def pairs_to_tasks(missing: DataFrame, manifest: DataFrame) -> DataFrame:
    """Ids of the tasks whose manifest holds any missing pair."""
    owned = manifest.join(missing.select("qid", "did"), ["qid", "did"], "left_semi")
    return owned.select("task_id").distinct()


def search_plan_check(pairs: DataFrame, ids: DataFrame, databases: DataFrame) -> DataFrame:
    """The plan has every ordered pair once, and each species a database
    (``databases.name`` holds file names)."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    species = ids.select("id").distinct().select(one.alias("id"), zero.alias("pair"))
    plan = pairs.select(zero.alias("id"), one.alias("pair"))
    counted = species.unionByName(plan).agg(F.sum("id").alias("n"), F.sum("pair").alias("planned"))
    square = F.col("n") * F.col("n")
    off = counted.where(square != F.col("planned"))
    expected = ids.select(
        "id", F.concat(F.lit("diamondDBSpecies"), F.col("id"), F.lit(".dmnd")).alias("name")
    ).distinct()
    absent = expected.join(databases.select("name"), "name", "left_anti")
    return union_reports(
        report_rows(off, "ERROR", "incomplete_plan", F.lit("search plan"),
                    F.concat(F.col("planned"), F.lit(" of "), square, F.lit(" searches"))),
        report_rows(absent, "ERROR", "missing_database", F.col("id"), F.col("name")),
    )


def bucket_summary(costed: DataFrame, manifest: DataFrame) -> DataFrame:
    """Cost, commands and largest database per task of a given assignment."""
    return (
        costed.join(manifest.select("task_id", "qid", "did"), ["qid", "did"])
        .groupBy("task_id")
        .agg(
            F.sum("cost").alias("task_cost"),
            F.count("*").alias("n_commands"),
            F.max("db_bytes").alias("largest_db_bytes"),
        )
    )


def busiest_task(summary: DataFrame) -> DataFrame:
    """One row: the largest task cost, its task and the largest database of all."""
    return summary.agg(
        F.max("task_cost").alias("max_task_cost"),
        F.min_by("task_id", F.struct(-F.col("task_cost"), F.col("task_id"))).alias("busiest_task"),
        F.max("largest_db_bytes").alias("largest_db_bytes"),
    )


def throughput(runs: DataFrame, cost: str = "cost", seconds: str = "seconds") -> DataFrame:
    """Total cost over total time, and smallest, median and largest rate of the
    rows that took any time.  Costs are whole numbers and added exactly.

    The median is exact and found by counting below pivots (``order_statistics``), not
    by sorting.
    """
    rate = F.when(F.col(seconds) > 0, F.col(cost).cast("double") / F.col(seconds))
    totals = runs.agg(
        F.count("*").alias("n_runs"),
        F.sum(F.col(cost).cast("decimal(28,0)")).alias("total_cost"),
        F.sum(seconds).alias("total_seconds"),
        F.min(rate).alias("min_rate"),
        F.max(rate).alias("max_rate"),
    )
    rates = runs.select(rate.alias("value"), F.lit(1).cast("bigint").alias("n"))
    medians = order_statistics(rates, [], [0.5]).take(1)
    middle = medians[0]["q"][0] if medians else None
    return totals.select(
        "n_runs", "total_cost", "total_seconds",
        F.try_divide(F.col("total_cost").cast("double"), F.col("total_seconds").cast("double")).alias("aggregate_rate"),
        "min_rate", F.lit(middle).cast("double").alias("median_rate"), "max_rate",
    )
