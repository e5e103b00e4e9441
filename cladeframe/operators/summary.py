"""Summaries of family turnover and its association with a trait."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import DataError
from .selection import order_statistics


def significant_families(pvalues: DataFrame, threshold: float = 0.05) -> DataFrame:
    return pvalues.where(F.col("pvalue") < threshold)


def turnover_by_branch(changes: DataFrame) -> DataFrame:
    """Expansions and contractions per branch from ``family_id, branch, change``."""
    change = F.col("change")
    return changes.groupBy("branch").agg(
        F.count_if(change > 0).alias("n_expanded"),
        F.count_if(change < 0).alias("n_contracted"),
        F.coalesce(F.sum(F.when(change > 0, change)), F.lit(0)).alias("genes_gained"),
        F.coalesce(F.sum(F.when(change < 0, -change)), F.lit(0)).alias("genes_lost"),
    )


def branch_transitions(class_edges: DataFrame) -> DataFrame:
    """``tree_id, node_id, transition``: whether a branch changes class."""
    above = class_edges.select(
        "tree_id", F.col("node_id").alias("parent_id"), F.col("class").alias("above")
    )
    return class_edges.join(above, ["tree_id", "parent_id"]).select(
        "tree_id", "node_id", (F.col("class") != F.col("above")).alias("transition")
    )


def transition_overlap(branch_turnover: DataFrame, transitions: DataFrame,
                       high: int) -> DataFrame:
    """2 x 2 counts of branches: changed genes at or above ``high`` against class
    transitions.  Inputs are keyed by ``branch``."""
    total = F.col("genes_gained") + F.col("genes_lost")
    both = transitions.join(branch_turnover, "branch", "left").select(
        "transition", (F.coalesce(total, F.lit(0)) >= high).alias("high")
    )
    t, h = F.col("transition"), F.col("high")
    return both.agg(
        F.count_if(t & h).alias("transition_high"),
        F.count_if(t & ~h).alias("transition_low"),
        F.count_if(~t & h).alias("stable_high"),
        F.count_if(~t & ~h).alias("stable_low"),
    )


def family_dynamics(counts: DataFrame, changes: DataFrame | None = None) -> DataFrame:
    """Smallest, largest and mean size per family, and with ``changes`` the total
    gain and loss over all branches."""
    sizes = counts.groupBy("family_id").agg(
        F.min("copies").alias("min_copies"),
        F.max("copies").alias("max_copies"),
        F.avg("copies").alias("mean_copies"),
    )
    if changes is None:
        return sizes
    change = F.col("change")
    moved = changes.groupBy("family_id").agg(
        F.sum(F.greatest(change, F.lit(0))).alias("total_gain"),
        F.sum(F.greatest(-change, F.lit(0))).alias("total_loss"),
    )
    return sizes.join(moved, "family_id", "left").na.fill(0, ["total_gain", "total_loss"])


def merge_family_results(counts: DataFrame, pvalues: DataFrame) -> DataFrame:
    """Counts with the p-value of their family, null where there is none."""
    return counts.join(pvalues.select("family_id", "pvalue"), "family_id", "left")


def add_phenotype(counts: DataFrame, phenotypes: DataFrame) -> DataFrame:
    return counts.join(phenotypes.select("species", "phenotype"), "species", "left")


def mean_copies_by_phenotype(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("family_id", "phenotype").agg(
        F.avg("copies").alias("mean_copies"), F.count("*").alias("n_species")
    )


def associate(labelled: DataFrame) -> DataFrame:
    """Per family and phenotype class: correlation of copy number with belonging
    to the class, and the difference of means.  Species share ancestry, so this
    is a description and no test.

    Class sums come first; the rest of a family is its total minus the class.
    """
    x = F.col("copies").cast("double")
    cells = labelled.where("phenotype is not null").groupBy("family_id", "phenotype").agg(
        F.count("*").cast("double").alias("n1"),
        F.sum(x).alias("s1"),
        F.sum(x * x).alias("q1"),
    )
    totals = cells.groupBy("family_id").agg(
        F.sum("n1").alias("n"), F.sum("s1").alias("s"), F.sum("q1").alias("q")
    )
    both = cells.join(totals, "family_id").where("n1 < n")
    return both.selectExpr(
        "family_id", "phenotype",
        "s1 / n1 - (s - s1) / (n - n1) as mean_difference",
        """case when n * q - s * s > 0 then
             (n * s1 - s * n1) / sqrt((n * q - s * s) * (n * n1 - n1 * n1)) end as correlation""",
    )


def heatmap_table(counts: DataFrame, species_order: list[str]) -> DataFrame:
    """Family x species copy numbers, species in the given order."""
    from .counts import wide_counts

    return wide_counts(counts, species_order)


def size_histogram(counts: DataFrame, low: float, high: float, bins: int) -> DataFrame:
    """Families per size class; ``bin`` 0 and ``bins + 1`` lie outside."""
    if bins < 1:
        raise DataError("bins must be at least 1")
    sizes = counts.groupBy("family_id").agg(F.sum("copies").alias("size"))
    place = F.expr(f"width_bucket(cast(size as double), {float(low)}d, {float(high)}d, {bins})")
    return sizes.groupBy(place.alias("bin")).agg(F.count("*").alias("n_families"))


def tree_turnover_table(class_edges: DataFrame, branch_turnover: DataFrame) -> DataFrame:
    """Edges with the turnover of their branch, for colouring a tree."""
    return class_edges.join(
        branch_turnover.withColumnRenamed("branch", "label"), "label", "left"
    ).na.fill(0, ["n_expanded", "n_contracted", "genes_gained", "genes_lost"])


def phenotype_quantiles(labelled: DataFrame) -> DataFrame:
    """Box-plot numbers of copy number per phenotype, exact: equal copy numbers are counted
    first, ranks are found by counting below pivots (``order_statistics``)."""
    values = labelled.where("phenotype is not null").groupBy("phenotype", F.col("copies").alias("value")).agg(
        F.count("*").alias("n")
    )
    return order_statistics(values, ["phenotype"], [0.0, 0.25, 0.5, 0.75, 1.0]).select(
        "phenotype",
        *[F.get("q", F.lit(i)).alias(name)
          for i, name in enumerate(["low", "q1", "median", "q3", "high"])],
    )


def turnover_by_phenotype(labelled: DataFrame) -> DataFrame:
    """Copies, mean copies and present families per phenotype over all families."""
    return labelled.where("phenotype is not null").groupBy("phenotype").agg(
        F.sum("copies").alias("total_copies"),
        F.avg("copies").alias("mean_copies"),
        F.count_if(F.col("copies") > 0).alias("n_present"),
    )
