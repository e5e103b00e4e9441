"""Trait labels of species and their classes on a tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import DataError, require_none, small_rows
from .trees import prune


def phenotype_conflicts(phenotypes: DataFrame) -> DataFrame:
    """Species with more than one distinct label."""
    return (
        phenotypes.where("phenotype is not null")
        .groupBy("species", "phenotype")
        .agg(F.count("*").alias("n"))
        .groupBy("species")
        .agg(F.count("*").alias("n_labels"))
        .where("n_labels > 1")
    )


def resolve_phenotypes(phenotypes: DataFrame) -> DataFrame:
    """One row per species; agreeing duplicates merge, a label beats a missing
    one, and conflicting labels are an error."""
    require_none(
        phenotype_conflicts(phenotypes), "Species with conflicting phenotype labels", "species"
    )
    return phenotypes.groupBy("species").agg(F.max("phenotype").alias("phenotype"))


def phenotype_coverage(species: DataFrame, phenotypes: DataFrame) -> DataFrame:
    """One row: species with a label, without one, and labelled rows not among
    the species."""
    left = species.select("species").distinct().withColumn("in_set", F.lit(True))
    right = phenotypes.groupBy("species").agg(F.max("phenotype").alias("phenotype"))
    both = left.join(right.withColumn("in_table", F.lit(True)), "species", "full_outer")
    labelled = F.col("phenotype").isNotNull()
    return both.agg(
        F.count_if(F.col("in_set") & labelled).alias("n_covered"),
        F.count_if(F.col("in_set") & ~labelled).alias("n_missing"),
        F.count_if(F.col("in_set").isNull() & F.col("in_table")).alias("n_extra"),
    )


def apply_unclassified(
    edges: DataFrame,
    phenotypes: DataFrame,
    policy: str = "background",
    label: str = "background",
    matrix: DataFrame | None = None,
):
    """Complete the labels of every tip.

    ``'background'`` gives unlabelled tips the class ``label``; ``'drop'``
    removes them from the tree and from the count matrix (species columns).
    Returns ``(edges, tip_labels, matrix)``; ``tip_labels`` has ``tree_id,
    node_id, species, phenotype``.
    """
    if policy not in ("background", "drop"):
        raise ValueError(f"unclassified must be 'background' or 'drop', got {policy!r}")
    tips = edges.where("is_tip").select("tree_id", "node_id", F.col("label").alias("species"))
    labelled = tips.join(phenotypes.select("species", "phenotype"), "species", "left").select(
        "tree_id", "node_id", "species", "phenotype"
    )
    if policy == "background":
        filled = labelled.withColumn("phenotype", F.coalesce("phenotype", F.lit(label)))
        return edges, filled, matrix
    kept = labelled.where("phenotype is not null")
    pruned = prune(edges, kept.select("tree_id", F.col("species").alias("label")))
    if matrix is not None:
        dropped = labelled.where("phenotype is null").select("species").distinct()
        matrix = matrix.drop(*[r["species"] for r in small_rows(dropped, "dropped species")])
    return pruned, kept, matrix


def class_legend(tip_labels: DataFrame) -> DataFrame:
    """``integer, category, n_tips``: codes 1..k by category name.

    The categories are counted first, so the numbering runs over k rows.
    """
    counts = tip_labels.groupBy(F.col("phenotype").alias("category")).agg(
        F.count("*").alias("n_tips")
    )
    code = F.dense_rank().over(Window.orderBy("category"))
    return counts.select(code.cast("int").alias("integer"), "category", "n_tips")


def require_classes(legend: DataFrame) -> int:
    """Number of classes; fewer than two are an error."""
    k = len(small_rows(legend, "phenotype categories"))
    if k < 2:
        raise DataError("Need at least 2 phenotype categories")
    return k


def code_tips(tip_labels: DataFrame, legend: DataFrame) -> DataFrame:
    """Tip labels with their integer ``class``; missing labels are an error."""
    codes = legend.select(F.col("category").alias("phenotype"), F.col("integer").alias("class"))
    coded = tip_labels.join(codes, "phenotype", "left")
    missing = F.raise_error(F.concat(F.lit("Tip without phenotype: "), F.col("species")))
    return coded.withColumn("class", F.when(F.col("class").isNull(), missing).otherwise(F.col("class")))


def forced_classes(edges: DataFrame, tip_classes: DataFrame, anc_class: int) -> DataFrame:
    """Every internal branch gets ``anc_class``; tips keep their own."""
    own = tip_classes.select("tree_id", "node_id", F.col("class").alias("own"))
    joined = edges.join(own, ["tree_id", "node_id"], "left")
    return joined.withColumn(
        "class", F.when(F.col("is_tip"), F.col("own")).otherwise(F.lit(anc_class))
    ).drop("own")


def class_coverage(class_edges: DataFrame, legend: DataFrame) -> DataFrame:
    """Report of classes that no branch carries."""
    used = class_edges.where("parent_id is not null").select(F.col("class").alias("integer"))
    unused = legend.join(used.distinct(), "integer", "left_anti")
    return unused.select(
        F.lit("WARNING").alias("severity"),
        F.lit("unused_class").alias("code"),
        F.col("category").alias("subject"),
        F.concat(F.lit("class "), F.col("integer"), F.lit(" is on no branch")).alias("detail"),
    )
