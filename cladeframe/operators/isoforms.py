"""Longest isoform per gene, for any number of species in one job.

Records carry ``species, ord, header, accession, sequence, length``; ``ord``
orders the records of a species.  Duplicates and isoforms are reduced with
aggregates (combined map-side, so a hot accession or gene never gathers in one
task) on narrow columns; sequences are fetched for the winners only.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import headers as H
from ..runtime import require_none

ON_DUPLICATE = ("error", "warn", "skip")


def _check_policy(on_duplicate: str) -> None:
    if on_duplicate not in ON_DUPLICATE:
        raise ValueError(f"on_duplicate must be one of {ON_DUPLICATE}, got {on_duplicate!r}")


def duplicate_accessions(df: DataFrame, keys=("species", "accession")) -> DataFrame:
    """Keys that occur more than once, with their number of records."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_records")).where("n_records > 1")


def dedup_accessions(
    df: DataFrame,
    on_duplicate: str = "error",
    keys=("species", "accession"),
    ord_col: str = "ord",
) -> DataFrame:
    """Keep the first record of every accession."""
    _check_policy(on_duplicate)
    duplicated = duplicate_accessions(df, keys)
    if on_duplicate == "error":
        require_none(duplicated, "Duplicate accession", keys[-1])
        return df
    if on_duplicate == "warn":
        for row in duplicated.take(10):
            warnings.warn(f"Duplicate accession {row[keys[-1]]!r}", stacklevel=2)
    first = df.groupBy(*keys).agg(F.min(ord_col).alias(ord_col))
    return df.join(first, [*keys, ord_col], "left_semi")


def detected_formats(df: DataFrame) -> DataFrame:
    """Header format of each species, judged once from its first record."""
    first = df.groupBy("species").agg(F.min_by("header", "ord").alias("header"))
    return first.select("species", H.header_format("header").alias("detected_format"))


def _with_format(narrow: DataFrame, fmt: str) -> DataFrame:
    if fmt not in H.FORMATS:
        raise ValueError(f"Unknown header format: {fmt!r}")
    if fmt == "auto":
        # one row per species; the join strategy is left to the size the
        # aggregate turns out to have at run time
        return narrow.join(detected_formats(narrow), "species")
    return narrow.withColumn("detected_format", F.lit(fmt))


def _gene_column(fmt: str) -> Column:
    if fmt == "auto":
        return H.gene_id("header", F.col("detected_format"))
    return H.gene_id("header", fmt)


def _check_headers(df: DataFrame) -> DataFrame:
    """Fail the job on a record whose header is blank."""
    blank = F.coalesce(F.col("accession"), F.lit("")) == ""
    where = F.concat(F.lit("blank FASTA header in "), F.col("species"),
                     F.lit(" at record "), F.col("ord").cast("string"))
    return df.withColumn(
        "accession", F.when(blank, F.raise_error(where)).otherwise(F.col("accession"))
    )


def gene_records(records: DataFrame, fmt="auto", on_duplicate="error") -> DataFrame:
    """Narrow rows ``species, accession, ord, length, detected_format, gene_id``
    of the first record per accession."""
    _check_policy(on_duplicate)
    narrow = _check_headers(records.select("species", "accession", "ord", "header", "length"))
    typed = _with_format(narrow, fmt).select(
        "species", "accession", "ord", "length", "detected_format",
        _gene_column(fmt).alias("gene_id"),
    )
    if on_duplicate == "error":
        return dedup_accessions(typed, "error")
    if on_duplicate == "warn":
        for row in duplicate_accessions(typed).take(10):
            warnings.warn(f"Duplicate accession {row['accession']!r}", stacklevel=2)
    kept = F.struct("ord", "length", "detected_format", "gene_id")
    first = typed.groupBy("species", "accession").agg(F.min(kept).alias("r"))
    return first.select("species", "accession", "r.*")


def longest_winners(genes: DataFrame) -> DataFrame:
    """``species, gene_id, ord`` of the longest record per gene (the first on
    ties) and of every record without a gene id."""
    lone = F.when(F.col("gene_id").isNull(), F.col("ord"))
    best = F.min(F.struct((-F.col("length")).alias("neg_length"), F.col("ord"))).alias("best")
    return (
        genes.groupBy("species", "gene_id", lone.alias("lone"))
        .agg(best)
        .select("species", "gene_id", F.col("best.ord").alias("ord"))
    )


def longest_isoform(records: DataFrame, fmt="auto", on_duplicate="error") -> DataFrame:
    """The kept records with their ``gene_id``; ``sort_rank`` is 0 for genes and
    1 for records without one, which are kept unchanged."""
    winners = longest_winners(gene_records(records, fmt, on_duplicate))
    kept = records.join(winners, ["species", "ord"])
    return kept.withColumn(
        "sort_rank", F.when(F.col("gene_id").isNull(), F.lit(1)).otherwise(F.lit(0))
    )


def filter_stats(records: DataFrame, fmt="auto", on_duplicate="error") -> DataFrame:
    """Per-species statistics; ``total_records`` counts dropped duplicates too."""
    genes = gene_records(records, fmt, on_duplicate)
    per_gene = genes.groupBy("species", "detected_format", "gene_id").agg(
        F.count("*").alias("n")
    )
    unknown = F.col("gene_id").isNull()
    summary = per_gene.groupBy("species", "detected_format").agg(
        F.count("gene_id").alias("unique_genes"),
        F.coalesce(F.sum(F.when(unknown, F.col("n"))), F.lit(0)).alias("unidentified"),
    )
    totals = records.groupBy("species").agg(F.count("*").alias("total_records"))
    return totals.join(summary, "species", "left").select(
        "species",
        "total_records",
        "unique_genes",
        "unidentified",
        (F.col("unique_genes") + F.col("unidentified")).alias("output_records"),
        "detected_format",
    )
