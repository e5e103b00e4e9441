"""Family x species counts: long ``family_id, species, copies`` and wide matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import DataError, small_rows

DESC, FAMILY = "Desc", "Family ID"

#: Most species a wide table may have (Spark's own pivot limit).
MAX_SPECIES = 10_000


def species_list(counts: DataFrame) -> list[str]:
    """Species in name order, for use as columns."""
    rows = small_rows(counts.select("species").distinct(), "species columns", MAX_SPECIES)
    return sorted(r["species"] for r in rows)


def family_counts(members: DataFrame) -> DataFrame:
    """Copies per family and species from ``family_id, species, …`` member rows."""
    return members.groupBy("family_id", "species").agg(F.count("*").alias("copies"))


def wide_counts(counts: DataFrame, species: list[str], id_name: str = "family_id") -> DataFrame:
    """One column per species in the given order, absent pairs as 0."""
    if not species:
        raise DataError("No species columns")
    grouped = counts.groupBy(F.col("family_id").alias(id_name))
    return grouped.pivot("species", species).agg(F.sum("copies")).na.fill(0, species)


def long_counts(wide: DataFrame, species: list[str], id_name: str = "family_id") -> DataFrame:
    """Back to one row per family and species."""
    cells = [F.col(f"`{s}`") for s in species]
    return wide.unpivot([F.col(f"`{id_name}`")], cells, "species", "copies").withColumnRenamed(
        id_name, "family_id"
    )


def gene_counts(members: DataFrame, species: list[str]) -> DataFrame:
    """Wide counts with the row sum in ``Total``."""
    wide = wide_counts(family_counts(members), species)
    cells = F.array(*[F.col(f"`{s}`") for s in species])
    total = F.aggregate(cells, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    return wide.withColumn("Total", total)


def count_matrix(counts: DataFrame, species: list[str], desc: str = "(null)") -> DataFrame:
    """The turnover tool's input layout: ``Desc, Family ID, <species…>``."""
    wide = wide_counts(counts, species, FAMILY)
    return wide.select(F.lit(desc).alias(DESC), f"`{FAMILY}`", *[f"`{s}`" for s in species])


def flag_large(matrix: DataFrame, species: list[str], max_family_size: int) -> DataFrame:
    """Mark families in which any species has ``max_family_size`` copies or more."""
    cells = [F.col(f"`{s}`") for s in species]
    largest = F.greatest(*cells) if len(cells) > 1 else cells[0]
    return matrix.withColumn("is_large", largest >= F.lit(max_family_size))


def split_large(
    matrix: DataFrame, species: list[str], max_family_size: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(kept, excluded)``; without a limit nothing is excluded."""
    if max_family_size is None:
        return matrix, matrix.limit(0)
    flagged = flag_large(matrix, species, max_family_size)
    return (
        flagged.where("not is_large").drop("is_large"),
        flagged.where("is_large").drop("is_large"),
    )


def single_copy(counts: DataFrame, n_species: int) -> DataFrame:
    """Families with exactly one gene in every one of ``n_species`` species."""
    present = counts.where("copies > 0").groupBy("family_id").agg(
        F.min("copies").alias("least"), F.max("copies").alias("most"), F.count("*").alias("n")
    )
    return present.where(
        (F.col("least") == 1) & (F.col("most") == 1) & (F.col("n") == n_species)
    ).select("family_id")
