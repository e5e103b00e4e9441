"""Text artefacts of the search, dating and turnover steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import DataError, require_none
from .files import file_inventory
from .lines import numbered_lines

# What marks a real search command, and the tokens that carry
# its species pair.
COMMAND = (
    r"^\s*(diamond\s+(blastp|makedb)\s+-|blastp\s+-|makeblastdb\s+-)"
)
RESULT_PAIR = r"Blast(\d+)_(\d+)"
QUERY_FILE = r"(?<![A-Za-z])Species(\d+)\.fa"
DATABASE = r"diamondDBSpecies(\d+)"
SPECIES_LINE = r"^\s*(\d+):\s*(.*?)\s*$"


def _int(text: Column) -> Column:
    return F.nullif(text, F.lit("")).cast("int")


def parse_species_ids(lines: DataFrame) -> DataFrame:
    """``id, filename`` from ``value`` lines; commented-out species do not match."""
    rows = lines.select(
        _int(F.regexp_extract("value", SPECIES_LINE, 1)).alias("id"),
        F.regexp_extract("value", SPECIES_LINE, 2).alias("filename"),
    )
    return rows.where("id is not null")


def read_species_ids(spark: SparkSession, path) -> DataFrame:
    ids = parse_species_ids(spark.read.text(path))
    if ids.isEmpty():
        raise DataError(f"No active species in {path}")
    return ids


def parse_search_pairs(lines: DataFrame) -> DataFrame:
    """``qid, did, error`` of every search command among the ``value`` lines.

    The result name decides; the query and database tokens are cross-checked,
    or stand in for it when it is absent.
    """
    value = F.col("value")
    tokens = lines.where(value.rlike(COMMAND) & ~value.rlike(r"makedb|makeblastdb")).select(
        "*",
        _int(F.regexp_extract(value, RESULT_PAIR, 1)).alias("i"),
        _int(F.regexp_extract(value, RESULT_PAIR, 2)).alias("j"),
        _int(F.regexp_extract(value, QUERY_FILE, 1)).alias("q"),
        _int(F.regexp_extract(value, DATABASE, 1)).alias("d"),
    )
    error = (
        F.when(F.col("i").isNull() & (F.col("q").isNull() | F.col("d").isNull()),
               F.lit("no species pair"))
        .when(F.col("q") != F.col("i"), F.lit("query token disagrees"))
        .when(F.col("d") != F.col("j"), F.lit("database token disagrees"))
    )
    return tokens.select(
        "*", F.coalesce("i", "q").alias("qid"), F.coalesce("j", "d").alias("did"),
        error.alias("error"),
    ).drop("i", "j", "q", "d")


def read_search_pairs(spark: SparkSession, path, in_parts: bool = False) -> DataFrame:
    """``line_index, qid, did, error, value``; ``line_index`` is the position of the line in
    its file, from 0.  ``in_parts``: the file is a folder of part files."""
    lines = numbered_lines(spark, path, in_parts).withColumn("line_index", F.col("line") - 1)
    return parse_search_pairs(lines).select("line_index", "qid", "did", "error", "value")


def read_task_manifests(spark: SparkSession, path) -> DataFrame:
    """``task_id, qid, did`` from the command lists of the search tasks."""
    lines = spark.read.text(path).select(
        "value",
        _int(F.regexp_extract("_metadata.file_name", r"search_task_(\d+)\.txt$", 1)).alias("task_id"),
    )
    pairs = parse_search_pairs(lines.where("task_id is not null"))
    return pairs.where("error is null").select("task_id", "qid", "did")


def read_result_inventory(spark: SparkSession, directory: str) -> DataFrame:
    """``qid, did, length`` of the search result files in a folder."""
    pattern = r"^Blast(\d+)_(\d+)\.txt\.gz$"
    return (
        file_inventory(spark, directory)
        .select(
            _int(F.regexp_extract("name", pattern, 1)).alias("qid"),
            _int(F.regexp_extract("name", pattern, 2)).alias("did"),
            "length",
        )
        .where("qid is not null")
    )




def last_dated_trees(lines: DataFrame) -> DataFrame:
    """``file, newick``: the last ``tree … = [&R] …;`` line of every log, from
    ``file, ord, value`` rows, with the rooting tag removed."""
    pattern = r"(?i)^\s*tree\s+\S+\s*=\s*(?:\[&[RU]\]\s*)?(.*;)\s*$"
    trees = lines.where(F.col("value").rlike(pattern)).groupBy("file").agg(
        F.max_by("value", "ord").alias("value")
    )
    return trees.select("file", F.regexp_extract("value", pattern, 1).alias("newick"))


def read_dated_trees(spark: SparkSession, path) -> DataFrame:
    """The dated tree of every solver log; a log without one is an error."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
        ).alias("ord"),
        "value",
    )
    trees = last_dated_trees(lines)
    names = file_inventory(spark, path).select(F.col("name").alias("file"))
    require_none(names.join(trees, "file", "left_anti"), "Could not find a tree in", "file")
    return trees


#: Cells of the turnover tables that stand for no value.
NO_VALUE = ["", "-", "N/A", "NA", "nan"]


def _number(column: str, kind: str) -> Column:
    """A cell as a number, a sign before it allowed; other text than a number fails."""
    cell = F.trim(F.col(column))
    number = F.regexp_replace(cell, r"^\+", "").try_cast(kind)
    bad = F.raise_error(F.concat(F.lit(f"{column} is no number: "), cell)).cast(kind)
    return F.when(cell.isNull() | cell.isin(NO_VALUE), F.lit(None).cast(kind)).otherwise(F.coalesce(number, bad))


def _runs(spark: SparkSession, directory: str, suffix: str) -> DataFrame:
    """``run, family_id, column, cell`` of all tables whose names end in ``suffix``, from
    one scan; ``run`` is the rest of the name.  A table's first line has its columns; one
    without a name, after a closing tab, holds nothing."""
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    lines = spark.read.option("pathGlobFilter", f"*{suffix}").text(directory).select(
        F.left(name, F.length(name) - len(suffix)).alias("run"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq")).alias("at"),
        F.split(F.regexp_replace("value", r"\r$", ""), "\t").alias("cells"),
    )
    heads = lines.groupBy("run").agg(F.min(F.struct("at", "cells")).alias("head"))
    placed = lines.join(heads, "run").where(F.col("at") != F.col("head.at"))
    cells = placed.where(F.col("cells")[0] != "").select(
        "run", F.col("cells")[0].alias("family_id"), F.posexplode(F.col("head.cells")).alias("place", "column"), "cells"
    )
    return cells.where("place > 0 and trim(column) <> ''").select(
        "run", "family_id", "place", "column", F.get("cells", F.col("place")).alias("cell")
    )


def read_turnover(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """Output tables of the turnover step: ``counts`` (family_id, node, copies),
    ``changes`` (family_id, branch, change), ``pvalues`` (family_id, pvalue) and
    ``branch_probabilities`` (family_id, branch, probability), as far as present.

    Every matching file is read, in one scan a table; ``run`` is its name up to the
    table's suffix.  A cell that is neither a number nor one of ``NO_VALUE`` fails.
    """
    name = F.col("name")
    kinds = {
        "_count.tab": ("counts", "node", "copies", "bigint"),
        "_change.tab": ("changes", "branch", "change", "bigint"),
        "_branch_probabilities.tab": ("branch_probabilities", "branch", "probability", "double"),
        "_family_results.txt": ("pvalues", None, "pvalue", "double"),
    }
    seen = file_inventory(spark, directory).agg(
        F.count_if(name.endswith("_results.txt")).alias("results"),
        *[F.count_if(name.endswith(suffix)).alias(suffix) for suffix in kinds],
    ).first()
    if not seen["results"]:
        raise DataError(f"No *_results.txt in {directory}")
    out = {}
    for suffix, (table, key, value, kind) in kinds.items():
        if not seen[suffix]:
            continue
        cells = _runs(spark, directory, suffix).withColumnRenamed("cell", value)
        if key is None:
            cells = cells.where("place = 1").select("family_id", value, "run")
        else:
            cells = cells.select("family_id", F.col("column").alias(key), value, "run")
        out[table] = cells.withColumn(value, _number(value, kind))
    return out
