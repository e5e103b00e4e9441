"""FASTA scan and sink.

The scan is a data source of its own (``fasta_source``): one plan over all files, cut into
byte ranges at records, bzip2 files between blocks; formats are told by content.  The
sink writes named files that appear only when all tasks have succeeded.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.headers import accession, species_from_path
from ..runtime import require_none
from .fasta_source import SPLIT_BYTES, register
from .files import FASTA_FILE_ANY, fasta_inventory

#: Line width of written sequences (fixed value).
LINE_WIDTH = 60

RECORD_COLUMNS = ["species", "file", "ord", "header", "accession", "sequence", "length"]

#: Names of written files by compression.
SUFFIX = {None: ".fa", "gzip": ".fa.gz", "bzip2": ".fa.bz2"}


def scan_fasta(spark: SparkSession, paths: list[str], pattern: str = "", split_bytes: int = SPLIT_BYTES, recursive: bool = False) -> DataFrame:
    """``path, file_idx, block, seq, header, sequence`` of all records of the files, and of
    those files of folders whose names match ``pattern``."""
    register(spark)
    return (
        spark.read.format("cladeframe_fasta")
        .option("paths", json.dumps(list(paths)))
        .option("pattern", pattern)
        .option("splitBytes", str(split_bytes))
        .option("recursive", str(recursive).lower())
        .load()
    )


def _records(scan: DataFrame, species: Column) -> DataFrame:
    file_name = F.regexp_extract("path", r"([^/]*)$", 1)
    return scan.select(
        species.alias("species"),
        file_name.alias("file"),
        F.struct("file_idx", file_name.alias("file"), "block", "seq").alias("ord"),
        "header",
        accession("header").alias("accession"),
        "sequence",
        F.length("sequence").alias("length"),
    )


def read_fasta(spark: SparkSession, path, species: str | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of one FASTA file, of a folder of them, or of a list of files.

    A list is one species whose files follow each other in the given order
    (``species`` names it).  Plain, gzip and bzip2 files are recognised by their
    first bytes, whatever their name.  Text before the first record of a file
    is dropped.  Files are cut into ranges of ``split_bytes``.
    """
    if isinstance(path, (list, tuple)) and species is None:
        raise ValueError("a list of files needs the species they belong to")
    name = F.lit(species) if species is not None else species_from_path("path")
    paths = path if isinstance(path, (list, tuple)) else [path]
    return _records(scan_fasta(spark, paths, split_bytes=split_bytes), name)


def read_fasta_directory(spark: SparkSession, directory: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Every FASTA file directly in ``directory``; each one is a species."""
    names = fasta_inventory(spark, directory)
    clash = names.groupBy("species").count().where("count > 1")
    require_none(clash, "Several FASTA files for one species", "species")
    if names.isEmpty():
        raise FileNotFoundError(
            f"No FASTA files found in {directory}; expected names like {FASTA_FILE_ANY}"
        )
    # Python has the flag for the whole pattern only
    pattern = "(?i)" + FASTA_FILE_ANY.replace("(?i:", "(?:")
    return _records(scan_fasta(spark, [directory], pattern, split_bytes), species_from_path("path"))


def read_fasta_sink(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records that ``write_fasta`` has written by species; ``ord`` is their order there."""
    scan = scan_fasta(spark, [path], split_bytes=split_bytes, recursive=True)
    species = F.regexp_extract("path", r"/species=([^/]*)/", 1)
    return _records(scan, species)


def fasta_text(header="header", sequence="sequence") -> Column:
    """One record as FASTA text with wrapped sequence lines."""
    wrapped = F.regexp_replace(sequence, "(.{%d})(?=.)" % LINE_WIDTH, "$1\n")
    return F.concat(F.lit(">"), F.col(header), F.lit("\n"), wrapped)


def write_lines(rows: DataFrame, path: str, exact: bool = False, compression: str | None = None, suffix: str = "") -> None:
    """Write rows ``file, value``, sorted by file in each partition, as lines of files below
    the new folder ``path``.  ``exact``: one file of that name, which only one partition may
    have; otherwise a folder of that name with a part file for each partition.  Nothing
    is there to see until all is written, and nothing of a run that fails."""
    spark = rows.sparkSession
    register(spark)
    writer = rows.select(F.col("file").cast("string"), F.col("value").cast("string")).write.format("cladeframe_lines")
    writer.mode("append").options(
        path=path, naming="exact" if exact else "parts", compression=compression or "", suffix=suffix
    ).save()


def write_fasta(
    kept: DataFrame, path: str, one_file: bool = False, compression: str | None = None
) -> None:
    """Genes by gene id, then records without one in input order, for each species.

    A species is the folder ``species=<name>`` of part files that hold the records in
    that order in the order of their names, so that a large species is spread over several
    tasks; or, with ``one_file``, the file ``<name>.fa``, written by one task as its
    records come.  ``compression`` is ``gzip`` or ``bzip2``.
    """
    order = ["species", "sort_rank", "gene_id", "ord"]
    rows = kept.select(*order, fasta_text().alias("value"))
    rows = rows.repartition("species") if one_file else rows.repartitionByRange(*order)
    name = F.col("species") if one_file else F.concat(F.lit("species="), F.col("species"))
    lines = rows.sortWithinPartitions(*order).select(name.alias("file"), "value")
    write_lines(lines, path, exact=one_file, compression=compression, suffix=SUFFIX[compression])
