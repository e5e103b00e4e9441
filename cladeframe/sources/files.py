"""File inventories, from the metadata of Spark's ``binaryFile`` source, and manifests."""

from __future__ import annotations

import json
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.headers import species_from_path
from ..runtime import DataError

FASTA_FILE = r"(?i)\.(fa|fasta|faa)$"
FASTA_FILE_ANY = r"(?i:\.(fa|fasta|faa))(\.(gz|bz2))?$"


def file_inventory(spark: SparkSession, path, recursive: bool = False) -> DataFrame:
    """``path, name, length, modified_time`` of every file below ``path``.

    Spark's scans leave out files of 0 bytes; these come from its file listing,
    with length 0 and no time.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path)
    seen = files.select("path", "length", F.col("modificationTime").alias("modified_time"))
    listed = [(_plain_path(p),) for p in files.inputFiles()]
    empty = spark.createDataFrame(listed, "path string").join(seen, "path", "left_anti").select(
        "path", F.lit(0).cast("bigint").alias("length"),
        F.lit(None).cast("timestamp").alias("modified_time"),
    )
    return seen.unionByName(empty).select(
        "path", F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), "length", "modified_time"
    )


def _plain_path(uri: str) -> str:
    """A listed URI as the ``path`` column of a scan shows it."""
    text = unquote(uri)
    return "file:" + text[len("file://"):] if text.startswith("file:///") else text


def fasta_inventory(spark: SparkSession, directory: str) -> DataFrame:
    """FASTA files directly in ``directory``, plain or compressed, by name."""
    found = file_inventory(spark, directory).where(F.col("name").rlike(FASTA_FILE_ANY))
    return found.withColumn("species", species_from_path("path")).orderBy("path")


def proteome_sizes(spark: SparkSession, directory: str) -> DataFrame:
    """``id, size_bytes`` of the numbered proteomes ``Species<id>.fa``."""
    number = F.regexp_extract("name", r"^Species(\d+)\.fa$", 1)
    return (
        file_inventory(spark, directory)
        .select(number.alias("id"), F.col("length").alias("size_bytes"))
        .where("id <> ''")
        .withColumn("id", F.col("id").cast("int"))
    )


def latest_results(spark: SparkSession, root: str) -> str:
    """Newest ``Results_*`` folder below ``root``, nested layouts included.

    The age of a folder is that of its newest file.  A deeper results folder
    inside an outer one is a run of its own.
    """
    folder = F.regexp_extract("path", r"^(.*/Results_[^/]*)/", 1)
    newest = (
        file_inventory(spark, root, recursive=True)
        .select(folder.alias("folder"), "modified_time")
        .where("folder <> ''")
        .groupBy("folder")
        .agg(F.max("modified_time").alias("t"))
        .agg(F.max_by("folder", F.struct("t", "folder")).alias("folder"))
        .first()
    )
    if newest is None or newest["folder"] is None:
        raise DataError(f"No Results_* folder with files below {root}")
    return newest["folder"]


def _digests(spark: SparkSession, paths, **options: str) -> DataFrame:
    from .fasta_source import register

    register(spark)
    listed = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.format("cladeframe_digests").options(paths=json.dumps(listed), **options).load()


def file_manifest(spark: SparkSession, paths) -> DataFrame:
    """``path, md5, size_bytes, modified_time`` of the given files or folders; a file is
    read by one task in steps and never held."""
    return _digests(spark, paths).select("path", "md5", "size_bytes", "modified_time")


def tree_manifest(spark: SparkSession, paths, chunk_bytes: int = 64 << 20) -> DataFrame:
    """``path, tree_md5, n_chunks, size_bytes`` of the given files or folders: the MD5 of
    the MD5 sums (lower-case hex, in order) of their chunks, which all tasks read."""
    chunks = _digests(spark, paths, chunkBytes=str(chunk_bytes))
    held = F.sort_array(F.collect_list(F.struct("chunk", "md5")))
    return chunks.groupBy("path", "size_bytes").agg(
        F.md5(F.array_join(held["md5"], "")).alias("tree_md5"), F.count("*").alias("n_chunks")
    ).select("path", "tree_md5", "n_chunks", "size_bytes")


def file_heads(spark: SparkSession, paths) -> DataFrame:
    """``path, name, head, size_bytes``: the first bytes of files as hex, nothing else of
    them being read; empty files are left out."""
    return _digests(spark, paths, headOnly="true").select("path", "name", "head", "size_bytes")


__all__ = [
    "FASTA_FILE", "FASTA_FILE_ANY", "fasta_inventory", "file_heads", "file_inventory",
    "file_manifest", "latest_results", "proteome_sizes", "tree_manifest",
]
