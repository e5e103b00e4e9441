"""Text lines with their numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import materialize


def numbered_lines(spark: SparkSession, path, in_parts: bool = False) -> DataFrame:
    """``file, line, value``: the lines of files, numbered from 1 in each of them.

    A large file is read in pieces.  Lines are counted inside the pieces, and the counts
    of the pieces before are added, one row a piece.  ``in_parts``: a file is a folder of
    part files, whose lines follow each other in the order of the names.
    """
    name = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    file = F.regexp_extract(name, r"^(.*)/[^/]*$", 1) if in_parts else name
    rows = materialize(spark.read.text(path).select(
        file.alias("file"), name.alias("part"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value",
    ))
    pieces = rows.groupBy("file", "part", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("file").orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("file", "part", "block", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return rows.join(pieces, ["file", "part", "block"]).select(
        "file", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line"), "value"
    )
