"""Mixing sources to target weights by a time-varying curriculum.

Each source has a share of the training stream at every time from 0 to 1: a line
between knots.  Integrating the share gives the source's cumulative token demand;
inverting that at a document's offset in its source's own stream gives the time at
which the document is due, and so its training position.  Documents are then sorted by
position in ranges.

Offsets come from sums per (source, bucket of the document's hash), and in a bucket per
id, size and part of the text's hash: a hot source is spread over all buckets, a hot or
missing id over sizes and parts, and no task sees a whole source or a whole id.  Everything is a DataFrame
operation.

Defined results: a missing text has size 0; a missing source is a source of its own,
ranked last; sources are a dimension, ranked in one small window.  A source without
words has target 0 and is not taken.  Rows with equal ids are ordered by their size.
An empty table gives an empty plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cladeframe.runtime import materialize

from .text import n_words

#: Hexadecimal digits of the hash that name a bucket: 4096 buckets in each source.
BUCKET_DIGITS = 3
#: Parts of the rows that agree in id and size.
TIES = 256


def source_key(source: Column) -> Column:
    """A key that sorts by code point with the missing source last."""
    return F.when(source.isNull(), F.lit("t")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def fill_targets(sources: DataFrame, factor: float, cap: float) -> DataFrame:
    """Add ``target``: ``factor`` of all sizes shared by ``weight``, each source at
    most ``cap`` times its ``source_size``, the excess shared again by weight.

    With sources in the order of size per weight, those up to the water level are the
    capped ones, so that running sums give the level without rounds.
    """
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "src")
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(everything)
    s = sources.withColumn("level", (factor * total - cap * before) / left)
    most = cap * F.col("source_size")
    s = s.withColumn("capped", most <= F.col("weight") * F.col("level"))
    level = F.max(F.when(~F.col("capped"), F.col("level"))).over(everything)
    return s.withColumn(
        "target", F.when(F.col("capped"), most).otherwise(F.col("weight") * level)
    ).drop("level", "capped")


def tilted_schedule(sources: DataFrame, tilt: float) -> DataFrame:
    """Add ``share0`` and ``share1``, the demand per unit of time at times 0 and 1.

    Sources of odd rank come early, the others late, by up to ``tilt``; the lines
    integrate to ``target`` and add up to the same demand at every time.
    """
    everything = Window.partitionBy()
    odd = F.col("rank") % 2 == 1
    early = F.coalesce(F.sum(F.when(odd, F.col("target"))).over(everything), F.lit(0.0))
    late = F.coalesce(F.sum(F.when(~odd, F.col("target"))).over(everything), F.lit(0.0))
    top = F.greatest(early, late)
    lean = F.when(top > 0, F.when(odd, late).otherwise(-early) * tilt / top).otherwise(F.lit(0.0))
    return sources.select(
        "*",
        (F.col("target") * (1 + lean)).alias("share0"),
        (F.col("target") * (1 - lean)).alias("share1"),
    )


def due(offset: Column) -> Column:
    """The time at which the demand ``share0 t + (share1 - share0) t^2 / 2`` of a
    source reaches ``offset``."""
    first, bend = F.col("share0"), F.col("share1") - F.col("share0")
    root = F.sqrt(F.greatest(first * first + 2 * bend * offset, F.lit(0.0)))
    return F.when(offset <= 0, F.lit(0.0)).otherwise(F.least(2 * offset / (first + root), F.lit(1.0)))


def plan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    factor: float = 1.5,
    cap: float = 2.0,
    tilt: float = 0.5,
    row: str | None = None,
) -> DataFrame:
    """One row per document: its size, its source's size and target, and the training
    positions (in words of the whole stream) of the copies that the mix takes.  ``row``
    is a column with a number for each row; it is passed on and settles ties.

    A document whose middle lies before the end of the source's demand is taken, so a
    source misses its target by at most half a document.
    """
    name = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    d = docs.select(
        F.col(key).alias("id"), F.col(source).alias("source"), source_key(F.col(source)).alias("src"),
        n_words(F.col(text)).alias("size"), name.alias("name"), F.col(key).isNotNull().alias("named"),
        F.pmod(F.xxhash64(F.col(text)), F.lit(TIES)).alias("tie"), *([F.col(row).alias("row")] if row else []),
    ).withColumn("bucket", F.substring("name", 1, BUCKET_DIGITS))

    buckets = d.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
    sizes = buckets.groupBy("src").agg(F.sum("words").alias("source_size"))
    rank = F.row_number().over(Window.orderBy("src"))
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") - 1) % len(weights) + 1
    )
    sources = sizes.withColumn("rank", rank).withColumn("weight", weight)
    sources = tilted_schedule(fill_targets(sources, factor, cap), tilt)
    stream = F.sum("target").over(Window.partitionBy())
    sources = sources.withColumn("stream", stream)
    earlier = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.withColumn("start", F.coalesce(F.sum("words").over(earlier), F.lit(0))).join(sources, "src")

    # rows in the order of the hash, the id, the size and the text's hash: sums over rows
    # that agree in all of these come first, so that one id's rows are divided as well
    same = ["src", "bucket", "name", "named", "size", "tie"]
    groups = d.groupBy(*same).agg(F.sum("size").alias("words"))
    before = Window.partitionBy("src", "bucket").orderBy(*same[2:]).rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("ahead", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
    groups = groups.join(starts.drop("words", "rank", "weight"), ["src", "bucket"])
    inside = Window.partitionBy(*same).orderBy("row" if row else "tie").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(groups, same)
    offset = (F.col("start") + F.col("ahead") + F.col("inside")).cast("double")
    whole_copies = F.floor(F.col("target") / F.col("source_size")).cast("int")
    rest = F.col("target") - F.col("source_size") * whole_copies
    extra = (offset + F.col("size") / 2 < rest).cast("int")
    copies = F.when(F.col("source_size") > 0, whole_copies + extra).otherwise(F.lit(0))
    d = d.withColumn("offset", offset).withColumn("copies", copies)
    at = lambda k: due(F.col("offset") + k * F.col("source_size")) * F.col("stream")
    positions = F.when(
        F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), at)
    ).otherwise(F.array().cast("array<double>"))
    return d.select(
        F.col("id").alias(key), "source", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), positions.alias("positions"),
        *([F.col("row").alias(row)] if row else []),
    )


def training_order(planned: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per taken copy, range-sorted by training position."""
    copies = planned.select(key, F.posexplode("positions").alias("copy", "position"))
    return copies.orderBy("position", key, "copy")


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The documents of the mix in training order, a document taken twice as two rows.

    Rows are stored with a number first, so that each is repeated by its own positions,
    whatever other rows have its key.
    """
    stored = materialize(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("__row")))
    narrow = stored.select(F.col("row")[key].alias(key), F.col("row")[text].alias(text), F.col("row")[source].alias(source), "__row")
    planned = plan(narrow, key, text, source, row="__row", **options).select("__row", "positions")
    copies = stored.join(planned.where(F.size("positions") > 0), "__row").select("row", F.explode("positions").alias("position"))
    return copies.orderBy("position").select("row.*")
