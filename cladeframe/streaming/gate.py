"""Completeness of search results as they arrive.

Result files come as a stream of rows ``qid, did, length``.  The state of a key, a query
and a block of ``BITS`` databases, is a bit map of the databases that have a non-empty
result, so state stays small however often results are repeated, and a query with very
many databases is many keys.  Each batch's changed keys are written under the batch's
number; a batch that runs again after a failure writes the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..runtime import global_rank

#: Databases of one key, and the bits of a word of its map.
BITS = 4096
WORD = 64

RESULTS = "qid bigint, did bigint, length bigint"
GATE = "qid bigint, block bigint, words array<bigint>, n_present bigint"


def positions(ids: DataFrame) -> DataFrame:
    """``id, pos`` of the species, stored."""
    return global_rank(ids.select("id").distinct(), [F.col("id")], "pos")


def _note(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    words = np.array(state.get[0] if state.exists else np.zeros(BITS // WORD), np.int64).view(np.uint64)
    for batch in batches:
        place = batch["place"].to_numpy(np.int64)
        np.bitwise_or.at(words, place // WORD, np.uint64(1) << (place % WORD).astype(np.uint64))
    kept = words.view(np.int64).tolist()
    if not state.exists or kept != list(state.get[0]):
        state.update((kept,))
        present = int(np.unpackbits(words.view(np.uint8)).sum())
        yield pd.DataFrame({"qid": [key[0]], "block": [key[1]], "words": [kept], "n_present": [present]})


def present(results: DataFrame, ranked: DataFrame) -> DataFrame:
    """The changed keys of a stream of results of known species (``positions``)."""
    place = F.col("pos")
    known = (
        results.where("length > 0").select("qid", "did")
        .join(ranked.select(F.col("id").alias("did"), "pos"), "did")
        .join(ranked.select(F.col("id").alias("qid")), "qid", "left_semi")
        .select("qid", F.floor(place / BITS).alias("block"), (place % BITS).alias("place"))
    )
    return known.groupBy("qid", "block").applyInPandasWithState(
        _note, GATE, "words array<bigint>", "update", GroupStateTimeout.NoTimeout
    )


def run_gate(
    spark: SparkSession, arrivals: str, ranked: DataFrame, folder: str, files_per_batch: int = 100
) -> None:
    """Take in all result files (Parquet, ``RESULTS``) below ``arrivals`` that have come
    since the last run; ``folder`` holds the stream's state and the gate's rows."""
    stream = spark.readStream.schema(RESULTS).option("maxFilesPerTrigger", files_per_batch).parquet(arrivals)

    def keep(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/gate/batch={number}")

    started = (
        present(stream, ranked).writeStream.outputMode("update").foreachBatch(keep)
        .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    )
    started.awaitTermination()


def gate_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The latest row of every key."""
    rows = spark.read.schema(GATE + ", batch bigint").parquet(f"{folder}/gate")
    latest = F.max_by(F.struct("words", "n_present"), "batch").alias("r")
    return rows.groupBy("qid", "block").agg(latest).select("qid", "block", "r.words", "r.n_present")


def still_missing(spark: SparkSession, folder: str, ranked: DataFrame) -> DataFrame:
    """Ordered pairs ``qid, did`` (self included) without a non-empty result so far."""
    n = ranked.count()
    block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(max(n - 1, 0) // BITS).cast("bigint"))).alias("block")
    every = ranked.select(F.col("id").alias("qid"), block)
    held = every.join(gate_rows(spark, folder).select("qid", "block", "words"), ["qid", "block"], "left")
    last = F.least(F.lit(BITS - 1), F.lit(n - 1) - F.col("block") * BITS)
    place = F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("place")
    places = held.where(last >= 0).select("qid", "block", "words", place)
    bit = F.expr(f"shiftright(get(words, cast(place div {WORD} as int)), cast(place % {WORD} as int)) & 1")
    holes = places.where(F.col("words").isNull() | (bit == 0)).select("qid", (F.col("block") * BITS + F.col("place")).alias("pos"))
    return holes.join(ranked.select("pos", F.col("id").alias("did")), "pos").select("qid", "did")
