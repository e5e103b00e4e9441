"""Session helpers shared by the operators.

Iterative operators cut their lineage by writing each round to the shared
folder named in ``spark.checkpoint.dir`` and reading it back.  The table
survives the loss of an executor, keeps statistics for the optimizer, and is
computed once.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest table the library will bring to the driver or broadcast on its own
#: account (species lists, one species tree).  Larger inputs raise instead.
MAX_SMALL_ROWS = 100_000


#: A key counts as hot when it has more rows than this and more than one row in
#: ``HOT_SHARE``.
HOT_ROWS = 1_000_000
HOT_SHARE = 1000


#: Compressed bytes of a shuffle that one task works on, and rows, where rows are ids and
#: short words: they take ten times the bytes and more in memory.
TASK_BYTES = 4 << 20
TASK_ROWS = 500_000


class DataError(ValueError):
    """The input data breaks a documented rule."""


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, from ``spark.checkpoint.dir``.

    A private temporary folder is used only for a local master with the
    setting unset; on a cluster that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="cladeframe-"))
    return context.getCheckpointDir()


#: Lists that note the tables stored while they are open.
_NOTED: list[list[str]] = []


@contextmanager
def stored_tables() -> Iterator[list[str]]:
    """The paths of all tables stored inside the block, for ``drop_tables``."""
    made: list[str] = []
    _NOTED.append(made)
    try:
        yield made
    finally:
        _NOTED.remove(made)


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete stored tables that nothing reads any more, and forget their paths."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    while paths:
        path = hadoop(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, sort: str | None = None) -> DataFrame:
    """Write ``df`` to the checkpoint folder and return the stored table.

    ``sort`` orders the rows of each file so that filters on that column skip
    row groups.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/{uuid.uuid4().hex}"
    for made in _NOTED:
        made.append(path)
    (df.sortWithinPartitions(sort) if sort else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _small_tasks(spark: SparkSession, task_bytes: int) -> Iterator[None]:
    """Let adaptive execution merge tasks up to ``task_bytes`` only, not its 64 MB."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    given = spark.conf.get(name, None)
    spark.conf.set(name, str(task_bytes))
    try:
        yield
    finally:
        if given is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, given)


def materialize_even(df: DataFrame, sort: str | None = None, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``materialize`` by tasks whose memory does not grow with the table: a shuffle is
    read in pieces of at most ``task_bytes`` as far as its partitions allow."""
    with _small_tasks(df.sparkSession, task_bytes):
        return materialize(df, sort)


def by_rows(df: DataFrame, keys: list[str], total: int, rows: int = TASK_ROWS) -> DataFrame:
    """Rows with equal ``keys`` in one task, and about ``rows`` of all ``total`` in each.
    The number of tasks is given, so adaptive execution does not merge them."""
    few = min(df.sparkSession.sparkContext.defaultParallelism, 1 + total // 10_000)
    return df.repartition(max(few, -(-total // rows)), *keys)


def small_rows(df: DataFrame, what: str, limit: int = MAX_SMALL_ROWS) -> list:
    """Collect a dimension table, refusing one that is not small."""
    rows = df.take(limit + 1)
    if len(rows) > limit:
        raise DataError(f"{what}: more than {limit} rows, too many for this argument")
    return rows


def require_none(bad: DataFrame, message: str, column: str) -> None:
    """Raise when ``bad`` has rows, quoting a few values of ``column``."""
    sample = [str(r[0]) for r in bad.select(column).take(10)]
    if sample:
        raise DataError(f"{message}: {', '.join(sample)}")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Repartition a scan too coarse for the cluster before work that is heavy per
    row; one with enough partitions is left alone."""
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted, key) if df.rdd.getNumPartitions() < wanted else df


def join_skewed(many: DataFrame, one: DataFrame, key, total: int) -> DataFrame:
    """Inner join of a stored table ``many`` of at most ``total`` rows with ``one``,
    which has one row per ``key``.

    Keys with more rows than ``HOT_ROWS`` and than one row in ``HOT_SHARE`` are
    fewer than ``HOT_SHARE``, so their side is broadcast and their rows stay
    where they are; the other rows are shuffled.  No key is too large for a
    task, whatever its share.
    """
    if total <= HOT_ROWS:
        return many.join(one, key)
    keys = [key] if isinstance(key, str) else list(key)
    counted = many.groupBy(*keys).agg(F.count("*").alias("n"))
    hot = counted.where(F.col("n") > max(HOT_ROWS, total // HOT_SHARE)).select(*keys)
    rest = many.join(F.broadcast(hot), keys, "left_anti")
    hot_one = one.join(F.broadcast(hot), keys, "left_semi")
    return many.join(F.broadcast(hot_one), keys).unionByName(rest.join(one, keys))


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add a 0-based position in the total order given by ``order``.

    Rows are range-partitioned and numbered inside each partition; only one
    offset per partition is aggregated, so no task ever sees all the rows.
    ``order`` should end with a unique column, which also keeps the partitions
    even.
    """
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__mid", F.monotonically_increasing_id())
    )
    placed = materialize(ranged).withColumn("__pid", F.shiftright("__mid", 33))
    sizes = placed.groupBy("__pid").agg(F.count("*").alias("n"))
    # one row per partition of the shuffle above
    start, offsets = 0, []
    for pid, n in sorted((r["__pid"], r["n"]) for r in small_rows(sizes, "partitions")):
        offsets.append((pid, start))
        start += n
    offset = df.sparkSession.createDataFrame(offsets, "__pid bigint, __start bigint")
    in_partition = F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.join(F.broadcast(offset), "__pid")
        .withColumn(name, F.col("__start") + in_partition)
        .drop("__pid", "__mid", "__start")
    )
