"""Sharding by histogram sort.

Splitters are found before anything moves: probe keys are sampled, the exact rows and
bytes below each probe are counted over all partitions, and new probes are sampled only
where a splitter still misses its share, until all are within tolerance.  Then the rows
are exchanged once, by the cells between probes, and numbered inside their cell; a
cell's first slot is known from the counts, so no task holds a shard.

Keys are the order columns and, last, the row's number in the stored input, so every
row can be cut from its neighbour: one key with a third of the rows spreads over as many
shards as its bytes need.  Splitters prefer the start of a new first order column, which
keeps equal values of it (equal texts, say) together wherever the tolerance allows.

Defined results: a missing order value sorts first, a missing size counts as 0, an
empty table gives no rows, more shards than rows leave some empty.  Input columns named
``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeframe.runtime import materialize

#: Probe keys sampled in a round; the driver holds these and their counts only.
PROBES = 4096


def _packed(columns) -> np.ndarray:
    """Longs side by side as bytes that sort as the longs do."""
    parts = np.empty((len(columns[0]), len(columns)), ">u8")
    for j, c in enumerate(columns):
        parts[:, j] = np.asarray(c, np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return parts.view(f"S{8 * len(columns)}").ravel()


def _draw(keys: np.ndarray, salt: int) -> np.ndarray:
    """A number from 0 to 1 for each key, the same on every rerun."""
    x = np.frombuffer(keys.tobytes(), "<u8").reshape(len(keys), -1).sum(axis=1, dtype=np.uint64)
    x = (x + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))).astype(np.float64) / 2.0**64


class _Histogram:
    """Probes in order with the exact rows and bytes below each; cell ``c`` lies
    between probe ``c - 1`` and probe ``c``."""

    def __init__(self, stored: DataFrame, keys: list[str], size: str, probes: np.ndarray):
        names = keys + [size]

        def count(batches):
            rows = np.zeros(len(probes) + 1, np.int64)
            held = np.zeros(len(probes) + 1, np.int64)
            for d in batches:
                cell = np.searchsorted(probes, _packed([d[k] for k in keys]), side="right")
                np.add.at(rows, cell, 1)
                np.add.at(held, cell, d[size].to_numpy())
            some = np.flatnonzero(rows)
            yield pd.DataFrame({"cell": some.astype(np.int32), "n": rows[some], "b": held[some]})

        got = stored.select(*names).mapInPandas(count, "cell int, n long, b long")
        got = got.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("b").alias("b")).collect()
        self.probes = probes
        self.rows, self.held = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        for r in got:  # as many rows as probes
            self.rows[r["cell"]], self.held[r["cell"]] = r["n"], r["b"]
        #: below the start of each cell, and below the end of the last
        self.rows_below = np.concatenate([[0], np.cumsum(self.rows)])
        self.below = np.concatenate([[0], np.cumsum(self.held)])


def _sample(stored: DataFrame, keys: list[str], h: _Histogram, cells: np.ndarray, rate: float, salt: int) -> np.ndarray:
    """Keys of a share of the rows in the given cells."""
    probes, wanted = h.probes, np.isin(np.arange(len(h.rows)), cells)

    def pick(batches):
        for d in batches:
            key = _packed([d[k] for k in keys])
            at = np.searchsorted(probes, key, side="right")
            key = key[wanted[at] & (_draw(key, salt) <= rate)]
            yield pd.DataFrame({"key": [k.ljust(key.itemsize, b"\0") for k in key.tolist()]})

    got = stored.select(*keys).mapInPandas(pick, "key binary").collect()  # about PROBES keys
    return np.array([bytes(r["key"]) for r in got], f"S{8 * len(keys)}")


def histogram_shards(
    df: DataFrame,
    order: list[str],
    size: str,
    shards: int = 40,
    tolerance: float = 0.01,
    fine: float = 0.001,
    probes: int = PROBES,
) -> DataFrame:
    """The rows of ``df`` with ``shard`` (0 to ``shards - 1``, of nearly equal sums of
    ``size``) and ``slot`` (from 0, without gaps, in key order inside the shard).

    ``order`` names long columns.  A splitter is settled when a value of the first one
    starts within ``tolerance`` of a mean shard from where it should, or any row within
    ``fine``, or when there is no row left to cut.
    """
    keys = [f"__k{i}" for i in range(len(order) + 1)]
    low = F.lit(-(2**63))
    stored = materialize(df.select(
        F.struct(*df.columns).alias("__row"),
        *[F.coalesce(F.col(c).cast("long"), low).alias(k) for c, k in zip(order, keys)],
        F.monotonically_increasing_id().alias(keys[-1]),
        F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("__size"),
    ))
    width = 8 * len(keys)
    h = _Histogram(stored, keys, "__size", np.array([], f"S{width}"))
    total = int(h.below[-1])
    share = total / shards
    goals = share * np.arange(1, shards)
    heads = lambda p: np.array([k.ljust(width, b"\0")[8:] == bytes(width - 8) for k in p], bool)
    salt = 0
    while True:
        # boundaries: the start of everything, each probe, the end of everything
        at = h.below
        group = np.concatenate([[True], heads(h.probes.tolist()), [True]])
        off = np.abs(goals[:, None] - at[None, group]) if len(goals) else np.zeros((0, 1))
        cell = np.clip(np.searchsorted(at, goals, side="right") - 1, 0, len(h.rows) - 1)
        near = np.minimum(np.abs(goals - at[cell]), np.abs(at[cell + 1] - goals))
        settled = (off.min(axis=1) <= tolerance * share) | (near <= fine * share) | (h.rows[cell] <= 1)
        if settled.all():
            break
        active = np.unique(cell[~settled])
        rate = min(1.0, probes / h.rows[active].sum())
        salt += 1
        new = _sample(stored, keys, h, active, rate, salt)
        starts = np.array([k.ljust(width, b"\0")[:8] for k in new.tolist()], f"S{width}")
        h = _Histogram(stored, keys, "__size", np.unique(np.concatenate([h.probes, new, starts])))
    places = np.flatnonzero(group)
    best = places[off.argmin(axis=1)] if len(goals) else np.zeros(0, int)
    plain = np.where(goals - at[cell] <= at[cell + 1] - goals, cell, cell + 1) if len(goals) else best
    cuts = np.where(off.min(axis=1) <= tolerance * share, best, plain) if len(goals) else best
    cuts = np.maximum.accumulate(cuts) if len(cuts) else cuts

    shard = np.searchsorted(cuts, np.arange(len(h.rows)), side="right")
    first = np.concatenate([[0], cuts])[shard] if len(cuts) else np.zeros(len(h.rows), int)
    offset = h.rows_below[:-1] - h.rows_below[first]
    # one row per cell, a few times the number of probes
    table = pd.DataFrame({"__cell": np.arange(len(h.rows), dtype=np.int32), "__shard": shard.astype(np.int32), "__first": offset})
    cells = df.sparkSession.createDataFrame(table, "__cell int, __shard int, __first long")
    found = h.probes

    @F.pandas_udf("int")
    def cell_of(*columns: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(found, _packed(columns), side="right").astype(np.int32))

    rank = F.row_number().over(Window.partitionBy("__cell").orderBy(*keys))
    placed = stored.withColumn("__cell", cell_of(*keys)).withColumn("__rank", rank)
    placed = placed.join(F.broadcast(cells), "__cell")
    return placed.select(
        *[F.col("__row").getField(c).alias(c) for c in df.columns if c not in ("shard", "slot")],
        F.col("__shard").alias("shard"), (F.col("__first") + F.col("__rank") - 1).alias("slot"),
    )
