"""A Bloom filter of fixed size over two long columns, as a help against moving rows.

It never changes a result: rows that pass by mistake meet the join that follows.  Its
size does not grow with the data; beyond some millions of keys it merely lets more pass.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rolling import mix

BITS = 1 << 25
HASHES = 3
#: Words of the filter that are packed into one row on their way to the driver.
BLOCK = 1 << 12


def _places(a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    x = mix(a.astype(np.int64).view(np.uint64) ^ mix(b.astype(np.int64).view(np.uint64)))
    step = mix(x) | np.uint64(1)
    return [(x + np.uint64(i) * step) & np.uint64(BITS - 1) for i in range(HASHES)]


def bloom(keys: DataFrame, a: str, b: str) -> np.ndarray:
    """The filter of all keys of a stored table, as 64-bit words."""

    def place(batches):
        for d in batches:
            at = np.unique(np.concatenate(_places(d["a"].to_numpy(), d["b"].to_numpy())))
            yield pd.DataFrame({"word": (at >> np.uint64(6)).astype(np.int64), "bits": (np.uint64(1) << (at & np.uint64(63))).view(np.int64)})

    def block(part: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(BLOCK, np.uint64)
        bits[part["word"].to_numpy() % BLOCK] = part["bits"].to_numpy().view(np.uint64)
        return pd.DataFrame({"block": [part["word"].iat[0] // BLOCK], "bits": [bits.tobytes()]})

    words = keys.select(F.col(a).alias("a"), F.col(b).alias("b")).mapInPandas(place, "word long, bits long")
    words = words.groupBy("word").agg(F.expr("bit_or(bits)").alias("bits"))
    blocks = words.groupBy(F.floor(F.col("word") / BLOCK)).applyInPandas(block, "block long, bits binary")
    bits = np.zeros(BITS // 64, np.uint64)
    for r in blocks.collect():  # BITS bits in all
        bits[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["bits"], np.uint64)
    return bits


def passes(bits: np.ndarray, a: str, b: str) -> Column:
    """Whether a row's key may be in the filter."""

    @F.pandas_udf("boolean")
    def test(x: pd.Series, y: pd.Series) -> pd.Series:
        hit = np.ones(len(x), bool)
        for at in _places(x.to_numpy(), y.to_numpy()):
            hit &= ((bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)
        return pd.Series(hit)

    return test(F.col(a), F.col(b))
