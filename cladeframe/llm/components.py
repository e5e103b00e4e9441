"""Connected components by alternating large and small stars.

Every round is two aggregates and two joins over the links and is stored in the shared
folder; rounds needed grow with the logarithm of the number of nodes.  A hub's links are
joined with its one smallest neighbour, which adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeframe.runtime import materialize


def _down(links: DataFrame) -> DataFrame:
    """Distinct links from the larger node ``a`` to the smaller ``b``."""
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _signature(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) of all nodes in the links ``a, b``."""
    edges = materialize(_down(links))
    before = None
    now = _signature(edges)
    while now != before and now[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.least("low", "a").alias("b"))
        large = _down(large)
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("low").alias("b")),
            F.struct(F.col("a").alias("a"), F.col("low").alias("b")),
        )).alias("e")).select("e.*")
        edges = materialize(_down(small))
        before, now = now, _signature(edges)
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
