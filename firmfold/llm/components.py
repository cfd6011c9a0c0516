"""Connected components of a distributed set of links, by alternating star rounds.

Each round links every node's neighbours to its smallest neighbour. A hub costs one
row per link and map task, as only minima are aggregated; no neighbour list is ever
gathered. Rounds are cut by written tables in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmfold.llm.common import written


def _towards(rows: DataFrame) -> DataFrame:
    """Rows (high, low) with high > low, each once."""
    return rows.filter("high > low").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).unionByName(
        edges.select(F.col("low").alias("u"), F.col("high").alias("v")))
    least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    return _towards(both.join(least, "u").filter("v > u").select(F.col("v").alias("high"), F.col("m").alias("low")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("high").agg(F.min("low").alias("m"))
    near = edges.join(least, "high").select(F.col("low").alias("high"), F.col("m").alias("low"))
    return _towards(near.unionByName(least.select("high", F.col("m").alias("low"))))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("high", "low"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has a link; the component is its smallest node."""
    one, two = F.col(a), F.col(b)
    edges = written(_towards(links.select(F.greatest(one, two).alias("high"), F.least(one, two).alias("low"))), "links")
    state = _state(edges)
    while True:
        edges = written(_small_star(_large_star(edges)), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    leaves = edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
    roots = edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return leaves.unionByName(roots)
