"""Connected components of a links table, by alternating large and small stars.

Each round replaces links by links to smaller neighbours, with grouped minima that are combined
before the shuffle. The minima are written before links meet them, so that adaptive execution
broadcasts few of them and splits a node with very many links between tasks. Rounds are written to
the shared folder, too, so that lost executors do not replay the loop. The number of rounds grows with the
logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.sources.staging import Staging


def _to_minima(links: DataFrame, upward: bool, staging: Staging) -> DataFrame:
    """Large star (upward): a node's larger neighbours to the least node of its neighbourhood.
    Small star: a node and its smaller neighbours to the least of them."""
    if upward:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links
    least = staging.table(
        both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("m"))
    )
    joined = both.join(least, "a")
    if upward:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return staging.table(moved.where("a <> b").distinct())


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame, a: str, b: str, staging: Staging) -> DataFrame:
    """(node, component) for every linked node; the component is its least node."""
    first = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    now = staging.table(first.where("a <> b").distinct())
    seen = _digest(now)
    while seen[0]:
        now = _to_minima(_to_minima(now, True, staging), False, staging)
        before, seen = seen, _digest(now)
        if before == seen:
            break
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
