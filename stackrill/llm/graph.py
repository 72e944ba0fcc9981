"""Connected components of a link table, without gathering links, nodes or components anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, spread_join


def components(links: DataFrame, temp: Scratch) -> DataFrame:
    """``links`` (a, b), longs -> (node, root) for each node that has a link, root the least node.

    Alternating large-star and small-star rounds: each node links its larger neighbours, then its
    smaller ones, to the least of them. Minima are aggregated before the shuffle; a hub's minimum is
    joined back by broadcast, so its links stay spread. Each round is a table in ``temp``, where the
    result is read from, too. It ends when a round changes nothing.
    """
    edges = temp.stored(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc-0")
    state, turn = _state(edges), 0
    least = lambda e, name: temp.stored(e.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), name)
    while state[0]:
        turn += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        known = least(both, f"cc-{turn}-hubs").withColumn("m", F.least("u", "m"))
        large = spread_join(both, known, ["u"], "n", 24).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = temp.stored(large, f"cc-{turn}-large")
        known = least(large, f"cc-{turn}-least")
        rest = spread_join(large, known, ["u"], "n", 24).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(known.select("u", F.col("m").alias("v")))
        edges = temp.stored(rest.distinct(), f"cc-{turn}-small")
        if (now := _state(edges)) == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a sum of their hashes: equal sets of edges have equal states."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head())
