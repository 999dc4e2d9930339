"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from platewise.llm.common import materialise


def _lowest(both: DataFrame) -> DataFrame:
    """For each node the smallest of itself and its neighbours; pre-aggregated before the shuffle."""
    return both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select("b", "a"))
    return both.join(_lowest(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    # each smaller neighbour, and the node itself, hang on the smallest neighbour
    return down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", "m"))


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label) of every node in ``links`` (columns a and b), the label being its component's smallest node.

    Each round is written to shared storage. The number of rounds grows with the logarithm of the longest path;
    the loop ends when a round changes nothing. A node's links are never gathered in one place.
    """
    now = materialise(links.select("a", "b").where("a <> b").distinct(), "links")
    seen = None
    for k in range(most_rounds):
        sign = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == tuple(sign) or not sign[0]:
            break
        seen = tuple(sign)
        large = _large_star(now).where("a <> b").distinct()
        now = materialise(_small_star(large).where("a <> b").distinct(), f"stars{k}")
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
