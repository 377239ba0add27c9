"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidetable.llm.frames import stored
from tidetable.session import discard


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node of ``links``
    (columns a, b), roots included.

    Each round hangs every node's larger neighbours, then its smaller ones, on the smallest node
    near it, until all components are stars; the number of rounds grows with the logarithm of
    the longest path. Rounds are written to the shared folder, so a lost executor costs a round
    at most. Loops and repeated links don't matter; no links give no rows.
    """
    links = stored(links.where("a <> b").select("a", "b").distinct(), "links")
    before = None
    while True:
        now = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now["n"] == 0 or now == before:
            break
        before = now
        last, links = links, stored(small_star(large_star(links)), "links")
        discard(last)
    stars = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())


def large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return hung.unionByName(own).where("a <> b").distinct()
