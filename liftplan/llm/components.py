"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftplan.llm.shared import stage


def _large(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours the smallest node that it knows."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node hands itself and its smaller neighbours the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    handed = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return handed.union(least.toDF("a", "b")).where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node of ``edges`` (two long columns).

    Both steps keep the components; when a round changes nothing, every node hangs on the smallest of its component. The
    number of rounds grows with the logarithm of the longest path. Loops and repeated edges do no harm; an edge with
    a null end is left out. The only thing brought to the driver in a round is a count and a checksum.
    """
    left, right = edges.columns
    now = stage(edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a != b").distinct(), "edges")
    seen = None
    while True:
        now = stage(_small(_large(now)), "edges")
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.sum(F.xxhash64("b", "a") % 1_000_003)).first())
        if state == seen or not state[0]:
            break
        seen = state
    hung = now.toDF("node", "component")
    return hung.union(hung.select("component", "component").distinct())
