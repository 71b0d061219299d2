"""Connected components of an edge table by alternating large-star and small-star steps, all in joins and partial aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curio.llm.common import materialise


def _large(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = materialise(least, "cc-least")  # so that hubs can be split in the join
    return both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = materialise(down.groupBy("u").agg(F.min("v").alias("m")), "cc-least")
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _mark(e: DataFrame) -> tuple:
    r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r.n, r.s


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): root is the smallest node of the component; only nodes that have an edge."""
    e = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "cc")
    mark = _mark(e)
    for _ in range(rounds):
        if not mark[0]:
            break
        e = materialise(_small(materialise(_large(e), "cc")), "cc")
        new = _mark(e)
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError("components did not settle")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
