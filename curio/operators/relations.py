"""Relational helpers: three-way split, range join, set checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def three_way(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side): both, left or right; one full outer join instead of three passes."""
    a = left.select(key).distinct().withColumn("_l", F.lit(True))
    b = right.select(key).distinct().withColumn("_r", F.lit(True))
    side = F.when(F.col("_l").isNull(), "right").when(F.col("_r").isNull(), "left").otherwise("both")
    return a.join(b, key, "full").select(key, side.alias("side"))


def not_recovered(wanted: DataFrame, done: DataFrame, key: str, count: str) -> DataFrame:
    """Wanted keys without a row of a positive count; null keys on the right match nothing."""
    return wanted.join(done.where(F.col(key).isNotNull() & (F.col(count) > 0)).select(key).distinct(), key, "left_anti")


def in_ranges(df: DataFrame, value: str, zones: DataFrame, most: int = 10_000) -> DataFrame:
    """Rows in each zone with lo <= value <= hi. Zones are broadcast after their number is checked; more of them join by buckets."""
    n = zones.count()
    if n <= most:
        return df.join(F.broadcast(zones), F.col(value).between(F.col("lo"), F.col("hi")))
    width = zones.agg(F.avg(F.col("hi") - F.col("lo"))).first()[0] or 1.0
    cell = lambda c: F.floor(c / F.lit(width))
    z = zones.withColumn("_b", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi")))))
    return df.withColumn("_b", cell(F.col(value))).join(z, "_b").where(F.col(value).between(F.col("lo"), F.col("hi"))).drop("_b")


def prioritised_union(parts: list[DataFrame]) -> DataFrame:
    """All rows of the parts, with the number of the part."""
    return reduce(DataFrame.unionByName, [p.withColumn("priority", F.lit(i)) for i, p in enumerate(parts, 1)])


def set_equal(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return three_way(a, b, key).agg((F.count_if(F.col("side") != "both") == 0).alias("ok"))


def set_disjoint(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return three_way(a, b, key).agg((F.count_if(F.col("side") == "both") == 0).alias("ok"))


def set_subset(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Whether all keys of a are in b."""
    return three_way(a, b, key).agg((F.count_if(F.col("side") == "left") == 0).alias("ok"))


def pinned(df: DataFrame, **cols: Column) -> DataFrame:
    """df with further columns, worked out once: a generator stands between them and what uses them, so they are not inlined there."""
    made = F.struct(*[c.alias(n) for n, c in cols.items()])
    return df.select("*", F.explode(F.array(made)).alias("_made")).select("*", *[F.col(f"_made.{n}").alias(n) for n in cols]).drop("_made")


def spread(df: DataFrame) -> DataFrame:
    """df dealt evenly to three tasks a core, before costly work on each row: a small file with many rows is read by one task."""
    return df.repartition(3 * df.sparkSession.sparkContext.defaultParallelism)
