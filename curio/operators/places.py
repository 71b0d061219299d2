"""Coordinates from several sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def backfill(df: DataFrame, centre: tuple[float, float]) -> DataFrame:
    """Missing lat and lon from the mean of the area, else from the centre. The means are one small aggregate per area."""
    means = df.groupBy("area").agg(F.avg("lat").alias("_lat"), F.avg("lon").alias("_lon"))
    j = df.join(means, "area", "left")
    return j.withColumn("lat", F.coalesce("lat", "_lat", F.lit(centre[0]))).withColumn("lon", F.coalesce("lon", "_lon", F.lit(centre[1]))).drop("_lat", "_lon")


def coordinate_source(df: DataFrame, second: DataFrame) -> DataFrame:
    """Latitude by the first source that has one: own, second, mean of the area, default; with the source's name."""
    means = df.groupBy("area").agg(F.avg("lat").alias("_lat"))
    j = df.join(second, "id", "left").join(means, "area", "left")
    source = F.when(F.col("lat").isNotNull(), "own").when(F.col("other").isNotNull(), "second").when(F.col("_lat").isNotNull(), "area").otherwise("default")
    return j.withColumn("source", source).withColumn("lat", F.coalesce("lat", "other", "_lat", F.lit(0.0))).drop("other", "_lat")


def pair_by_position(left: DataFrame, right: DataFrame, group: str, left_order: str, right_order: str) -> DataFrame:
    """Rows of the two sides that have the same place in their group, by explicit orders."""
    a = left.withColumn("_k", F.row_number().over(Window.partitionBy(group).orderBy(left_order)))
    b = right.withColumn("_k", F.row_number().over(Window.partitionBy(group).orderBy(right_order)))
    return a.join(b, [group, "_k"]).drop("_k")
