"""Writers and output projections."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def csv(df: DataFrame, path: str, columns: list[str], single: bool = False) -> None:
    out = df.select(*columns)
    (out.coalesce(1) if single else out).write.mode("overwrite").option("header", True).csv(path)


def publish(df: DataFrame, path: str) -> str:
    """Writes df as a new version below path, then points readers at it; returns the version's path. df may come from path.

    The pointer is a file of its own for each version, made by one rename when all data is there: the newest names the table, so
    readers always find a whole one, and earlier versions stay until they are removed.
    """
    spark, jvm = df.sparkSession, df.sparkSession._jvm
    version = f"v-{time.time_ns():020d}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    hpath = jvm.org.apache.hadoop.fs.Path
    fs = hpath(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.create(hpath(f"{path}/_{version}")).close()
    if not fs.rename(hpath(f"{path}/_{version}"), hpath(f"{path}/{version}.current")):
        raise OSError(f"{path} cannot be pointed at {version}")
    return f"{path}/{version}"


def published(spark: SparkSession, path: str) -> DataFrame:
    """The newest version that publish has finished below path."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path
    fs = hpath(path).getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(hpath(path)) if s.getPath().getName().endswith(".current"))
    if not names:
        raise FileNotFoundError(path)
    return spark.read.parquet(f"{path}/{names[-1].removesuffix('.current')}")


def jsonl_append(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def keyed(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, value): one JSON value per key; rows rather than one large object."""
    return df.select(F.col(key).alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def export_sorted(df: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    return df.select(*columns).orderBy(*order)


def geojson(name: Column, lat: Column, lon: Column) -> Column:
    """A GeoJSON feature; names are cut to 60 letters."""
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"), F.struct(F.substring(name, 1, 60).alias("name")).alias("properties")))


def sitemap(base: str, slug: Column) -> Column:
    return F.concat(F.lit(f"<url><loc>{base}/"), slug, F.lit("/</loc></url>"))


def markdown_row(cells: list[Column]) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *[F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")) for c in cells]), F.lit(" |"))


def sheet_link(url: Column, shown: Column) -> Column:
    q = lambda c: F.replace(c, F.lit('"'), F.lit('""'))
    return F.when(url != "", F.concat(F.lit('=HYPERLINK("'), q(url), F.lit('","'), q(shown), F.lit('")'))).otherwise("")


def archive(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, before, after) as JSON of the rows that changed or went."""
    a = before.select(F.col(key), F.to_json(F.struct(*before.columns)).alias("before"))
    b = after.select(F.col(key), F.to_json(F.struct(*after.columns)).alias("after"))
    return a.join(b, key, "left").where("after IS NULL OR before <> after")
