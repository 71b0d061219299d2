"""Readers. Paths go to Spark alone, so any store that it reads will do."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from curio.sources.keyed import read_keyed


def csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All-string CSV with header; a byte-order mark goes."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def csv_optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """csv, or no rows where there is no file."""
    try:
        return csv(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def csv_multi(spark: SparkSession, paths: list[str], key: str) -> DataFrame:
    """Several files, of each key the row of the first file that has it."""
    parts = [csv(spark, p).withColumn("_file", F.lit(i)) for i, p in enumerate(paths)]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p, allowMissingColumns=True)
    first = both.groupBy(key).agg(F.min("_file").alias("_file"))
    return both.join(first, [key, "_file"]).dropDuplicates([key]).drop("_file")


def json_array(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    r = spark.read.option("multiLine", True)
    return (r.schema(schema) if schema else r).json(path)


def json_lines(spark: SparkSession, path: str, schema: StructType | str | None = None, strict: bool = False) -> DataFrame:
    """Blank lines are skipped; strict fails on what is no JSON."""
    r = spark.read.option("mode", "FAILFAST" if strict else "PERMISSIVE")
    return (r.schema(schema) if schema else r).json(path)


def json_auto(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """An array or lines, by the first character; empty input raises."""
    head = spark.read.text(path).select(F.trim("value").alias("v")).where("v <> ''").limit(1).collect()
    if not head:
        raise ValueError(f"{path} is empty")
    return json_array(spark, path, schema) if head[0].v.startswith("[") else json_lines(spark, path, schema)


def json_keyed(spark: SparkSession, path: str, record: str, key: str = "key") -> DataFrame:
    """A map from key to record, as rows; large files are read by many tasks."""
    return read_keyed(spark, path, record, key)


def json_versioned(spark: SparkSession, path: str) -> DataFrame:
    """Lines with `fields` of {value, confidence} (version 3) or flat `data` (version 2): cid, fields map; plus_code lifted from an address."""
    ddl = "cid string, fields map<string,struct<value:string,confidence:double>>, data map<string,string>"
    df = spark.read.schema(ddl).json(path)
    flat = F.coalesce(F.transform_values("fields", lambda _, v: v["value"]), F.col("data"))
    code = F.regexp_extract(F.coalesce(F.try_element_at(flat, F.lit("address")), F.lit("")), r"^([A-Z0-9]{4}\+[A-Z0-9]{2,3})", 1)
    return df.select("cid", F.when(code != "", F.map_concat(F.map_filter(flat, lambda k, _: k != "plus_code"), F.create_map(F.lit("plus_code"), code))).otherwise(flat).alias("fields"))


def osm(spark: SparkSession, path: str) -> DataFrame:
    """Elements with a name and coordinates."""
    ddl = "elements array<struct<type:string,id:bigint,lat:double,lon:double,tags:map<string,string>>>"
    e = spark.read.schema(ddl).option("multiLine", True).json(path).select(F.explode("elements").alias("e")).select("e.*")
    name = F.trim(F.coalesce(F.try_element_at("tags", F.lit("name")), F.lit("")))
    return e.withColumn("name", name).where("name <> '' AND lat IS NOT NULL AND lon IS NOT NULL")


def jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A database, through whatever driver the cluster has."""
    return spark.read.format("jdbc").option("url", url).option("query", query).options(**options).load()


def cached_page(pages: DataFrame, path: str) -> DataFrame:
    """The first page, by url, whose url holds the path."""
    return pages.where(F.contains("url", F.lit(path))).orderBy("url", "page_id").limit(1)


def text_files(spark: SparkSession, path: str, failed: str = "failure") -> DataFrame:
    """One snapshot per listing (file name up to the first dot); a clean file is preferred to a failure file."""
    t = spark.read.option("wholetext", True).text(path).select(F.col("value").alias("text"), F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]+)", 1).alias("listing"), F.col("_metadata.file_name").alias("file"))
    best = t.groupBy("listing").agg(F.min(F.struct(F.contains("file", F.lit(failed)).cast("int").alias("bad"), "file")).alias("b"))
    return t.join(best.select("listing", F.col("b.file").alias("file")), ["listing", "file"]).select("listing", "text")


def ledger(spark: SparkSession, path: str, schema: str, stream: bool = False, files: int | None = None) -> DataFrame:
    """JSON lines; as a stream, at most `files` new files a batch."""
    if not stream:
        return spark.read.schema(schema).json(path)
    r = spark.readStream.schema(schema)
    return (r.option("maxFilesPerTrigger", files) if files else r).json(path)


def organisations(spark: SparkSession, path: str, defaults: dict[str, str]) -> DataFrame:
    """A map from slug to record, with defaults for missing fields."""
    record = "struct<" + ",".join(f"{k}:string" for k in defaults) + ">"
    df = json_keyed(spark, path, record, "slug")
    return df.select("slug", *[F.coalesce(k, F.lit(v)).alias(k) for k, v in defaults.items()])


def binary_files(spark: SparkSession, path: str, name: str) -> DataFrame:
    """(file, size, digest): SHA-256 of the files below path whose path matches `name`; its first group names a file."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return d.select(F.regexp_extract("path", name, 1).alias("file"), F.col("length").alias("size"), F.sha2("content", 256).alias("digest")).where("file <> ''")
