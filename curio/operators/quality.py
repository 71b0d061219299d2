"""Data-quality rules as violation rows, and small predicates about evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evidence_ok(identifier: Column, text: Column, digest: Column, least: int) -> Column:
    """A numeric id, enough text, and a SHA-256 digest that fits."""
    return F.coalesce(identifier.rlike("^[0-9]+$") & (F.length(text) > least) & (F.sha2(text, 256) == digest), F.lit(False))


def violations(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, rule) of each broken rule, in one pass: rules are conditions that must not hold."""
    found = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules.items()]))
    return df.select(F.col(key), F.explode(found).alias("rule"))


def graded(df: DataFrame, key: str, rules: dict[str, tuple[Column, str]]) -> DataFrame:
    """violations with a severity."""
    found = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(name).alias("rule"), F.lit(level).alias("severity"))) for name, (bad, level) in rules.items()]))
    return df.select(F.col(key), F.explode(found).alias("x")).select(key, "x.rule", "x.severity")


def duplicates(df: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """Keys of more than one row, with their numbers; empty and null keys do not count."""
    return df.select(key.alias(name)).where(F.length(name) > 0).groupBy(name).agg(F.count("*").alias("n")).where("n > 1")


def unique_keys(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct keys, and whether they agree."""
    return df.agg(F.count(key).alias("n_rows"), F.countDistinct(key).alias("n_keys")).withColumn("ok", F.col("n_rows") == F.col("n_keys"))


def split_valid(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejects)."""
    ok = F.coalesce(ok, F.lit(False))
    return df.where(ok), df.where(~ok)


def release(files: DataFrame, manifest: DataFrame, budget: int) -> DataFrame:
    """(file, size, verdict) of every file of a manifest (file, digest): missing, over_budget, changed or ok. files: file, size, digest."""
    j = manifest.select("file", F.col("digest").alias("expected")).join(files, "file", "left")
    verdict = F.when(F.col("size").isNull(), "missing").when(F.col("size") > budget, "over_budget").when(F.col("digest") != F.col("expected"), "changed").otherwise("ok")
    return j.select("file", "size", verdict.alias("verdict"))
