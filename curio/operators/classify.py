"""Rule-based classification with rules as data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curio.functions.arrays import let


def tag_matches(texts: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """(id, tag) of all patterns that match `text`: one pass over the rows, however many rules."""
    hits = F.array_compact(F.array(*[F.when(F.col("text").rlike(p), F.lit(tag)) for tag, p in rules]))
    return texts.select("id", F.explode(hits).alias("tag"))


def most_points(points: dict[str, Column], none: str = "unknown") -> Column:
    """The name with most points, the first of equal ones; `none` where all have none."""
    best = F.array_max(F.array(*[F.struct(n.alias("n"), F.lit(-i).alias("k"), F.lit(name).alias("name")) for i, (name, n) in enumerate(points.items())]))
    return let(best, lambda b: F.when(b["n"] > 0, b["name"]).otherwise(none))


def keyword_argmax(text: Column, lexicon: list[tuple[str, list[str]]], none: str = "unknown") -> Column:
    """Category with most keywords in the text; ties by order of the lexicon."""
    return most_points({cat: reduce(lambda a, b: a + b, [F.contains(text, F.lit(w)).cast("int") for w in words]) for cat, words in lexicon}, none)


def exposure(current: DataFrame, potential: DataFrame) -> DataFrame:
    """Per group: rows now, rows it could have, difference. Both sides (id, tag)."""
    return exposed(current.withColumn("could", F.lit(False)).unionByName(potential.withColumn("could", F.lit(True))))


def exposed(rows: DataFrame) -> DataFrame:
    """exposure of (id, tag, could) rows: could is true for what a row may have, false for what it has now."""
    n = rows.groupBy("tag").agg(F.countDistinct(F.when(~F.col("could"), F.col("id"))).alias("now"), F.countDistinct(F.when(F.col("could"), F.col("id"))).alias("could"))
    return n.withColumn("delta", F.col("could") - F.col("now"))
