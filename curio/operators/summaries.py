"""Aggregations and window-like operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curio.sources.shared import written


def count_by(df: DataFrame, key: Column, name: str = "key", none: str = "unknown") -> DataFrame:
    """Counts by a key; missing keys and the literal `none` are one group."""
    return df.groupBy(F.when(F.length(F.trim(key)) > 0, key).otherwise(none).alias(name)).agg(F.count("*").alias("n"))


def coverage(df: DataFrame, key: str, has: dict[str, Column]) -> DataFrame:
    """Rows by key and how many have each thing, in one pass."""
    return df.groupBy(key).agg(F.count("*").alias("n"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in has.items()])


def missing(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, missing, total): all fields in one scan, then turned into rows."""
    one = df.agg(F.count("*").alias("total"), *[F.count_if(F.coalesce(F.trim(F.col(f)), F.lit("")) == "").alias(f) for f in fields])
    return one.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("missing"), F.col("total").alias("total")) for f in fields])).alias("x")).select("x.*")


def facet(df: DataFrame, values: Column, name: str = "value") -> DataFrame:
    """Distinct entities (id) by element of an array column."""
    return df.select("id", F.explode(F.array_distinct(values)).alias(name)).groupBy(name).agg(F.count("*").alias("n"))


def latest(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The last row per key. `order` sorts from the last on and must be total."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def slug_suffix(df: DataFrame, slug: str, order: list[Column]) -> DataFrame:
    """The nth repetition of a slug gets -n."""
    n = F.row_number().over(Window.partitionBy(slug).orderBy(*order)) - 1
    return df.withColumn("slug_unique", F.when(n > 0, F.concat(F.col(slug), F.lit("-"), n.cast("string"))).otherwise(F.col(slug)))


def once_only(df: DataFrame, value: str) -> DataFrame:
    """Rows whose value occurs once: by a join with the counts, which copes with hot values."""
    return df.join(df.groupBy(value).agg(F.count("*").alias("_n")).where("_n = 1").select(value), value)


def nearest(df: DataFrame, group: str, value: Column, target: int, tie: str) -> DataFrame:
    """Per group the row nearest the target, ties by another column; partial aggregation instead of a window."""
    g = df.groupBy(group).agg(F.min(F.struct(F.abs(value - target).alias("d"), F.col(tie).alias("t"))).alias("b"))
    return g.select(group, F.col("b.t").alias(tie), F.col("b.d").alias("distance"))


def capped_fill(df: DataFrame, owner: str, group: str, rank: list[Column], cap: int, most: int) -> DataFrame:
    """Per owner at most `most` rows: first the best `cap` of each group, then others, by the same order."""
    inner = Window.partitionBy(owner, group).orderBy(*rank)
    x = df.withColumn("_in", F.row_number().over(inner))
    outer = Window.partitionBy(owner).orderBy((F.col("_in") > cap).cast("int"), *rank)
    return x.withColumn("place", F.row_number().over(outer)).where(F.col("place") <= most).drop("_in")


def ranked_summary(df: DataFrame, owner: str, group: str, priority: Column, order: str, highlight: Column, low: Column) -> DataFrame:
    """Per owner its items for a short summary: (owner, group, order, score, place).

    An item scores 50, less 10 for each of the owner's groups that comes before its own (by priority, then name), 40 more as a highlight
    and 30 less as of low value. Up to 8 items all come; of more, 6, and of more than 20, 8: first the best two of each group,
    then the others; ties by group and order, which must be unique in a group. Null groups are a group of their own, which comes last.
    No more than 8 items of a group can come, so the rest goes before any exchange, and an owner with very many items is no hot key.
    """
    x = df.select(F.col(owner).alias("_owner"), F.col(group).alias("_group"), F.col(order).alias("_order"), priority.alias("_first"), (F.coalesce(highlight, F.lit(False)).cast("int") * 40 - F.coalesce(low, F.lit(False)).cast("int") * 30).alias("_extra"))
    best = x.withColumn("_in", F.row_number().over(Window.partitionBy("_owner", "_group").orderBy(F.desc("_extra"), "_order"))).where("_in <= 8")
    groups = x.groupBy("_owner", "_group").agg(F.min("_first").alias("_first"), F.count("*").alias("_n"))
    by_owner = Window.partitionBy("_owner")
    groups = groups.select("_owner", "_group", (F.row_number().over(by_owner.orderBy(F.asc_nulls_last("_first"), F.asc_nulls_last("_group"))) - 1).alias("_rank"), F.sum("_n").over(by_owner).alias("_total"))
    g = groups.select(F.col("_owner").alias("_o"), F.col("_group").alias("_g"), "_rank", "_total")
    b = best.join(g, F.col("_owner").eqNullSafe(F.col("_o")) & F.col("_group").eqNullSafe(F.col("_g"))).withColumn("score", 50 - 10 * F.col("_rank") + F.col("_extra"))
    place = F.row_number().over(by_owner.orderBy((F.col("_in") > 2).cast("int"), F.desc("score"), F.asc_nulls_last("_group"), "_order"))
    most = F.when(F.col("_total").between(9, 20), 6).otherwise(8)
    whole = b.withColumn("place", place).where(F.col("place") <= most)
    return whole.select(F.col("_owner").alias(owner), F.col("_group").alias(group), F.col("_order").alias(order), "score", "place")


def next_id(df: DataFrame, key: str) -> DataFrame:
    """The smallest positive number that is not used: the gap before the first number that is ahead of its place."""
    k = df.where(F.col(key) > 0).select(F.col(key).cast("bigint").alias("k")).distinct()
    after = k.select((F.col("k") + 1).alias("k")).union(df.sparkSession.range(1, 2).select(F.col("id").alias("k")))
    return after.join(k, "k", "left_anti").agg(F.min("k").alias("next_id"))


def owners(df: DataFrame, value: Column) -> DataFrame:
    """Values with the sorted ids that hold them, where there are several."""
    g = df.select("id", value.alias("value")).where("value <> ''").groupBy("value").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    return g.where(F.size("ids") > 1).select("value", F.size("ids").cast("bigint").alias("n"), F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))


def stratified_pilot(df: DataFrame, stratum: str, order: list[Column], each: int, control: DataFrame) -> DataFrame:
    """`each` rows of every stratum by a fixed order, and the control rows that must never match."""
    w = Window.partitionBy(stratum).orderBy(*order)
    return df.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= each).drop("_k").unionByName(control)


def multiset_difference(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, before, after, removed) of the values of `before`: how often each stands there, in `after`, and how many more before."""
    a = before.groupBy(key).agg(F.count("*").alias("before"))
    b = after.groupBy(key).agg(F.count("*").alias("after"))
    j = a.join(b, key, "left").withColumn("after", F.coalesce("after", F.lit(0)))
    return j.withColumn("removed", F.greatest(F.lit(0), F.col("before") - F.col("after")))


def placed(df: DataFrame, order: list[tuple[Column, bool]], name: str, keep: list[str] | None = None) -> DataFrame:
    """df (of it the columns `keep`) with each row's place in an order, from 1 on, without one task that sees all rows.

    Rows are range-partitioned, sorted within partitions and written; a row's place is its place within its partition and the
    number of rows in those before it. order: columns, and whether they fall; it must be total.
    """
    keys = [f"_o{i}" for i in range(len(order))]
    raw = df.select(*(keep or ["*"]), *[o.alias(k) for (o, _), k in zip(order, keys, strict=True)])
    by = [F.desc(k) if down else F.asc(k) for (_, down), k in zip(order, keys, strict=True)]
    dealt = written(raw.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()), "placed")
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    bases = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_base"))  # one row per partition
    within = dealt.withColumn("_k", F.row_number().over(Window.partitionBy("_part").orderBy(*by)))
    return within.join(F.broadcast(bases), "_part").withColumn(name, (F.col("_k") + F.col("_base")).cast("bigint")).drop("_part", "_k", "_base", *keys)
