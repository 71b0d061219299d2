"""Schedules as rows: weekly tables, overlaps, checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curio.functions import hours as H
from curio.operators.relations import pinned, spread


def overlaps(df: DataFrame, key: list[str], start: str, end: str) -> DataFrame:
    """Whether the next interval of the same key begins before this one ends."""
    after = F.lead(start).over(Window.partitionBy(*key).orderBy(start, end))
    return df.withColumn("overlaps", F.coalesce(after < F.col(end), F.lit(False)))


def weekly(rows: DataFrame, key: str, text: str) -> DataFrame:
    """One row per key: map from weekday to its schedule, missing days, and completeness. A day's last row by text wins."""
    d = pinned(spread(rows.select(key, F.col(text).alias("_t"))), s=H.day_row(F.col("_t"))).where("s.day IS NOT NULL")
    one = d.groupBy(key, F.col("s.day").alias("day")).agg(F.max_by("s", "_t").alias("s"))
    g = one.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("day", "s")), lambda a, b: F.when(a["day"] < b["day"], -1).when(a["day"] > b["day"], 1).otherwise(0))).alias("week"))
    missing = F.array_except(F.array(*map(F.lit, H.WEEKDAYS)), F.map_keys("week"))
    return g.withColumn("missing", missing).withColumn("completeness", F.when(F.size("missing") == 0, "complete").otherwise("partial"))


def violations(periods: DataFrame) -> DataFrame:
    """(id, day, rule) of rows id, day, closed, open24, opens, closes, next_day."""
    o, e = H.minutes(F.col("opens")), H.minutes(F.col("closes"))
    has = F.col("opens").isNotNull()
    rules = {
        "closed_with_periods": F.col("closed") & has, "closed_and_open24": F.col("closed") & F.col("open24"), "bad_time": has & (o.isNull() | e.isNull() | (o > 1440) | (e > 1440)),
        "overnight_without_flag": has & (e < o) & ~F.col("next_day"), "flag_without_overnight": has & (e >= o) & F.col("next_day"),
    }
    found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
    single = periods.select("id", "day", F.explode(found).alias("rule"))
    timed = periods.where(has & F.col("opens").isNotNull()).select("id", "day", o.alias("a"), F.when(F.col("next_day"), e + 1440).otherwise(e).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    return single.unionByName(overlaps(timed, ["id", "day"], "a", "b").where("overlaps").select("id", "day", F.lit("overlap").alias("rule"))).distinct()
