"""Guarded merges. Each gives the new table and an audit of what happened to every change; nothing is written here.

Changes are checked against the expected state before they apply. A change that is there already is a no-op, so applying a
manifest twice changes nothing. `strict` raises, within the plan, if any change is stale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curio.functions import text as T


def upsert(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Rows of changes replace or join those of target; columns as in target, null changes keep the old value."""
    cols = [c for c in target.columns if c != key]
    a = target.withColumn("_t", F.lit(True))
    b = changes.select(key, *[F.col(c).alias(f"_{c}") for c in cols if c in changes.columns])
    return a.join(b, key, "full").select(key, *[F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) if f"_{c}" in b.columns else F.col(c) for c in cols])


def replace(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Whole rows of changes stand for those of target."""
    return target.join(changes.select(key), key, "left_anti").unionByName(changes.select(*target.columns))


def fill(target: DataFrame, source: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Empty fields of target from source."""
    b = source.select(key, *[F.col(f).alias(f"_{f}") for f in fields])
    j = target.join(b, key, "left")
    return j.select(*[F.when(T.present(F.col(c)), F.col(c)).otherwise(F.coalesce(F.col(f"_{c}"), F.col(c))).alias(c) if c in fields else F.col(c) for c in target.columns])


def conflict(main: Column, other: Column, overflow: Column) -> Column:
    """Overflow array with `other`, where it differs from a filled main value."""
    from curio.functions.arrays import add_unique

    differs = T.present(main) & T.present(other) & (T.url_norm(main) != T.url_norm(other))
    return F.when(differs, add_unique(overflow, other)).otherwise(overflow)


def longer(main: Column, other: Column, margin: int = 80) -> Column:
    return F.when(F.length(T.clean(other)) > F.length(T.clean(main)) + margin, other).otherwise(main)


ROUTES = (("instagram.com", "instagram_url"), ("facebook.com", "facebook_url"), ("booking.com", "booking_url"), ("tripadvisor.", "tripadvisor_url"))


def route(url: Column) -> Column:
    """Field that a link belongs to by its host, else other_social_urls."""
    out = F.lit("other_social_urls")
    for part, field in reversed(ROUTES):
        out = F.when(F.contains(T.host(url), F.lit(part)), field).otherwise(out)
    return F.when(T.present(url), out)


def expect(target: DataFrame, manifest: DataFrame, key: str, field: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """manifest: key, expected, new. (table, audit: key, outcome of applied, noop, stale or no_such_row)."""
    m = manifest.select(F.col(key).alias("_k"), F.col("expected").alias("_old"), F.col("new").alias("_new"))
    now = F.coalesce(F.col(field), F.lit(""))
    outcome = F.when(F.col("_k").isNull(), F.lit(None)).when(now == F.col("_new"), "noop").when(now == F.col("_old"), "applied").otherwise("stale")
    j = target.join(m, F.col(key) == F.col("_k"), "left").withColumn("_outcome", outcome)
    value = F.when(F.col("_outcome") == "applied", F.col("_new")).otherwise(F.col(field))
    if strict:
        value = F.when(F.col("_outcome") == "stale", F.raise_error(F.concat(F.lit("stale change for "), F.col(key).cast("string")))).otherwise(value)
    table = j.select(*[value.alias(c) if c == field else F.col(c) for c in target.columns])
    audit = j.where("_outcome IS NOT NULL").select(F.col(key), F.col("_outcome").alias("outcome"))
    lost = m.join(target.select(F.col(key).alias("_k")), "_k", "left_anti").select(F.col("_k").alias(key), F.lit("no_such_row").alias("outcome"))
    return table, audit.unionByName(lost)


def apply_ops(target: DataFrame, ops: DataFrame, key: str) -> DataFrame:
    """ops: key, op, old, new. Instagram replace and clear, Facebook clear, website to booking, status set; stale old values do nothing."""
    j = target.join(ops.select(F.col(key).alias("_k"), "op", "old", "new"), F.col(key) == F.col("_k"), "left")
    on = lambda op, f: (F.col("op") == op) & (F.coalesce(F.col(f), F.lit("")) == F.col("old"))
    edits = {
        "instagram_handle": F.when(on("ig_replace", "instagram_handle"), F.col("new")).when(on("ig_clear", "instagram_handle"), "").otherwise(F.col("instagram_handle")),
        "facebook_url": F.when(on("fb_clear", "facebook_url"), "").otherwise(F.col("facebook_url")),
        "tripadvisor_url": F.when(on("web_to_ta", "website"), F.col("website")).when(on("ta_clean", "tripadvisor_url"), F.col("new")).otherwise(F.col("tripadvisor_url")),
        "website": F.when(on("web_to_ta", "website"), "").otherwise(F.col("website")),
        "operating_status": F.when(on("status_set", "operating_status"), F.col("new")).otherwise(F.col("operating_status")),
    }
    return j.select(*[edits[c].alias(c) if c in edits else F.col(c) for c in target.columns])


def remove(target: DataFrame, names: DataFrame, key: str, apply: bool = False) -> DataFrame:
    """target without the named rows; untouched unless apply."""
    return target.join(names.select(key).distinct(), key, "left_anti") if apply else target


def collapse(target: DataFrame, aliases: DataFrame, key: str, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """aliases: canonical, alias, position. Canonical rows get empty fields from their aliases, first position first; aliases go.

    (table, archive of the alias rows with their canonical key).
    """
    a = aliases.join(target, aliases["alias"] == target[key]).select("canonical", "position", F.col("alias"), *fields)
    firsts = a.groupBy("canonical").agg(*[F.min(F.when(T.present(F.col(f)), F.struct("position", F.col(f).alias("v"))))["v"].alias(f) for f in fields])
    kept = fill(target.join(aliases.select(F.col("alias").alias(key)), key, "left_anti"), firsts.withColumnRenamed("canonical", key), key, fields)
    return kept, a.select("canonical", "alias", "position")


def transfer(target: DataFrame, moves: DataFrame, key: str, field: str) -> DataFrame:
    """moves: source, dest, value. The value moves only if source holds it and dest is empty, by one lookup of both states."""
    s = target.select(F.col(key).alias("source"), F.col(field).alias("_s"))
    d = target.select(F.col(key).alias("dest"), F.col(field).alias("_d"))
    ok = moves.join(s, "source").join(d, "dest").where((F.col("_s") == F.col("value")) & ~T.present(F.col("_d")))
    edits = ok.select(F.col("source").alias("_k"), F.lit("").alias("_v")).unionByName(ok.select(F.col("dest").alias("_k"), F.col("value").alias("_v")))
    j = target.join(edits, F.col(key) == F.col("_k"), "left")
    return j.select(*[F.coalesce("_v", field).alias(c) if c == field else F.col(c) for c in target.columns])


def assign(target: DataFrame, found: DataFrame, key: str, field: str) -> DataFrame:
    """found: key, value, state, evidence. Outcome per row: applied, collision (value in use or twice in the batch) or review."""
    used = target.where(T.present(F.col(field))).select(F.col(field).alias("value")).distinct().withColumn("_used", F.lit(True))
    twice = found.groupBy("value").agg(F.count("*").alias("_n"))
    j = found.join(target.select(key, F.col(field).alias("_now")), key, "left").join(used, "value", "left").join(twice, "value", "left")
    outcome = F.when((F.col("state") != "exact") | ~F.col("evidence") | T.present(F.col("_now")), "review").when(F.col("_used") | (F.col("_n") > 1), "collision").otherwise("applied")
    return j.select(key, "value", outcome.alias("outcome"))


def gate(rows: DataFrame, decisions: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """decisions: key, accept. (accepted rows, one row with the numbers of rows without a decision and of decisions without a row)."""
    from curio.operators.relations import three_way

    sides = three_way(rows.select(key), decisions.select(key), key)
    check = sides.agg(F.count_if(F.col("side") == "left").alias("undecided"), F.count_if(F.col("side") == "right").alias("unknown"))
    return rows.join(decisions.where("accept").select(key), key, "left_semi"), check


def tag_default(handle: Column, source: Column, value: str) -> Column:
    return F.when(T.present(handle) & ~T.present(source), value).otherwise(source)


def redact(df: DataFrame, field: str, where: Column) -> DataFrame:
    return df.withColumn(field, F.when(where, "").otherwise(F.col(field)))


def drop_tag(tags: Column, synonyms: Column, tag: str) -> tuple[Column, Column]:
    """Tag array and map of tag to dependants, both without the tag."""
    return F.array_remove(tags, tag), F.map_filter(synonyms, lambda k, _: k != tag)
