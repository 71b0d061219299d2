"""Directory search: text match, facets, sorting, pages, public projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curio.functions import text as T


def matches_text(needle: str, fields: list[Column]) -> Column:
    """Whether the text is in any field, whatever the case. Array fields match by any element."""
    out = F.lit(not needle.strip())
    for f in fields:
        out = out | F.coalesce(F.contains(F.lower(f), F.lit(needle.strip().lower())), F.lit(False))
    return out


def facets(df: DataFrame, equal: dict[str, str], tags: dict[str, str] | None = None, has: list[str] | None = None) -> DataFrame:
    """Rows with the given values, with the tag in an array column, and with the named fields filled."""
    for k, v in equal.items():
        df = df.where(F.col(k) == v)
    for k, v in (tags or {}).items():
        df = df.where(F.array_contains(k, v))
    for k in has or []:
        df = df.where(T.present(F.col(k)))
    return df


def is_name(c: Column, noise: str) -> Column:
    """Not a label of the user interface: length 3 to 80, not digits alone, no noise word anywhere in it."""
    n = F.trim(c)
    return F.length(n).between(3, 80) & ~n.rlike("^[0-9]+$") & ~F.lower(n).rlike(noise)


def unwrap_url(c: Column) -> Column:
    """The destination inside a redirector's url=, u= or destination= parameter; other links as they are."""
    inner = F.try_url_decode(F.regexp_extract(c, r"[?&](?:url|u|destination)=([^&#]+)", 1))
    return F.when(inner.rlike("^https?://"), inner).otherwise(c)


def public_projection(df: DataFrame) -> DataFrame:
    """What may be published: a fixed list of fields; channels only as booleans."""
    return df.select(
        "id", "business_name", "area", "category", (T.whatsapp(F.col("whatsapp")) != "").alias("has_whatsapp"), T.present(F.col("phone")).alias("has_phone"),
        (T.handle(F.col("instagram_handle")) != "").alias("has_instagram"), T.present(F.col("website")).alias("has_website"),
    )


def page(df: DataFrame, order: list[Column], number: int, size: int = 50) -> DataFrame:
    """The first `number` pages, as a list that grows; order must be total."""
    return df.orderBy(*order).limit(number * size)


GRAM = 3


def _grams(text: Column) -> Column:
    """Distinct runs of letters, in one pass: letters beside those that follow them."""
    letters = F.split(text, "")
    runs = letters
    for k in range(1, GRAM):
        runs = F.zip_with(runs, F.slice(letters, k + 1, F.size(letters)), lambda run, x: F.concat(run, x))
    return F.array_compact(F.array_distinct(runs))


def write_index(df: DataFrame, fields: list[str], path: str, block_rows: int = 10_000) -> None:
    """Writes df as a table of blocks, beside the blocks that hold each run of three letters of the fields, whatever the case.

    Rows of neighbouring first fields stand in one block, each block in a folder of its own, so a search reads only the folders that may
    match. The index has one row for each run and block, made distinct within blocks before it is exchanged; it grows with the blocks
    and not with the rows. Blocks hold about block_rows rows, but for equal rows, which stay together.
    """
    size = df.count()
    n = max(1, -(-size // block_rows))
    order = [F.lower(F.col(fields[0])), F.xxhash64(*[F.col(x) for x in df.columns])]
    dealt = df.repartitionByRange(n, *order).withColumn("_block", F.spark_partition_id())
    (dealt.write.partitionBy("_block") if size else dealt.write).parquet(f"{path}/rows")  # without rows there would be no folder
    rows = df.sparkSession.read.parquet(f"{path}/rows")
    texts = [F.coalesce(F.lower(F.col(x).cast("string")), F.lit("")) for x in fields]
    grams = F.array_distinct(F.flatten(F.array(*[_grams(t) for t in texts])))
    rows.select("_block", F.explode(grams).alias("gram")).distinct().repartitionByRange("gram").sortWithinPartitions("gram").write.parquet(f"{path}/grams")


def search_index(spark: SparkSession, path: str, needle: str, fields: list[str]) -> DataFrame:
    """Rows of a written index that matches_text accepts: blocks that hold all runs of the needle are read and tested exactly.

    A needle of under three letters reads all blocks. A run in every row leaves all blocks; the result never depends on the index.
    """
    rows = spark.read.parquet(f"{path}/rows")
    n = needle.strip().lower()
    runs = sorted({n[i : i + GRAM] for i in range(len(n) - GRAM + 1)})
    if runs:
        held = spark.read.parquet(f"{path}/grams").where(F.col("gram").isin(runs))
        blocks = held.groupBy("_block").agg(F.count("*").alias("_n")).where(F.col("_n") == len(runs)).select("_block")
        rows = rows.join(blocks, "_block", "left_semi")
    return rows.where(matches_text(needle, [F.col(x) for x in fields])).drop("_block")
