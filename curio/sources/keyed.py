"""One large JSON object, read by many tasks: every entry at the top level is a row.

Spark's text reader cuts the files at commas, so a file is read in ranges of bytes, from any store. Whether a comma stands inside a
string, and how deep in brackets, depends on all that comes before it: each range computes both cases (its begin outside or inside
a string), a small table of ranges (one row each) composes them in order, and entries begin where the depth is one. An escape never
holds a comma, so no cut splits one. Windows stay within a range, whose size is spark.sql.files.maxPartitionBytes.

Defined results: a key that a file repeats keeps its last record; equal keys of several files stay apart. An empty object, or a file of
blanks, gives no rows. A null record gives a row of nulls. What is no JSON object, is cut off, or holds a record of another type raises;
a second object behind the first in one line is not looked for. Compressed files are one range each. Fields beyond the record's are
left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curio.sources.shared import written

c = F.col


def _depth(text: Column) -> Column:
    """By how much the brackets of a text outside strings go down."""
    return F.length(F.regexp_replace(text, r"[^\[{]", "")) - F.length(F.regexp_replace(text, r"[^\]}]", ""))


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Texts between commas: (file, block, at, value, turned, nth, d0, d1, q, o0, o1).

    q: quotes that count, odd or not. turned: parity of those before, within the range. o0 and o1: change of depth, if the range
    begins outside and inside a string; d0 and d1: the sum of those before. nth: how many stand before it in the range.
    """
    raw = spark.read.option("lineSep", ",").text(path)
    p = raw.select(c("_metadata.file_path").alias("file"), c("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    outside = _depth(F.regexp_replace("plain", r'"[^"]*+("|\z)', ""))
    inside = _depth(F.regexp_replace(F.regexp_replace("plain", r'\A[^"]*+("|\z)', ""), r'"[^"]*+("|\z)', ""))
    p = p.withColumn("plain", plain).select("file", "block", "at", "value", (F.length(F.regexp_replace("plain", r'[^"]', "")) % 2).alias("q"), outside.alias("outside"), inside.alias("inside"))
    before = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    p = p.withColumn("turned", F.coalesce(F.sum("q").over(before), F.lit(0)) % 2)
    p = p.withColumn("o0", F.when(c("turned") == 0, c("outside")).otherwise(c("inside"))).withColumn("o1", F.when(c("turned") == 0, c("inside")).otherwise(c("outside"))).drop("outside", "inside")
    return p.select("*", F.count("*").over(before).alias("nth"), *[F.coalesce(F.sum(f"o{i}").over(before), F.lit(0)).alias(f"d{i}") for i in (0, 1)])


def _ranges(pieces: DataFrame) -> DataFrame:
    """(file, block, quoted, deep): whether each range begins in a string, and how deep. Files that end within the object raise."""
    ends = pieces.groupBy("file", "block").agg((F.sum("q") % 2).alias("q"), F.sum("o0").alias("o0"), F.sum("o1").alias("o1"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    r = ends.withColumn("quoted", F.coalesce(F.sum("q").over(before), F.lit(0)) % 2).withColumn("change", F.when(c("quoted") == 0, c("o0")).otherwise(c("o1")))
    of_file = Window.partitionBy("file")
    r = r.withColumn("whole", (F.sum("change").over(of_file) == 0) & (F.sum("q").over(of_file) % 2 == 0))
    deep = F.coalesce(F.sum("change").over(before), F.lit(0))
    return r.select("file", "block", "quoted", F.when(c("whole"), deep).otherwise(F.raise_error(F.concat(c("file"), F.lit(" ends within its object")))).alias("deep"))


def entries(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, place, entry): the text of every top-level entry, without the object's own brackets."""
    pieces = written(_pieces(spark, path), "keyed-pieces")
    p = pieces.join(_ranges(pieces), ["file", "block"])
    p = p.withColumn("depth", c("deep") + F.when(c("quoted") == 0, c("d0")).otherwise(c("d1"))).withColumn("after", c("depth") + F.when(c("quoted") == 0, c("o0")).otherwise(c("o1")))
    refuse = F.raise_error(F.concat(c("file"), F.lit(" holds no JSON object")))
    p = p.withColumn("depth", F.when((c("depth") > 0) | ((c("block") == 0) & (c("nth") == 0)), c("depth")).otherwise(refuse))
    starts = (c("depth") <= 1) & ((c("turned") + c("quoted")) % 2 == 0)
    so_far = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    p = p.withColumn("first", F.max(F.when(starts, c("at"))).over(so_far)).select("file", "block", "at", "value", "depth", "after", "first")
    p = written(p, "keyed-starts")
    # what stands before the first start of a range belongs to the last entry of a range before it
    last = p.groupBy("file", "block").agg(F.max("first").alias("last"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("file", "block", F.last(F.when(c("last").isNotNull(), F.struct("block", c("last").alias("at"))), ignorenulls=True).over(before).alias("carried"))
    whole = p.join(carried, ["file", "block"]).withColumn("place", F.when(c("first").isNotNull(), F.struct("block", c("first").alias("at"))).otherwise(c("carried")))
    g = whole.groupBy("file", "place").agg(F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("parts"), F.min("depth").alias("depth"), F.min("after").alias("after"))
    g = g.select("file", "place", "depth", "after", F.concat_ws(",", F.transform("parts", lambda x: x["value"])).alias("entry"))
    head = F.when(c("depth") > 0, c("entry")).when(c("entry").rlike(r"\A\s*(\{|\z)"), F.regexp_replace("entry", r"\A\s*\{", "")).otherwise(refuse)
    tail = F.when(c("after") > 0, c("entry")).when(c("entry").rlike(r"(\}|\A)\s*\z"), F.regexp_replace("entry", r"\}\s*\z", "")).otherwise(refuse)
    return g.withColumn("entry", head).select("file", "place", tail.alias("entry"))


def read_keyed(spark: SparkSession, path: str | list[str], record: str, key: str = "key") -> DataFrame:
    """(key, fields of the record) of every entry."""
    e = entries(spark, path)
    m = F.from_json(F.concat(F.lit("{"), "entry", F.lit("}")), f"map<string,{record}>", {"mode": "FAILFAST"})
    rows = e.select("file", "place", F.explode(m).alias(key, "r"))
    last = rows.groupBy("file", key).agg(F.max_by("r", "place").alias("r"))
    return last.select(key, "r.*")
