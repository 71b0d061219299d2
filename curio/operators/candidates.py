"""Candidate pairs of similar names, by what they must share: two tokens of which one side holds both among its rarer ones, a
single token that is a whole name, or a phrase.

A pair of names that share a token, with Jaccard similarity of `least` or more, or of which one holds all tokens of the other but one (all, of up to
two), or at least six tenths of them, or one of which is a part of the other's text, is always a candidate:

* Names of two tokens or more share at least two tokens, where least is over a third. Of n tokens ordered by how many names hold
  them, at most n - ceil(least * n) are missing in the other, so two shared ones are among the first n - ceil(least * n) + 2.
  Keys are pairs of tokens; one side needs its first ones only. A token that all names hold makes no key alone.
* A name of one token is in names that hold it, and only such names meet by a single token.
* Of a name that is a part of another's text, the last two words meet the end of a word and the beginning of the next one there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curio.functions import text as T
from curio.sources.shared import written


def _ordered(names: DataFrame) -> DataFrame:
    """(side, name, o): tokens of each name, those that fewer names hold first. names: (side, name), distinct."""
    t = names.select("side", "name", F.explode(T.tokens(F.col("name"))).alias("t"))
    held = t.groupBy("t").agg(F.count("*").alias("held"))
    return t.join(held, "t").groupBy("side", "name").agg(F.transform(F.array_sort(F.collect_list(F.struct("held", "t"))), lambda x: x["t"]).alias("o"))


def _keys(names: DataFrame, least: float) -> DataFrame:
    """(side, name, key, own) for (side, name, o): own marks keys by which the name itself seeks others."""
    n = F.size("o")
    first = F.least(n, n - F.ceil(n * F.lit(least)).cast("int") + 2)

    def keyed(rows: DataFrame, key: Column, own: Column) -> DataFrame:
        return rows.select("side", "name", key.alias("key"), own.alias("own"))

    one = names.select("side", "name", "o", first.alias("first"), F.posexplode("o").alias("i", "x"))
    two = one.where(F.col("i") < n - 1).select("side", "name", "first", "i", "x", F.posexplode(F.slice("o", F.col("i") + 2, n)).alias("j", "y"))
    pairs = keyed(two, F.concat(F.least("x", "y"), F.lit("\x1f"), F.greatest("x", "y")), F.col("i") + F.col("j") + 1 < F.col("first"))
    single = keyed(one, F.concat(F.lit("\x1e"), F.col("x")), n == 1)

    words = F.split(F.trim("name"), " +")
    near = names.select("side", "name", "o", words.alias("w"), F.posexplode(words).alias("i", "x")).where(F.col("i") < F.size("w") - 1).withColumn("y", F.get("w", F.col("i") + 1))
    phrase = lambda a, b: F.concat(F.lit("\x1d"), a, F.lit(" "), b)
    x, y, k, m = F.col("x"), F.col("y"), F.col("k"), F.col("m")
    whole = F.lit(False)
    tail = keyed(near.where(F.col("i") == F.size("w") - 2), phrase(x, y), F.lit(True))
    starts = near.withColumn("k", F.explode(F.sequence(F.lit(1), F.length("y"))))
    ends = near.withColumn("m", F.explode(F.sequence(F.lit(1), F.length("x"))))
    # Both words in part: only where one of the parts is a whole word elsewhere, as names that are compared share one.
    part = F.exists("o", lambda t: ((t != x) & F.endswith(x, t)) | ((t != y) & F.startswith(y, t)))
    both = ends.where(part).withColumn("k", F.explode(F.sequence(F.lit(1), F.length("y"))))
    start, end = F.substring(y, F.lit(1), k), F.substring(x, m, F.length(x))
    parts = [pairs, single, tail, keyed(starts, phrase(x, start), whole), keyed(ends, phrase(end, y), whole), keyed(both, phrase(end, start), whole)]
    return reduce(DataFrame.unionByName, parts)


def similar_candidates(left: DataFrame, right: DataFrame, least: float = 0.5) -> DataFrame:
    """(l_name, r_name) of distinct names that may be similar; columns name."""
    if least <= 1 / 3:
        raise ValueError("names that share one token of several can reach this similarity: least must be over a third")
    names = left.select(F.lit("l").alias("side"), "name").unionByName(right.select(F.lit("r").alias("side"), "name")).where("name <> ''").distinct()
    keys = _keys(written(_ordered(names), "candidates"), least)  # several kinds of keys read it: names are ordered once
    # Joined with the few keys that either side seeks by: keys that both sides merely have are never paired.
    other = F.when(F.col("side") == "l", "r").otherwise("l").alias("side")
    seek = keys.where("own").select("key", other, F.col("name").alias("by"))
    met = seek.join(keys.drop("own"), ["key", "side"])
    of = lambda s: F.when(F.col("side") == s, F.col("name")).otherwise(F.col("by"))
    return met.select(of("l").alias("l_name"), of("r").alias("r_name")).distinct()
