"""Text search by a written index against the plain filter."""

import re

import pytest
from pyspark.sql import functions as F

from curio.operators.search import matches_text, search_index, write_index

FIELDS = ["name", "note"]


@pytest.fixture(scope="module")
def table(spark):
    rows = spark.range(6000).select("id", F.concat(F.lit("Place N"), F.format_string("%05d", "id"), F.lit(" É the end")).alias("name"), F.when(F.col("id") % 5 == 0, None).when(F.col("id") == 77, "RARE find, 漢字テスト").otherwise(F.lit("x")).alias("note"))
    return rows.unionByName(spark.sql("SELECT 9000L AS id, 'ab' AS name, '' AS note UNION ALL SELECT 9001L, NULL, NULL UNION ALL SELECT 9002L, '100%_a\\\\b', 'aaaa'"))


@pytest.fixture(scope="module")
def path(spark, table, tmp_path_factory):
    p = f"file://{tmp_path_factory.mktemp('search')}/i"
    write_index(table, FIELDS, p, 300)
    return p


@pytest.mark.parametrize("needle", ["n0123", " RARE ", "漢字テ", "é THE", "the end", "ab", "", "  ", "nothing here", "find, x", "%_a\\", "aaa", "aaaaa", "ndx"])
def test_same_rows_as_the_plain_filter(spark, table, path, needle):
    want = sorted(r.id for r in table.where(matches_text(needle, [F.col(x) for x in FIELDS])).collect())
    assert sorted(r.id for r in search_index(spark, path, needle, FIELDS).collect()) == want


def files_read(df):
    """Files of the row table that the scan opened."""
    df.collect()
    nodes, out = [df._jdf.queryExecution().executedPlan()], 0
    while nodes:
        n = nodes.pop()
        name = n.nodeName()
        if name == "AdaptiveSparkPlan":
            nodes.append(n.executedPlan())
        elif re.search("QueryStage", name):
            nodes.append(n.plan())
        elif name.startswith("Scan parquet") and "gram" not in n.schema().simpleString():
            out += n.metrics().apply("numFiles").value()
        nodes += [n.children().apply(i) for i in range(n.children().size())]
    return out


def test_a_rare_needle_reads_few_files(spark, path):
    every = files_read(search_index(spark, path, "the end", FIELDS))
    assert every >= 20
    assert 1 <= files_read(search_index(spark, path, "n01234", FIELDS)) <= every // 4


def test_long_texts(spark, tmp_path):
    long = "abc 😀é " * 60_000 + "needle"
    p = f"file://{tmp_path}/i"
    write_index(spark.createDataFrame([(1, long), (2, "needl")], "id bigint, name string"), ["name"], p, 1)
    assert [[r.id for r in search_index(spark, p, x, ["name"]).collect()] for x in ("NEEDLE", "é abc 😀", "needles")] == [[1], [1], []]


def test_an_empty_table(spark, tmp_path):
    p = f"file://{tmp_path}/i"
    write_index(spark.createDataFrame([], "id bigint, name string"), ["name"], p)
    assert search_index(spark, p, "luna", ["name"]).collect() == []
