"""SQLite as a source and a sink."""

import os
import sqlite3

import pytest

from curio.sources.sqlite import files, read_sqlite, write_sqlite

ROWS = [(i, f"name {i % 7}", i / 4, bytes([i % 256]) if i % 3 else None) for i in range(2500)] + [(None, None, None, None), (-5, "é漢\n'\"", float("inf"), b"")]


@pytest.fixture
def path(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "id bigint, `na\"me` string, v double, raw binary").repartition(3)
    write_sqlite(df, f"file://{tmp_path}/db", "t")
    return f"{tmp_path}/db"


def rows(df):
    return sorted(((r[0], r[1], r[2], None if r[3] is None else bytes(r[3])) for r in df.collect()), key=repr)


def test_round_trip_in_ranges(spark, path):
    back = read_sqlite(spark, path, "t", 200)
    assert back.dtypes == [("id", "bigint"), ('na"me', "string"), ("v", "double"), ("raw", "binary")]
    assert rows(back) == sorted(ROWS, key=repr)
    assert len(files(path)) == 3 and back.rdd.getNumPartitions() >= 12
    write_sqlite(spark.createDataFrame([(9, "x", 1.0, None)], "id bigint, `na\"me` string, v double, raw binary"), path, "t")
    assert read_sqlite(spark, path, "t").count() == len(ROWS) + 1
    write_sqlite(spark.createDataFrame([(9,)], "id bigint"), path, "t", mode="overwrite")
    assert [r.id for r in read_sqlite(spark, path, "t").collect()] == [9]


def test_filters_are_tested_by_sqlite(spark, path):
    df = read_sqlite(spark, path, "t", 500)
    for text in ("id > 2400 AND v <= 620.5", "id = -5", "id IS NULL", "`na\"me` LIKE 'name 3%'", "`na\"me` LIKE '%e 4%' AND id < 50", "id IN (1, 2, 3000)", "`na\"me` = 'é漢\n''\"'", "id % 2 = 0 AND id < 9", "NOT id < 2490", "raw IS NOT NULL AND id >= 2490"):
        got = df.where(text)
        want = spark.createDataFrame(ROWS, df.schema).where(text)
        assert rows(got) == rows(want) and rows(got), text


def test_what_is_left_to_spark(path):
    from pyspark.sql.datasource import EqualTo, GreaterThan, IsNull, StringEndsWith, StringStartsWith
    from pyspark.sql.types import LongType, StructType

    from curio.sources.sqlite import Reader

    r = Reader(path, "t", StructType().add("id", LongType()).add("na\"me", "string"), 100)
    asked = [GreaterThan(("id",), 5), EqualTo(("id",), "5"), IsNull(('na"me',)), StringEndsWith(('na"me',), "x"), StringStartsWith(('na"me',), "n%"), EqualTo(("id", "x"), 5)]
    assert list(r.pushFilters(asked)) == [asked[1], asked[3], asked[5]]
    assert r.where == ['"id" > ?', '"na""me" IS NULL', 'instr("na""me", ?) = 1'] and r.values == [5, "n%"]


def test_foreign_databases(spark, tmp_path):
    with sqlite3.connect(tmp_path / "a.sqlite") as db:
        db.execute("CREATE TABLE rows (k TEXT PRIMARY KEY, n INT, f DECIMAL(9,2), b) WITHOUT ROWID")
        db.executemany("INSERT INTO rows VALUES (?, ?, ?, ?)", [("a", 1, 2.5, b"x"), ("b", "no number", None, "text")])
    db.close()
    got = sorted(map(tuple, read_sqlite(spark, str(tmp_path)).collect()))
    assert [(k, n, f, bytes(b)) for k, n, f, b in got] == [("a", 1, 2.5, b"x"), ("b", None, None, b"text")]
    with sqlite3.connect(tmp_path / "b.sqlite") as db:
        db.execute("CREATE TABLE rows (k TEXT, n INT, f DECIMAL(9,2), b)")
    db.close()
    assert read_sqlite(spark, str(tmp_path)).count() == 2  # an empty table beside it


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    from pyspark.sql import functions as F

    df = spark.range(100).select("id", F.when(F.col("id") == 77, F.raise_error(F.lit("stop")).cast("string")).alias("s"))
    with pytest.raises(Exception, match="stop"):
        write_sqlite(df.repartition(2), f"{tmp_path}/db")
    assert not os.path.isdir(f"{tmp_path}/db") or files(f"{tmp_path}/db") == []
    with pytest.raises(Exception, match="types"):
        write_sqlite(spark.sql("SELECT array(1) AS a"), f"{tmp_path}/db")
    with pytest.raises(Exception, match="mounted"):
        read_sqlite(spark, "hdfs://host/db").count()
