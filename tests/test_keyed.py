"""Large JSON objects, read in ranges of bytes."""

import json
import random

import pytest

from curio.sources.keyed import entries, read_keyed

RECORD = "struct<name:string,n:bigint,tags:array<string>,deep:struct<a:array<array<int>>,b:string>>"
SPICE = ["", "a,b", ",", ",,", '"', '\\', '\\"', '{', '}', '[{', '}]', '", "x": {', '\n', "é漢😀", "\\,", '\\\\",{', "line\r\nline", ": {\"k\": 1},"]


def random_map(rng, size):
    text = lambda: "".join(rng.choice(SPICE) for _ in range(rng.randrange(5)))
    out = {}
    for i in range(size):
        r = {"name": text(), "n": rng.choice([None, 1, -20]), "tags": [text() for _ in range(rng.randrange(4))], "deep": rng.choice([None, {"a": [[1, 2], [], [3]], "b": text()}]), text(): {"skipped": [text()]}}
        out[f"{text()}{i}"] = {k: v for k, v in r.items() if rng.random() < 0.8}
    return out


def want(maps):
    deep = lambda d: None if d is None else (json.dumps(d.get("a")), d.get("b"))
    return sorted(repr((k, r.get("name"), r.get("n"), r.get("tags"), deep(r.get("deep")))) for m in maps for k, r in m.items())


def got(df):
    deep = lambda d: None if d is None else (json.dumps(d.a), d.b)
    return sorted(repr((r.key, r["name"], r.n, r.tags, deep(r.deep))) for r in df.collect())


@pytest.fixture
def ranges(spark):
    """Sets the size of ranges, and sets it back."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize(("size", "indent"), [(37, None), (64, 2), (101, 0), (1000, 4), (1 << 27, None)])
def test_borders_anywhere(spark, tmp_path, ranges, size, indent):
    rng = random.Random(size)
    maps = [random_map(rng, n) for n in (60, 1, 0, 7)]
    for i, m in enumerate(maps):
        (tmp_path / f"{i}.json").write_text(json.dumps(m, indent=indent, ensure_ascii=i % 2 == 0), encoding="utf-8")
    ranges(size)
    assert got(read_keyed(spark, f"file://{tmp_path}", RECORD)) == want(maps)


def test_many_tasks(spark, tmp_path, ranges):
    m = {f"k{i}": {"name": f"n {i}, {{", "n": i} for i in range(4000)}
    (tmp_path / "a.json").write_text(json.dumps(m))
    ranges(8192)
    assert spark.read.option("lineSep", ",").text(f"file://{tmp_path}").rdd.getNumPartitions() > 10
    assert got(read_keyed(spark, f"file://{tmp_path}", RECORD)) == want([m])
    assert entries(spark, f"file://{tmp_path}").count() == 4000


def test_repeats_blanks_and_nulls(spark, tmp_path, ranges):
    ranges(16)
    (tmp_path / "a.json").write_text('﻿ {"a": {"v": 1}, "b": null, "a": {"v": 2, "w": [3]},\n "": {}, "c": {"v": 5} \n} \n')
    (tmp_path / "b.json").write_text('{"a": {"v": 9}}')
    (tmp_path / "c.json").write_text(" \n ")
    (tmp_path / "d.json").write_text("")
    (tmp_path / "e.json").write_text(" { } ")
    rows = sorted(map(tuple, read_keyed(spark, f"file://{tmp_path}", "struct<v:int>", "slug").collect()), key=repr)
    assert rows == [("", None), ("a", 2), ("a", 9), ("b", None), ("c", 5)]


@pytest.mark.parametrize("text", ['[1, 2]', '{"a": {"v": 1}, "b": {"v": 2}', '{"a": {"v": 1}, "b', '"a": {"v": 1}', '{"a": {"v": "x"}}', '{"a": {"v": 1}} x', '{"a": {"v": 1}}, {"b": {"v": 1}}', '{"a": {"v": 1,, }}', "5", '{"a": {"v": 1]}'])
def test_what_is_no_object_raises(spark, tmp_path, ranges, text):
    ranges(16)
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="MALFORMED|ends within|no JSON object|FAILFAST"):
        read_keyed(spark, f"file://{tmp_path}", "struct<v:int>").collect()
