"""The ranked summary of an owner's items against a plain loop."""

import random

from pyspark.sql import functions as F

from curio.operators.summaries import ranked_summary

FIRST = {"b": 0, "a": 1}


def plain(rows):
    out = []
    for owner in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == owner]
        last = lambda v: (v is None, v or "")
        groups = sorted({r[1] for r in mine}, key=lambda g: (FIRST.get(g, 2), last(g)))
        scored = sorted(((50 - 10 * groups.index(g) + 40 * bool(h) - 30 * bool(w), g, i) for _, g, i, h, w in mine), key=lambda x: (-x[0], last(x[1]), x[2]))
        chosen, used = [], {}
        for x in scored:
            used[x[1]] = used.get(x[1], 0) + 1
            if used[x[1]] <= 2:
                chosen.append(x)
        chosen += [x for x in scored if x not in chosen]
        most = 6 if 8 < len(mine) <= 20 else 8
        out += [(owner, g, i, s, k) for k, (s, g, i) in enumerate(chosen[:most], 1)]
    return sorted(out, key=repr)


def test_equals_a_plain_loop(spark):
    rng = random.Random(3)
    rows = []
    for owner, n in [(1, 5), (2, 8), (3, 9), (4, 20), (5, 21), (6, 300), (None, 12), (7, 1)]:
        rows += [(owner, rng.choice(["a", "b", "c", "d", None] if owner != 6 else ["z", "z", "z", "b"]), i, rng.choice([True, False, None]), rng.choice([True, False, False, None])) for i in range(n)]
    df = spark.createDataFrame(rows, "o int, g string, i int, h boolean, w boolean")
    first = F.when(F.col("g") == "b", 0).when(F.col("g") == "a", 1).otherwise(2)
    got = ranked_summary(df, "o", "g", first, "i", F.col("h"), F.col("w"))
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)
    assert ranked_summary(df.limit(0), "o", "g", first, "i", F.col("h"), F.col("w")).count() == 0
