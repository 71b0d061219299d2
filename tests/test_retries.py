"""Retries as a stream with state: batches, restarts, expiry, late rows."""

import random

import pytest

from curio.streaming import ledger

DDL = "rid bigint, seq bigint, state string, ts timestamp"
STATES = ["error", "view", "ok", None]


def plain(rows, most):
    """What the state of each rid comes to."""
    out = {}
    for rid in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == rid]
        seen = [(r[1], r[2] or "", r[2]) for r in mine if r[1] is not None]
        seq, _, state = max(seen, key=lambda x: x[:2]) if seen else (None, None, None)
        n = sum(r[2] in ("error", "view") for r in mine)
        out[rid] = (n, seq, state, state in ("error", "view") and n < most)
    return out


def drop(spark, rows, path):
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").json(path)


@pytest.fixture
def run(spark, tmp_path):
    """Everything of the folder that is new, by batch; each call is a restart from the checkpoint."""
    d = f"file://{tmp_path}"

    def go(most=4, keep=None, late="1 hour"):
        s = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).json(f"{d}/in")
        out = ledger.run_updates(ledger.retry_state(s, "rid", ["error", "view"], most, keep, late=late), f"{d}/out", f"{d}/checkpoint")
        return sorted(((r.batch, r.rid, r.attempts, r.seq, r.state, r.retry, r.expired) for r in out.collect()), key=repr)

    return f"{d}/in", go


def last(rows):
    return {r[1]: r[2:6] for r in sorted(rows, key=lambda r: r[0])}


def test_batches_and_restarts_equal_one_plain_pass(spark, run):
    rng = random.Random(5)
    rows = [(rng.choice([1, 2, 3, 4, 5, None]), rng.choice([None, *range(12), 2**60 + 1, 2**60 + 2]), rng.choice(STATES), None) for _ in range(90)]
    path, go = run
    drop(spark, rows[:30], path)
    drop(spark, rows[30:50], path)
    first = go()
    assert last(first) == plain(rows[:50], 4) and len({r[0] for r in first}) == 2
    assert go() == first  # nothing new: nothing again
    drop(spark, rows[50:], path)
    both = go()
    assert both[: len(first)] == first or set(first) <= set(both)
    assert last(both) == plain(rows, 4)


def test_silent_keys_expire_and_begin_anew(spark, run):
    import datetime as dt

    at = lambda h: dt.datetime(2026, 1, 1) + dt.timedelta(hours=h)
    path, go = run
    drop(spark, [(1, 1, "error", at(0)), (2, 1, "view", at(0))], path)
    go(keep="3 hours")
    drop(spark, [(2, 2, "error", at(9))], path)  # the watermark goes to 8: key 1 and its timer, at 3, are behind it
    got = go(keep="3 hours")
    assert [r[1:] for r in got if r[6]] == [(1, 1, 1, "error", False, True)]
    assert last([r for r in got if r[1] == 2])[2] == (2, 2, "error", True)
    drop(spark, [(1, 2, "error", at(10)), (1, 3, "error", at(1))], path)  # the second is late: dropped before any state
    got = go(keep="3 hours")
    assert last([r for r in got if r[1] == 1])[1] == (1, 2, "error", True)


def test_an_empty_ledger(spark, run):
    path, go = run
    spark.createDataFrame([], DDL).write.json(path)
    assert go() == []
