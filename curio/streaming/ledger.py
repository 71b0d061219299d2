"""Append-only ledgers: compaction, resumption, retries, progress; in batch and as streams."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

if TYPE_CHECKING:
    import pandas as pd
    from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues


def bucket(state: Column, table: dict[str, str], none: str = "not_applicable") -> Column:
    """Coarse outcome of a state."""
    out = F.lit(none)
    for k, v in table.items():
        out = F.when(state == k, v).otherwise(out)
    return out


def pending(queue: DataFrame, ledger: DataFrame, key: str, version: str) -> DataFrame:
    """Queue rows that the ledger has no entry for at this version."""
    return queue.join(ledger.where(F.col("version") == version).select(key).distinct(), key, "left_anti")


def retries(ledger: DataFrame, key: str, transient: list[str], most: int) -> DataFrame:
    """(key, attempts) of keys whose last state is transient and that have attempts left."""
    last = ledger.groupBy(key).agg(F.max(F.struct("seq", "state")).alias("l"), F.count_if(F.col("state").isin(transient)).alias("attempts"))
    return last.where(F.col("l.state").isin(transient) & (F.col("attempts") < most)).select(key, "attempts")


def retry_queue(ledger: DataFrame, key: str, good: list[str]) -> DataFrame:
    """Keys that never reached a good state."""
    return ledger.groupBy(key).agg(F.count_if(F.col("state").isin(good)).alias("n")).where("n = 0").select(key)


def compact(ledger: DataFrame, key: str) -> DataFrame:
    """The last entry per key, one row: the largest sequence number; of equal ones the largest row. Partial aggregation, no join."""
    rest = [x for x in ledger.columns if x not in (key, "seq")]
    last = ledger.groupBy(key).agg(F.max(F.struct("seq", *rest)).alias("last"))
    return last.select(*[key if x == key else F.col(f"last.{x}").alias(x) for x in ledger.columns])


def progress(ledger: DataFrame) -> DataFrame:
    """Entries, distinct keys and failures by state; for streams in update mode."""
    return ledger.groupBy("state").agg(F.count("*").alias("entries"), F.max("seq").alias("last_seq"))


def windows(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Tumbling counts with a watermark. The time column must be TIMESTAMP, so NTZ is cast."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if events.isStreaming:
        e = e.withWatermark("ts", late)
    return e.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").cast("string").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if events.isStreaming:
        e = e.withWatermark("ts", "2 hours")
    return e.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select(F.col("session_window.start").cast("string").alias("start"), "user_id", "n")


class Attempts(StatefulProcessor):
    """Counts attempts and keeps the last entry of a key; a timer forgets keys that are silent for `keep_ms`."""

    def __init__(self, transient: list[str], most: int, keep_ms: int):
        self.transient, self.most, self.keep_ms = transient, most, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("attempts", "attempts bigint, seq bigint, state string, timer bigint")  # timer: last time and keep_ms

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        import pandas as pd

        attempts, seq, state, timer = self.state.get() if self.state.exists() else (0, None, None, None)
        newest = max(timerValues.getCurrentWatermarkInMs(), 0) if self.keep_ms else 0
        for r in rows:
            if self.keep_ms and r["ms"].notna().any():
                newest = max(newest, int(r["ms"].max()))
            attempts += int(r["state"].isin(self.transient).sum())
            for s, x in zip(r["seq"], r["state"], strict=True):
                if pd.notna(s) and (seq is None or (int(s), x or "") >= (seq, state or "")):
                    seq, state = int(s), x
        if self.keep_ms:
            old, timer = timer, max(timer or 0, newest + self.keep_ms)
            if old != timer:
                if old is not None:
                    self.handle.deleteTimer(old)
                self.handle.registerTimer(timer)
        self.state.update((attempts, seq, state, timer))
        yield pd.DataFrame({"key": [key[0]], "attempts": [attempts], "seq": pd.array([seq], "Int64"), "state": [state], "retry": [state in self.transient and attempts < self.most], "expired": [False]})

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        import pandas as pd

        attempts, seq, state, _ = self.state.get()
        self.state.clear()
        yield pd.DataFrame({"key": [key[0]], "attempts": [attempts], "seq": pd.array([seq], "Int64"), "state": [state], "retry": [False], "expired": [True]})

    def close(self) -> None:
        pass


def retry_state(stream: DataFrame, key: str, transient: list[str], most: int, keep: str | None = None, time: str = "ts", late: str = "1 hour") -> DataFrame:
    """Attempts of each key, as a stream in update mode: (key, attempts, seq, state, retry, expired) after every batch with news of it.

    seq and state are the last entry's: the largest seq, of equal ones the largest state; entries without seq count as attempts but
    are never last. retry: the last state is transient and fewer than `most` attempts were made. The order of arrival changes nothing.
    With `keep` (as "2 hours"), keys whose newest entry the watermark is that far ahead of come once more as expired, with
    retry false, and their state goes; later entries begin anew, at 0 attempts. The column `time` makes the watermark, `late` behind the
    newest time; rows behind the watermark are dropped, as Spark does before any state, and a missing time counts as the watermark's. Without `keep` nothing is dropped and nothing expires. State is
    in Spark's checkpoint, so a restart goes on where the last batch ended. Needs the RocksDB state store (see `state_store`).
    """
    kind = stream.schema[key].dataType.simpleString()
    at = F.col(time).cast("timestamp") if keep else None
    # pandas turns numbers beside nulls into floats, so seq goes as text
    rows = stream.select(F.col(key).alias("key"), F.col("seq").cast("string").alias("seq"), "state", *([at.alias("time"), F.unix_millis(at).alias("ms")] if keep else []))
    if keep:
        rows = rows.withWatermark("time", late)
    keep_ms = milliseconds(keep) if keep else 0
    out = f"key {kind}, attempts bigint, seq bigint, state string, retry boolean, expired boolean"
    return rows.groupBy("key").transformWithStateInPandas(Attempts(transient, most, keep_ms), out, "Update", "EventTime" if keep else "None").withColumnRenamed("key", key)


def milliseconds(text: str) -> int:
    """A length of time in words, in milliseconds."""
    import pandas as pd

    return int(pd.Timedelta(text).total_seconds() * 1000)


def run_updates(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Runs a stream in update mode over all that is there now; its rows, with the number of their batch, from a table at path.

    Each batch is a folder that is replaced if the batch runs again, so a restart from the checkpoint repeats no rows.
    """
    spark = stream.sparkSession
    spark.createDataFrame([], stream.schema).write.mode("ignore").parquet(f"{path}/batch=-1")
    with state_store(spark):
        run = stream.writeStream.outputMode("update").foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{path}/batch={n}")).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in stream.schema)}, batch bigint").parquet(path)


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Streams that start herein keep state in RocksDB, whatever the session does otherwise."""
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, old)
