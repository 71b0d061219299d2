"""Helpers shared by the training-data operators: table access, shared-folder tables, Arrow plumbing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir). Where it is unset, a local master gets a folder of its own."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = f"file://{tempfile.mkdtemp(prefix='curio-ckpt-')}"
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def materialise(df: DataFrame, name: str, codec: str = "zstd", level: int = 3) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts lineage, survives lost executors. level: of zstd."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/curio/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).option("parquet.compression.codec.zstd.level", level).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str, columns: list[str]) -> str:
    """A column name like `name` that is not among the columns, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def docs_of(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Just (key, text), with null text as the empty string."""
    return df.select(F.col(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias(text))


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch], pa.Schema], Iterator[pa.RecordBatch]], ddl: str) -> DataFrame:
    """mapInArrow for functions that also get the Arrow schema of their result."""
    arrow = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fn(batches, arrow)

    return df.mapInArrow(run, ddl)


def record_batch(cols: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cols[f.name], type=f.type) if not isinstance(cols[f.name], pa.Array) else cols[f.name] for f in schema], schema=schema)


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def byte_column(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty, without decoding to str."""
    typ = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return [x or b"" for x in col.cast(typ).to_pylist()]
