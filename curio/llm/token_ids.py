"""Token-id output: texts to ids, written in ascending doc_id order as coded blocks, and read back.

Documents are range-partitioned by key (the only exchange of texts), sorted within partitions, encoded and cut into blocks of
BLOCK ids across document borders; every block is coded independently (id_coder). The table has columns part, block, n_ids,
data. Reading decodes blocks in any order; a document that spans blocks is put together from its fragments' checksums.

Defined results: null or empty text is the end id alone. Null keys come first. Rows with equal keys stay apart, in the order
of their texts' hashes. An empty table gives no blocks. Extra columns are ignored. A damaged block raises.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curio.llm import id_coder
from curio.llm.common import docs_of, map_arrow, materialise

END_ID = 1


def write_ids(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """The table of coded blocks, in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        from curio.llm.tokens import word_encoder

        enc, part = word_encoder(tokenizer_path), TaskContext.get().partitionId()
        size = 4 * id_coder.BLOCK
        held, ends, number = bytearray(), [], 0

        def send(raw: bytes, own: list[tuple]) -> pa.RecordBatch:
            nonlocal number
            coded = id_coder.encode_block(np.frombuffer(raw, "<u4"), own)
            number += 1
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(([part], [number - 1], [len(raw) // 4], [coded]), schema, strict=True)], schema=schema)

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held += enc.ids(text) + END_ID.to_bytes(4, "little")
                ends.append((doc, len(held) // 4))
                at = 0
                while len(held) - at >= size:
                    own = [(d, e - at // 4) for d, e in ends if e * 4 <= at + size]
                    ends = ends[len(own) :]
                    yield send(bytes(held[at : at + size]), own)
                    at += size
                if at:
                    del held[:at]
                    ends = [(d, e - at // 4) for d, e in ends]
        if held:
            yield send(bytes(held), ends)

    # The hash splits keys that many rows share, as a missing one.
    keyed = docs_of(docs).select("doc_id", "text", F.xxhash64("text").alias("within"))
    ordered = keyed.repartitionByRange("doc_id", "within").sortWithinPartitions("doc_id", "within", "text").select("doc_id", "text")
    return materialise(map_arrow(ordered, run, "part bigint, block bigint, n_ids bigint, data binary"), "token-ids", codec="uncompressed")


def read_fragments(blocks: DataFrame) -> DataFrame:
    """Per document and block that holds part of it: part, at (ids of the partition before it), n, crc, doc_id, last.

    A fragment without an end in its block has last = false and no doc_id; it belongs to the next end behind it.
    """

    def run(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, block, coded in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                ids, ends = id_coder.decode_block(coded.as_py())
                raw, base, a, rows = memoryview(ids.tobytes()), block * id_coder.BLOCK, 0, []
                for doc, e in ends:
                    rows.append((part, base + a, e - a, zlib.crc32(raw[4 * a : 4 * e]), doc, True))
                    a = e
                if a < len(ids):
                    rows.append((part, base + a, len(ids) - a, zlib.crc32(raw[4 * a :]), None, False))
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return map_arrow(blocks.select("part", "block", "data"), run, "part bigint, at bigint, n bigint, crc bigint, doc_id bigint, last boolean")


def document_index(blocks: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the stored blocks."""
    pieces = materialise(read_fragments(blocks), "token-fragments")
    # A fragment that starts a block belongs to a document from an earlier one if its number of the block's first end says so:
    # borders are where a block's last fragment has no end. Each chain of such blocks is one document.
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n_part"))
    bases = sizes.select("part", (F.sum("n_part").over(Window.orderBy("part")) - F.col("n_part")).alias("base"))  # one row per partition
    block = F.floor(F.col("at") / id_coder.BLOCK)
    open_ends = pieces.where(~F.col("last")).select("part", (block + 1).alias("block"))
    firsts = pieces.where(F.col("at") % id_coder.BLOCK == 0).withColumn("block", block).join(open_ends.withColumn("goes_on", F.lit(True)), ["part", "block"], "left")
    heads = pieces.where((F.col("at") % id_coder.BLOCK != 0) & F.col("last")).select("part", "at", "n", "crc", "doc_id")
    alone = firsts.where(F.col("goes_on").isNull() & F.col("last")).select("part", "at", "n", "crc", "doc_id")
    chained = firsts.where(F.col("goes_on")).select("part", "at", "n", "crc", "doc_id", "last").unionByName(
        pieces.where((F.col("at") % id_coder.BLOCK != 0) & ~F.col("last")).select("part", "at", "n", "crc", "doc_id", "last")
    ).unionByName(firsts.where(F.col("goes_on").isNull() & ~F.col("last")).select("part", "at", "n", "crc", "doc_id", "last"))

    def join(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        key, at, n, crc = None, 0, 0, 0
        for b in batches:
            rows = []
            for r in b.to_pylist():
                if key != r["part"] or not n:
                    key, at, n, crc = r["part"], r["at"], r["n"], r["crc"]
                else:
                    crc, n = id_coder.combine_crc32(crc, r["crc"], 4 * r["n"]), n + r["n"]
                if r["last"]:
                    rows.append((key, at, n, crc, r["doc_id"]))
                    n = 0
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(list(zip(*rows, strict=True)) or [()] * 5, schema, strict=True)], schema=schema)

    whole = map_arrow(chained.repartition("part").sortWithinPartitions("part", "at"), join, "part bigint, at bigint, n bigint, crc bigint, doc_id bigint")
    found = heads.unionByName(alone).unionByName(whole)
    return found.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))


def round_trip(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    return document_index(write_ids(docs, tokenizer_path))
