"""Bounded-space online packing of token sequences.

Each partition keeps at most `open_windows` windows open. A document's whole windows are emitted at once; its rest goes to the
open window that it fits best. When none fits, a new window is opened, or, with all of them open, the fullest is filled with
the head of the rest and emitted, and the tail is placed again. What is still open at a partition's end is written with its
ids, and the leftovers of MERGE partitions at a time are merged into further windows, so only the last window of each merge
group is padded. No id is lost, doubled or reordered within its document.

Memory is bounded by one Arrow batch, open_windows * window ids and, in a merge, MERGE times that. Sequence ids are
(partition << 32 | n), and (2**30 + group) << 32 | n for merged ones.

Defined results: null or empty text is a document of the end id alone. Equal rows are packed each. Null doc_id stays null. An
empty table has no pieces. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curio.llm.common import docs_of, map_arrow, materialise

WINDOW = 2048
OPEN_WINDOWS = 16
MERGE = 32  # partitions whose leftovers are merged by one task
END_ID = 1
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary, leftover boolean, part bigint"
RESULT = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


class Packer:
    """Places pieces (doc_id, start, ids, doc_tokens) in windows; emitted rows gather in `rows`."""

    def __init__(self, first_sequence: int, window: int, open_windows: int, keep_ids: bool):
        self.window, self.most, self.keep = window, open_windows, keep_ids
        self.next, self.rows = first_sequence, []
        self.open: list[list] = []  # [used, [(piece, offset)]]

    def _emit(self, pieces: list, leftover: bool = False) -> None:
        for (doc, start, ids, total), offset in pieces:
            self.rows.append((doc, start, len(ids) // 4, zlib.crc32(ids), total, self.next, offset, ids if leftover or self.keep else None, leftover))
        self.next += 1

    def add(self, doc, start: int, ids: bytes, total: int) -> None:
        size = self.window
        n = len(ids) // 4
        whole = n // size
        for i in range(0, whole * size, size):
            self._emit([((doc, start + i, ids[4 * i : 4 * (i + size)], total), 0)])
        start, ids, n = start + whole * size, ids[4 * whole * size :], n % size
        while n:
            fits = [w for w in self.open if size - w[0] >= n]
            if fits:
                w = max(fits, key=lambda x: x[0])
                head = n
            elif len(self.open) < self.most:
                self.open.append(w := [0, []])
                head = n
            else:
                w = max(self.open, key=lambda x: x[0])
                head = size - w[0]
            w[1].append(((doc, start, ids[: 4 * head], total), w[0]))
            w[0] += head
            start, ids, n = start + head, ids[4 * head :], n - head
            if w[0] == size:
                self._emit(w[1])
                self.open.remove(w)

    def close(self, leftover: bool) -> None:
        for _, pieces in self.open:
            self._emit(pieces, leftover)
        self.open = []

    def batch(self, part: int, schema: pa.Schema) -> pa.RecordBatch:
        cols = list(zip(*self.rows, strict=True)) or [()] * 9
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip([*cols, [part] * len(cols[0])], schema, strict=True)], schema=schema)


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, open_windows: int = OPEN_WINDOWS, with_ids: bool = False) -> DataFrame:
    """One row per piece; `ids` (little-endian unsigned 32-bit) is filled for all pieces if with_ids."""

    def place(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        from curio.llm.tokens import word_encoder

        enc, part = word_encoder(tokenizer_path), TaskContext.get().partitionId()
        packer = Packer(part << 32, window, open_windows, with_ids)
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = enc.ids(text) + END_ID.to_bytes(4, "little")
                packer.add(doc, 0, ids, len(ids) // 4)
            yield packer.batch(part, schema)
        packer.close(True)
        yield packer.batch(part, schema)

    placed = materialise(map_arrow(docs_of(docs), place, PIECES), "pack")
    rest = placed.where("leftover")
    parts = rest.select(F.max("part")).first()[0]
    groups = 1 if parts is None else -(-(parts + 1) // MERGE)

    def merge(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        packer, now = None, None
        for b in batches:
            for r in b.to_pylist():
                if r["group"] != now:
                    if packer:
                        packer.close(False)
                    now = r["group"]
                    fresh = Packer(((1 << 30) + now) << 32, window, 1, with_ids)
                    fresh.rows = packer.rows if packer else []
                    packer = fresh
                packer.add(r["doc_id"], r["start"], r["ids"], r["doc_tokens"])
            yield packer.batch(-1, schema)
        if packer:
            packer.close(False)
            yield packer.batch(-1, schema)

    grouped = rest.withColumn("group", F.pmod("part", F.lit(groups))).repartition(groups, "group").sortWithinPartitions("group", "sequence_id", "offset")
    merged = map_arrow(grouped, merge, PIECES)
    out = placed.where(~F.col("leftover")).unionByName(merged)
    return out.select(*RESULT, *(["ids"] if with_ids else []))


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """Sequences from pieces with ids: sequence_id, n_ids, ids as little-endian unsigned 32-bit numbers.

    They are padded to `window` ids, but for those whose number of ids is a power of two.
    """
    joined = F.aggregate(F.array_sort(F.collect_list(F.struct("offset", "ids"))), F.unhex(F.lit("")), lambda acc, x: F.concat(acc, x["ids"]))
    g = pieces.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("n_ids"))
    lacking = F.when(F.bit_count("n_ids") == 1, 0).otherwise(F.lit(window) - F.col("n_ids"))
    pad = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), lacking.cast("int")))
    return g.select("sequence_id", "n_ids", F.concat("ids", pad).alias("ids"))
