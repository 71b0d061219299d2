"""Token counts without token ids.

Pre-tokens of a SentencePiece BPE model: no piece of the model holds a blank behind another character, or a line feed next to
anything, so merges never cross the place before a blank or around a line feed, and a text's count is the sum over its
pre-tokens (checked when the model is loaded; other models raise).

1. Pre-token frequencies of all texts are pre-aggregated in each task and summed; the FREQUENT most frequent pre-tokens are
   counted at once and broadcast. This dictionary has a fixed number of entries of a bounded length whatever the input: long
   pre-tokens stand in it under their digest, with the number of pieces that the task that saw them counted.
2. Each document's own frequencies: known pre-tokens are summed where they are, the others go out as (pre-token, document,
   frequency). They are dealt by pre-token, each distinct one is counted once, joined to its frequencies there, and summed per
   document before the rows are dealt by document. A pre-token of any length that is too frequent for one task is in the
   dictionary of step 1, unless no task holds it twice; then each task sends one row of it at most.

Defined results: null or empty text has no tokens. Rows with null or equal keys stay apart, each with its own counts. Special
strings in texts are ordinary text, as the library takes control symbols. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curio.llm.common import byte_column, docs_of, map_arrow

LIMIT = 4096
FREQUENT = 200_000
NAMED_BYTES = 64  # longer pre-tokens stand in the dictionary under their digest
BLANK = "▁".encode()
TABLE_ENTRIES = 500_000  # of a task's tables, before they are sent on or emptied


@lru_cache(maxsize=2)
def counter(path: str):
    """Function of a list of pre-tokens (UTF-8) that gives their numbers of pieces."""
    from curio.llm.tokens import piece_model

    sp = piece_model(path)
    for i in range(sp.vocab_size()):
        p = sp.id_to_piece(i)
        if "▁" in p.lstrip("▁") or ("\n" in p and len(p) > 1):
            raise ValueError("a piece crosses pre-tokens; this model cannot be counted by pre-token")
    nl = len(sp.encode("\n")) - 1
    if [len(sp.encode(x)) for x in ("a\nb", " a", "  a")] != [3, 2, 2] or nl != 1:
        raise ValueError("this model's normalisation differs from the expected one")

    def count(parts: list[bytes]) -> list[int]:
        # The library puts a blank before each text: it stands for a pre-token's own first blank, or behind it a line feed
        # makes a boundary, whose two pieces (blank, line feed) are taken off again.
        texts = [p[1:].decode() if p[:1] == b" " else "\n" + p.decode() for p in parts]
        got = sp.encode(texts, num_threads=1)
        out = []
        for p, t, ids in zip(parts, texts, got, strict=True):
            if p == b" ":
                out.append(1)
            elif t[:1] == "\n":
                out.append(len(ids) - 2)
            else:
                out.append(len(ids))
        return out

    return count


def split(raw: bytes) -> tuple[list[bytes], int]:
    """Pre-tokens of a text and its number of line feeds. Runs of blanks stay with what follows them."""
    if not raw:
        return [], 0
    if BLANK in raw:  # the model's own sign for a blank is one in texts, too
        raw = raw.replace(BLANK, b" ")
    lines = (b" " + raw).split(b"\n")
    out: list[bytes] = []
    for line in lines:
        if b"  " in line or line[-1:] == b" ":
            out += _runs(line)
        elif line[:1] == b" ":
            parts = line.split(b" ")
            out += [b" " + p for p in parts[1:]]
        elif line:
            parts = line.split(b" ")
            out.append(parts[0])
            out += [b" " + p for p in parts[1:]]
    return out, len(lines) - 1


def _runs(line: bytes) -> list[bytes]:
    out, blanks = [], 0
    for i, p in enumerate(line.split(b" ")):
        blanks += i > 0
        if p:
            out.append(b" " * blanks + p)
            blanks = 0
    if blanks:
        out.append(b" " * blanks)
    return out


def entry(part: bytes) -> bytes:
    """What a pre-token is called in the dictionary: itself, or a digest that is too long for a name."""
    return part if len(part) <= NAMED_BYTES else b"#" * (NAMED_BYTES - 15) + hashlib.md5(part).digest()


def frequent(docs: DataFrame, model_path: str, most: int = FREQUENT) -> dict[bytes, int]:
    """Entries of the most frequent pre-tokens over all documents, with their numbers of pieces."""

    def tally(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        table: Counter[bytes] = Counter()
        for b in batches:
            for raw in byte_column(b.column(1)):
                table.update(split(raw)[0])
                if len(table) > TABLE_ENTRIES:
                    yield send(table, schema)
                    table = Counter()
        yield send(table, schema)

    def send(table: Counter, schema: pa.Schema) -> pa.RecordBatch:
        own = [(k, n) for k, n in table.items() if n > 1]  # a dictionary of single uses would save nothing
        long = [k for k, _ in own if len(k) > NAMED_BYTES]
        pieces = dict(zip(long, counter(model_path)(long), strict=True)) if long else {}
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(([entry(k) for k, _ in own], [n for _, n in own], [pieces.get(k) for k, _ in own]), schema, strict=True)], schema=schema)

    sums = map_arrow(docs, tally, "part binary, n bigint, pieces bigint").groupBy("part").agg(F.sum("n").alias("n"), F.max("pieces").alias("pieces"))
    top = [(bytes(r.part), r.pieces) for r in sums.orderBy(F.desc("n"), "part").limit(most).select("part", "pieces").collect()]
    short = [k for k, n in top if n is None]
    return dict(zip(short, counter(model_path)(short), strict=True)) | {k: n for k, n in top if n is not None}


def count_tokens(docs: DataFrame, model_path: str, limit: int = LIMIT, most: int = FREQUENT) -> DataFrame:
    d = docs_of(docs)
    known = d.sparkSession.sparkContext.broadcast(frequent(d, model_path, most))

    def own(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        table, row = known.value, TaskContext.get().partitionId() << 40  # rows are numbered: doc_id may repeat or be null
        for b in batches:
            rows: list[tuple] = []
            for doc, raw in zip(b.column(0).to_pylist(), byte_column(b.column(1)), strict=True):
                parts, feeds = split(raw)
                counts = list(map(table.get, parts))
                total = feeds
                if None in counts:
                    for p, n in Counter([p for p, c in zip(parts, counts, strict=True) if c is None]).items():
                        pieces = table.get(entry(p)) if len(p) > NAMED_BYTES else None
                        if pieces is None:
                            rows.append((row, None, p, n, 0, 0))
                        else:
                            total += n * pieces
                    total += sum(filter(None, counts))
                else:
                    total += sum(counts)
                rows.append((row, doc, None, 1, total, len(raw)))
                row += 1
                if len(rows) > 100_000:
                    yield _batch(rows, schema)
                    rows = []
            if rows:
                yield _batch(rows, schema)

    def resolve(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        count, seen = counter(model_path), {}
        for b in batches:
            parts, n, tokens = (b.column(i).to_pylist() for i in (2, 3, 4))
            if len(seen) > TABLE_ENTRIES:
                seen.clear()
            new = list({p for p in parts if p is not None and p not in seen})
            seen.update(zip(new, count(new), strict=True))
            made = [t if p is None else k * seen[p] for p, k, t in zip(parts, n, tokens, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(made, pa.int64()), b.column(5)], schema=schema)

    def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(list(zip(*rows, strict=True)) or [()] * len(schema), schema, strict=True)], schema=schema)

    rows = map_arrow(d, own, "row bigint, doc_id bigint, part binary, n bigint, tokens bigint, bytes bigint")
    dealt = rows.repartition(F.when(F.col("part").isNull(), F.xxhash64("row")).otherwise(F.xxhash64("part")))
    sums = map_arrow(dealt, resolve, "row bigint, doc_id bigint, tokens bigint, bytes bigint")
    sums = sums.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sum("bytes").alias("n_bytes"), F.sum("tokens").alias("n_tokens"))
    return sums.drop("row").withColumn("over_limit", F.col("n_tokens") > limit)
