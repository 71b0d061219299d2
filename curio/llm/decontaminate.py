"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark windows.

Words are maximal runs of bytes outside \\x00-\\x2F, \\x3A-\\x60, \\x7B-\\x7F after lower-casing A-Z, so UTF-8 letters of any
script belong to words. A window is `width` consecutive words of an item; an item of fewer words, but at least one, is one
window. Each text is scanned once; a match is mapped back to word numbers and to character offsets of the original.

The automaton reads words, not letters: each word of the benchmark has a code of two signs (three beyond 65,536 words), the first
from another alphabet than the last, so that matches begin and end with words; all other words share a code that no window has.

Distinct windows with their items are made by Spark, and the memory that their automaton takes is estimated before any is
collected, from NODE_BYTES as measured. Up to MAX_AUTOMATON_BYTES in each Python worker they make one automaton. Beyond it they are
dealt out by hash to several, of which the driver holds one at a time: numbered rows are scanned by each, the hits are written,
and each row's hits by all of them are merged as within one automaton, so the result is the same.

Defined results: null or empty text has no words and is clean. Null item text has no windows, and a null item_id no item. Equal
windows of several items count for each item. Rows that repeat a document are scanned and returned each. An empty benchmark
hits nothing; an empty table of documents gives no rows. Extra columns are ignored; ties do not arise.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curio.llm.common import byte_column, docs_of, map_arrow, materialise

WIDTH = 10
MAX_AUTOMATON_BYTES = 384 << 20  # of one automaton in a Python worker
NODE_BYTES = {2: 100, 3: 145}  # measured: memory for each word of a window, by signs of a word's code
ITEM_BYTES = 80  # of an item's name in a window, beside its letters

_KEEP = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
NORMAL = bytes(b if b in _KEEP else (b + 32 if 0x41 <= b <= 0x5A else 0x20) for b in range(256))


Windows = tuple[tuple[bytes, tuple[str, ...]], ...]  # window and the items that hold it


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(NORMAL).split()


def windows_of(raw: bytes, width: int = WIDTH) -> set[bytes]:
    w = words_of(raw)
    if not w:
        return set()
    return {b" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))}


class Scanner:
    """The automaton of some windows, with the codes of their words."""

    def __init__(self, windows: Windows):
        import ahocorasick

        names = sorted({x for w, _ in windows for x in w.split(b" ")})
        self.signs = 2 if len(names) <= 1 << 16 else 3
        base = 1 + int(len(names) ** (1 / self.signs))
        while base**self.signs < len(names):
            base += 1
        # Alphabets begin at U+10000, with room for 100,000 signs each.
        self.code = {x: "".join(chr(0x10000 + 100_000 * k + i // base**k % base) for k in range(self.signs)) for i, x in enumerate(names)}
        self.other = " " * self.signs
        self.automaton = ahocorasick.Automaton()
        for w, items in windows:
            words = w.split(b" ")
            self.automaton.add_word("".join(map(self.code.__getitem__, words)), (len(words), tuple(items)))
        if windows:
            self.automaton.make_automaton()

    def find(self, words: list[bytes]) -> Iterator[tuple[int, int, tuple[str, ...]]]:
        """(first, end, items) of every window that occurs."""
        if self.code and words:
            line = "".join(map(self.code.get, words, repeat(self.other)))
            for at, (n, items) in self.automaton.iter(line):
                end = (at + 1) // self.signs
                yield end - n, end, items


@lru_cache(maxsize=1)
def _scanner(key: str, windows: Windows) -> Scanner:
    return Scanner(windows)


def scan(raw: bytes, scanner: Scanner) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, hit ranges of word numbers (end exclusive, merged), and items that occur."""
    words = words_of(raw)
    found: list[tuple[int, int]] = []
    items: set[str] = set()
    for first, end, own in scanner.find(words):
        found.append((first, end))
        items.update(own)
    merged: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return len(words), merged, items


def char_spans(raw: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets in the original text of ranges of word numbers."""
    if not ranges:
        return []
    flat = raw.translate(NORMAL)
    starts, ends, at = [], [], 0
    for w in flat.split():
        at = flat.index(w, at)
        starts.append(at)
        at += len(w)
        ends.append(at)
    chars = lambda byte: len(raw[:byte].decode("utf-8", "replace"))
    return [(chars(starts[a]), chars(ends[b - 1])) for a, b in ranges]


def _windows(benchmark: DataFrame, width: int) -> tuple[DataFrame, int]:
    """(window, items), each window once; and the number of automata that they need."""

    def run(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(w, k) for k, raw in zip(b.column(0).to_pylist(), byte_column(b.column(1)), strict=True) for w in windows_of(raw, width)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(list(zip(*rows, strict=True)) or [()] * 2, schema, strict=True)], schema=schema)

    items = benchmark.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string").alias("k"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    w = map_arrow(items, run, "window binary, item string").groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items"))
    w = materialise(w, "decontaminate-windows")
    own = F.split(F.decode("window", "ISO-8859-1"), " ")
    names = F.aggregate("items", F.lit(0).cast("long"), lambda a, x: a + F.octet_length(x) + ITEM_BYTES)
    words, items_size = w.select(F.sum(F.size(own).cast("long")), F.sum(names)).first()
    distinct = w.select(F.explode(own)).distinct().count()
    size = (words or 0) * NODE_BYTES[2 if distinct <= 1 << 16 else 3] + (items_size or 0)
    return w, max(1, -(-size // MAX_AUTOMATON_BYTES))


def _block(windows: DataFrame, i: int, n: int) -> Windows:
    """One of n parts of the windows, for an automaton of about MAX_AUTOMATON_BYTES at most."""
    part = windows if n == 1 else windows.where(F.pmod(F.xxhash64("window"), F.lit(n)) == i)
    t = part.select("window", "items").toArrow()
    return tuple(sorted((w, tuple(i)) for w, i in zip(t.column(0).to_pylist(), t.column(1).to_pylist(), strict=True)))


SCHEMA = "doc_id bigint, n_words bigint, hits array<struct<first:bigint,last:bigint>>, items array<string>, spans array<struct<start:bigint,end:bigint>>"


def find_hits(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, spans: bool = True) -> DataFrame:
    """Per document: n_words, hit ranges of word numbers, items found, and character spans in the original text."""
    windows, n = _windows(benchmark, width)
    if n == 1:
        return _scan_block(docs_of(docs), _block(windows, 0, 1), spans)[0]
    rows = docs_of(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    rows = materialise(rows, "decontaminate-rows")  # the same numbers for each automaton; doc_id may repeat or be null
    both = None
    for i in range(n):
        scanned, shared = _scan_block(rows, _block(windows, i, n), spans)
        scanned = materialise(scanned, "decontaminate-hits")
        shared.destroy()
        both = scanned if both is None else both.unionByName(scanned)
    found = both.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.collect_list(F.struct("hits", "items", "spans")).alias("found"))
    return map_arrow(found.select("doc_id", "n_words", "found"), _merge, SCHEMA)


def _merge(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row's hits by several automata as by one: ranges that overlap or touch become one, and their spans with them."""
    for b in batches:
        hits, names, where = [], [], []
        for found in b.column(2).to_pylist():
            merged: list[tuple[dict, dict]] = []
            pairs = [p for f in found for p in zip(f["hits"], f["spans"] or [{}] * len(f["hits"]), strict=True)]
            for h, s in sorted(pairs, key=lambda p: (p[0]["first"], p[0]["last"])):
                if merged and h["first"] <= merged[-1][0]["last"] + 1:
                    if h["last"] > merged[-1][0]["last"]:
                        merged[-1][0]["last"] = h["last"]
                        merged[-1][1].update(end=s.get("end"))
                else:
                    merged.append((dict(h), dict(s)))
            hits.append([h for h, _ in merged])
            where.append([s for _, s in merged if "start" in s])
            names.append(sorted({k for f in found for k in f["items"]}))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(v, type=f.type) for v, f in zip((hits, names, where), list(schema)[2:]))], schema=schema)


def _scan_block(docs: DataFrame, windows: Windows, spans: bool) -> tuple[DataFrame, Broadcast]:
    """One automaton's hits in the text, the last column (those before it are whole numbers and are kept), and its broadcast."""
    key, shared = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(windows)

    def run(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        a = _scanner(key, shared.value)
        for b in batches:
            n, hits, names, where = [], [], [], []
            for raw in byte_column(b.columns[-1]):
                k, ranges, own = scan(raw, a)
                n.append(k)
                hits.append([{"first": x, "last": y - 1} for x, y in ranges])
                names.append(sorted(own))
                where.append([{"start": x, "end": y} for x, y in char_spans(raw, ranges)] if spans else [])
            yield pa.RecordBatch.from_arrays([*(c.cast(pa.int64()) for c in b.columns[:-1]), *(pa.array(v, type=f.type) for v, f in zip((n, hits, names, where), list(schema)[-4:]))], schema=schema)

    return map_arrow(docs, run, SCHEMA if len(docs.columns) == 2 else f"row bigint, {SCHEMA}"), shared


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The per-document contamination report (digest columns of find_hits)."""
    size = F.aggregate("hits", F.lit(0).cast("bigint"), lambda acc, h: acc + h["last"] - h["first"] + 1)
    h = find_hits(docs, benchmark, spans=False)
    return h.select(
        "doc_id", "n_words", size.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents in which no benchmark window occurs, with all their columns.

    Rows are kept or dropped where they are read: each automaton takes one Arrow pass over whole rows, without a join.
    """
    windows, n = _windows(benchmark, WIDTH)
    schema = docs.schema
    at = docs.columns.index("text")
    for i in range(n):
        key, shared = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(_block(windows, i, n))

        def run(batches: Iterator[pa.RecordBatch], key=key, shared=shared) -> Iterator[pa.RecordBatch]:
            a = _scanner(key, shared.value)
            for b in batches:
                yield b.filter(pa.array([not scan(raw, a)[1] for raw in byte_column(b.column(at))], type=pa.bool_()))

        docs = docs.mapInArrow(run, schema)
        if n > 1:  # one part of the windows at a time
            docs = materialise(docs, "decontaminate-kept")
            shared.destroy()
    return docs


_SQL_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLE = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents), b AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), {WIDTH}) AS n, array_to_string(w[i:i + least(len(w), {WIDTH}) - 1], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WIDTH}, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
g AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
h AS (SELECT doc_id, item_id, i, n FROM g JOIN win USING (g, n)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id
"""
