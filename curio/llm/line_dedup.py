"""Line deduplication by pairwise alignment.

Lines are compared without surrounding white space; blank ones only separate. What goes is every block of consecutive lines, of
at least `min_words` words together, that an earlier document holds as well, wherever it stands there and in what order.

Partners are found by marks: the shortest runs of lines of at least `min_words` words that start or end at a line. Each line of
a common block lies in a mark within that block, so the earliest holders of a document's marks are all the partners it needs, and
the most common mark costs each document no more than a rare one: pairs grow with (document, mark) incidences, never with the
square of a mark's holders, and none is too common to be used. A later document comes once with all its partners, and each of
these brings only the lines that the two share marks on; both sides of a pair are those lines, in order and with a gap between
runs. So what is sent and aligned grows with a document's own marks, however many partners it has. Each pair is aligned with patience diff (anchors are lines that are unique in both, in longest increasing order, then between anchors). Where
that leaves a line that the earlier document holds (repeated lines, blocks in another order), all longest common blocks are
taken, by a suffix automaton in linear time. Common blocks are deleted from the later document.

Earlier means a smaller doc_id. Line keys are MD5 digests, counted with partial aggregation; the joins on them and on documents may
be hot and are plain sort-merge joins that adaptive execution splits.

Defined results: null or empty text has no lines and stays as it is. Rows with a null doc_id stay as they are. Rows that
repeat a doc_id are not later than each other; each is aligned, by its own lines, with every row of its partners. Repeats within
one document stay, unless an earlier document holds them. An exact copy keeps no line and becomes the empty text; its row stays. Extra columns are kept.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curio.llm.common import byte_column, fresh, map_arrow, materialise

MIN_WORDS = 5


def line_keys(raw: bytes) -> tuple[list[bytes], list[int], list[int]]:
    """Keys, word numbers and line numbers of the lines that are not blank."""
    keys, words, at = [], [], []
    for i, line in enumerate(raw.split(b"\n")):
        s = line.strip()
        if s:
            keys.append(hashlib.md5(s).digest())
            words.append(len(s.split()))
            at.append(i)
    return keys, words, at


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Matching places of two sequences, increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        na, nb = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {x: j for j, x in enumerate(b[b0:b1], b0) if nb[x] == 1}
        pairs = [(i, where[x]) for i, x in enumerate(a[a0:a1], a0) if na[x] == 1 and x in where]
        if not pairs:
            continue
        tails: list[int] = []
        ends: list[int] = []
        back = [-1] * len(pairs)
        for k, (_, j) in enumerate(pairs):
            p = bisect_left(tails, j)
            back[k] = ends[p - 1] if p else -1
            if p == len(tails):
                tails.append(j)
                ends.append(k)
            else:
                tails[p], ends[p] = j, k
        k, chain = ends[-1], []
        while k >= 0:
            chain.append(pairs[k])
            k = back[k]
        i0, j0 = a0, b0
        for i, j in reversed(chain):
            out.append((i, j))
            todo.append((i0, i, j0, j))
            i0, j0 = i + 1, j + 1
        todo.append((i0, a1, j0, b1))
    return sorted(out)


def marks(words: list[int], min_words: int) -> set[tuple[int, int]]:
    """Shortest ranges of lines (end exclusive) of at least min_words words from each line on, and up to each line."""
    least, n = max(1, min_words), len(words)
    upto = [0, *accumulate(words)]
    out, a, b = set(), 0, 0
    for end in range(1, n + 1):
        while upto[end] - upto[a + 1] >= least:
            a += 1
        if upto[end] - upto[a] >= least:
            out.add((a, end))
    for start in range(n):
        while b < n and upto[b] - upto[start] < least:
            b += 1
        if upto[b] - upto[start] >= least:
            out.add((start, b))
    return out


def longest_ends(early: list, late: list) -> list[int]:
    """For each place of late, the length of the longest block ending there that early holds; linear, by a suffix automaton."""
    use = set(late)
    size, link, step = [0], [-1], [{}]

    def copy(p: int, q: int, x) -> int:
        size.append(size[p] + 1)
        link.append(link[q])
        step.append(dict(step[q]))
        link[q] = len(size) - 1
        while p >= 0 and step[p].get(x) == q:
            step[p][x] = link[q]
            p = link[p]
        return link[q]

    last = 0
    for x in early:
        if x not in use:  # no common block goes over this line
            last = 0
            continue
        p, q = last, step[last].get(x)
        if q is not None:
            last = q if size[q] == size[p] + 1 else copy(p, q, x)
            continue
        last = len(size)
        size.append(size[p] + 1)
        link.append(0)
        step.append({})
        while p >= 0 and x not in step[p]:
            step[p][x] = last
            p = link[p]
        if p >= 0:
            q = step[p][x]
            link[last] = q if size[q] == size[p] + 1 else copy(p, q, x)
    out, at, n = [], 0, 0
    for x in late:
        while at and x not in step[at]:
            at = link[at]
            n = size[at]
        if x in step[at]:
            at, n = step[at][x], n + 1
        out.append(n)
    return out


def common_blocks(early: list, late: list, words: list[int], min_words: int) -> list[tuple[int, int]]:
    """Ranges of the later document's lines (end exclusive) in common blocks of at least min_words words."""
    out, run = [], None
    for i, j in [*patience(early, late), (-1, -1)]:
        if run and (i, j) == (run[1], run[2]):
            run = run[0], i + 1, j + 1
            continue
        if run and sum(words[run[0] : run[2]]) >= min_words:
            out.append((run[0], run[2]))
        run = j, i + 1, j + 1
    held, done = set(early), 0
    for a, b in [*out, (len(late), len(late))]:
        if not held.isdisjoint(late[done:a]):
            break
        done = b
    else:
        return out
    ends, upto = longest_ends(early, late), [0, *accumulate(words)]
    last = [j + 1 == len(ends) or ends[j + 1] != n + 1 for j, n in enumerate(ends)]
    return [(j + 1 - n, j + 1) for j, n in enumerate(ends) if n and last[j] and upto[j + 1] - upto[j + 1 - n] >= min_words]


def _own_lines(docs: DataFrame, min_words: int) -> DataFrame:
    """doc_id, keys and words of its lines, and its distinct marks: digest, first line, and, of several lines, their keys."""

    def run(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [line_keys(raw) for raw in byte_column(b.column(1))]
            runs = [[(mark_key(k[x:y]), x, None if y - x == 1 else b"".join(k[x:y])) for x, y in sorted(marks(w, min_words), reverse=True)] for k, w, _ in got]
            held = [[{"key": key, "at": x, "run": run} for key, (x, run) in {key: (x, run) for key, x, run in r}.items()] for r in runs]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), *(pa.array(v, f.type) for v, f in zip(([k for k, _, _ in got], [w for _, w, _ in got], held), list(schema)[1:]))], schema=schema)

    d = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return map_arrow(d, run, "doc_id bigint, keys array<binary>, words array<int>, marks array<struct<key:binary,at:int,run:binary>>")


def restricted(lines: dict[int, bytes], gap: bytes | None) -> tuple[list, list[int]]:
    """Chosen lines of a document in order, with a gap where lines between them are left out; and each one's line number."""
    out: list = []
    places: list[int] = []
    for at in sorted(lines):
        if places and at > places[-1] + 1:
            out.append(gap)
            places.append(places[-1])
        out.append(lines[at])
        places.append(at)
    return out, places


def mark_key(keys: list[bytes]) -> bytes:
    """Digest of a mark: of one line its key, of several that of all keys."""
    return keys[0] if len(keys) == 1 else hashlib.md5(b"".join(keys)).digest()


def aligned(shared: list[dict], keys: list[bytes], words: list[int], min_words: int) -> dict[int, list[tuple[int, int]]]:
    """For each partner the ranges of the later document's lines in common blocks.

    shared: partner, digest of a mark, and its place and lines in the partner; keys, words: of the later document's lines.
    """
    places: dict[bytes, list[tuple[int, int]]] = {}
    for x, y in marks(words, min_words):
        places.setdefault(mark_key(keys[x:y]), []).append((x, y))
    sides: dict[int, tuple[dict[int, bytes], dict[int, bytes]]] = {}
    for m in shared:
        early, late = sides.setdefault(m["first"], ({}, {}))
        run = m["run"] or m["key"]
        early.update((m["at"] + i // 16, run[i : i + 16]) for i in range(0, len(run), 16))
        late.update((i, keys[i]) for x, y in places.get(m["key"], ()) for i in range(x, y))
    out = {}
    for partner, (early, late) in sides.items():
        lines, at = restricted(late, b"")  # another gap than the early side's: gaps never match
        found = common_blocks(restricted(early, None)[0], lines, [words[i] if x else 0 for i, x in zip(at, lines, strict=True)], min_words)
        if found:
            out[partner] = [(at[a], at[b - 1] + 1) for a, b in found]
    return out


def removals(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, partners, ranges of non-blank line numbers to delete; only documents that lose lines."""
    own = materialise(_own_lines(docs, min_words), "line-keys")
    held = own.select("doc_id", F.explode("marks").alias("m"))
    firsts = held.groupBy("m.key").agg(F.min(F.struct("doc_id", "m.at", "m.run")).alias("first"), F.max("doc_id").alias("last")).where("first.doc_id < last").select("key", "first")
    firsts = materialise(firsts, "line-firsts")  # read back, both sides of the join are exchanged, so that hot marks can be split
    shared = held.select("doc_id", "m.key").join(firsts, "key").where("first.doc_id < doc_id").select("doc_id", "key", F.col("first.doc_id").alias("first"), "first.at", "first.run")
    partners = shared.groupBy("doc_id").agg(F.collect_list(F.struct("first", "key", "at", "run")).alias("shared"))  # a later document's distinct marks at most
    both = partners.join(own.drop("marks"), "doc_id")

    def align(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, shared, k, w in zip(*(c.to_pylist() for c in b.columns), strict=True):
                cuts = aligned(shared, k, w, min_words)
                if cuts:
                    ranges = sorted({r for own in cuts.values() for r in own})
                    rows.append((doc, hashlib.md5(b"".join(k)).digest(), sorted(cuts), [{"a": x, "b": y} for x, y in ranges]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return map_arrow(both.select("doc_id", "shared", "keys", "words"), align, "doc_id bigint, own binary, partners array<bigint>, cuts array<struct<a:int,b:int>>")


def cut_text(raw: bytes, own: bytes, cuts: list[dict]) -> tuple[bytes, int, int]:
    """The text without the ranges, the number of lines and of words that went; unchanged where the lines are not those meant."""
    keys, words, at = line_keys(raw)
    if hashlib.md5(b"".join(keys)).digest() != own:
        return raw, 0, 0
    lines = raw.split(b"\n")
    gone: set[int] = set()
    n = lost = 0
    done = 0
    for c in cuts:
        a, b = max(c["a"], done), c["b"]
        if a < b:
            n, lost, done = n + b - a, lost + sum(words[a:b]), b
        gone.update(range(at[c["a"]], at[c["b"] - 1] + 1))  # blank lines within a block go with it
    return b"\n".join([x for i, x in enumerate(lines) if i not in gone]), n, lost


def dedup(docs: DataFrame, min_words: int = MIN_WORDS, report: bool = False, keep_emptied: bool = True) -> DataFrame:
    """docs with shortened texts; with report also lines_removed, words_removed, partners.

    Without keep_emptied, rows that lost lines and have only blank ones left go.
    """
    cols = docs.columns
    cuts = removals(docs, min_words).groupBy("doc_id").agg(F.collect_list(F.struct(F.col("own").alias("_own"), F.col("cuts").alias("_cuts"), F.col("partners").alias("_partners"))).alias("alls"))
    cuts = cuts.select(F.struct("doc_id", "alls").alias(extra := fresh("cuts", cols)))  # one column, of a name that docs has not
    joined = docs.join(cuts, F.col("doc_id") == F.col(f"{extra}.doc_id"), "left").select(*[F.col(f"`{c}`") for c in cols], F.col(f"{extra}.alls").alias(extra))
    at = cols.index("text")

    def run(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, lines, words, partners, stays = [], [], [], [], []
            nulls = b.column(at).is_null().to_pylist()
            for raw, null, alls in zip(byte_column(b.column(at)), nulls, b.column(len(cols)).to_pylist(), strict=True):
                new, n, w, own = raw, 0, 0, []
                for x in alls or []:
                    new, n, w = cut_text(raw, x["_own"], x["_cuts"])
                    if n:
                        own = x["_partners"]
                        break
                texts.append(None if null else new)
                stays.append(keep_emptied or not n or bool(new.strip()))
                lines.append(n)
                words.append(w)
                partners.append(own)
            out = [c.cast(f.type) if c.type != f.type else c for c, f in zip(b.columns[: len(cols)], schema)]
            out[at] = pa.array(texts, pa.binary()).cast(schema.field(at).type)
            if report:
                out += [pa.array(lines, pa.int64()), pa.array(words, pa.int64()), pa.array(partners, schema.field(len(cols) + 2).type)]
            whole = pa.RecordBatch.from_arrays(out, schema=schema)
            yield whole if keep_emptied else whole.filter(pa.array(stays, pa.bool_()))

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import ArrayType, LongType, StructType

    want = StructType(list(docs.schema.fields))
    if report:
        want = want.add("lines_removed", LongType()).add("words_removed", LongType()).add("partners", ArrayType(LongType()))
    arrow = to_arrow_schema(want)
    return joined.mapInArrow(lambda it: run(it, arrow), want)


def report(docs: DataFrame) -> DataFrame:
    """Per document: line and word numbers that went, the earlier documents they are in, and the new text's digest."""
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = dedup(slim, report=True)
    text = F.coalesce("text", F.lit(""))
    return out.select("doc_id", "lines_removed", "words_removed", "partners", F.octet_length(text).cast("bigint").alias("n_bytes"), F.sha2(text, 256).alias("text_sha256"))
