"""Spelling variants: frequent words that differ by one code point, found by groups without making pairs.

1. Words. Runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z lower-cased, are counted over all documents; where SLIPS divides the
   crc32 of "<doc_id>:<run>", the run loses its code point crc32 % length. Words of at least SHORTEST code points that occur
   LEAST times or more are the vocabulary.
2. Groups. Each word goes to one group per position, named by the letters before and after that position with a sign between
   them: all its members differ by a replacement at that place. It goes also to the group of each distinct word that it becomes
   by losing a code point, and to its own; so a deletion meets the vocabulary's word of the same letters, if there is one.
3. A group is reduced to its size and its two most frequent words (for the groups of deletions: the vocabulary's word and the
   most frequent longer one). That tells each member how many near words it has there and which is the most frequent; sums over
   a word's groups give the result. Two words are near in one group only, so nothing is counted twice.

A group of replacements holds a word per letter of the alphabet at most (90), one of deletions 90 per position: none is hot,
whatever the input. Rows grow with the vocabulary times its word lengths, not with links.

Forms. A word's form is its near word of largest n (of equals the smallest in code-point order), if that is at least TIMES the
word's own n. So n grows along a chain of forms, which cannot close and has no more links than n can double; roots come by
jumping twice as far in each round.

Defined results: null text has no words; a null doc_id counts as the empty string. Rows that repeat a doc_id count as often as
they stand there. An empty table, or one without frequent words, gives an empty table. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curio.llm.common import docs_of, map_arrow, materialise

SLIPS = 97
SHORTEST, LEAST, TIMES = 5, 3, 2
HELD = 200_000  # words that a task counts before it sends its counts on
_REPLACED, _DELETED, _ITSELF = 0, 1, 2  # why a word is in a group

_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256))


def runs(text: str) -> list[bytes]:
    """The lower-cased runs of a text, a byte for each code point (Latin-1)."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split(b" ")


def tally(doc_id: object, text: str, into: Counter[bytes]) -> None:
    """Adds the words of a document, slips included."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(runs(text)).items():
        if len(run) < SHORTEST:
            continue
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % SLIPS == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < SHORTEST:
                continue
        into[run] += n


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n of all words of SHORTEST code points and LEAST occurrences or more."""

    def run(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def send() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], schema.field(0).type)
            out = pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], schema=schema)
            held.clear()
            return out

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                tally(doc, text, held)
                if len(held) >= HELD:
                    yield send()
        yield send()

    counted = map_arrow(docs_of(docs), run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= LEAST)


def groups(words: DataFrame) -> DataFrame:
    """key, why, word, n: the groups that each word is in."""
    at = words.select("word", "n", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("at"))
    before, after = F.expr("substring(word, 1, at - 1)"), F.expr("substring(word, at + 1)")
    # Of equal neighbouring letters the last is taken away, so that each shorter word comes once.
    shorter = (F.length("word") > SHORTEST) & (F.expr("substring(word, at, 1)") != F.expr("substring(word, at + 1, 1)"))
    replaced = F.struct(F.concat(before, F.lit("*"), after).alias("key"), F.lit(_REPLACED).alias("why"))
    deleted = F.when(shorter, F.struct(F.concat(before, after).alias("key"), F.lit(_DELETED).alias("why")))
    both = at.select("word", "n", F.explode(F.array(replaced, deleted)).alias("g")).where(F.col("g").isNotNull())
    return both.select("g.key", "g.why", "word", "n").unionByName(words.select(F.col("word").alias("key"), F.lit(_ITSELF).alias("why"), "word", "n"))


def near(words: DataFrame) -> DataFrame:
    """word, n, n_near, best_n, best: the number of near words, and the most frequent of them, of every word."""
    order = Window.partitionBy("key").orderBy(F.desc("why"), F.desc("n"), "word")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    other = F.struct((-F.col("n")).alias("m"), F.col("word").alias("w"))
    g = groups(words).select(
        "why", "word", "n", F.row_number().over(order).alias("place"), F.count("*").over(whole).alias("size"),
        F.first("why").over(whole).alias("head"), F.first(other).over(whole).alias("one"), F.nth_value(other, 2).over(whole).alias("two"),
    )
    # A deletion's near word in its group is the vocabulary's, if that is there; other members of it are two steps away.
    met = (F.col("why") != _DELETED) | (F.col("head") == _ITSELF)
    count = F.when(F.col("why") == _DELETED, 1).otherwise(F.col("size") - 1)
    told = g.where(met & ((F.col("size") > 1) | (F.col("why") == _ITSELF))).select("word", "n", count.alias("k"), F.when(F.col("place") == 1, F.col("two")).otherwise(F.col("one")).alias("best"))
    sums = told.groupBy("word").agg(F.max("n").alias("n"), F.sum("k").alias("n_near"), F.min("best").alias("best"))
    return sums.select("word", "n", "n_near", (-F.col("best.m")).alias("best_n"), F.col("best.w").alias("best"))


def roots(forms: DataFrame, rounds: int = 64) -> DataFrame:
    """word, root for (word, form): the last word along the forms."""
    now = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(rounds):
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = materialise(now.select("word", "root").join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
    raise RuntimeError("forms did not settle")


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary."""
    found = near(materialise(vocabulary(docs), "spelling-words"))
    taken = F.col("best_n") >= TIMES * F.col("n")
    words = materialise(found.select("word", "n", "n_near", F.when(taken, F.col("best")).alias("form"), F.when(taken, F.col("best_n")).alias("form_n")), "spelling-near")
    out = words.join(roots(words.where(F.col("form").isNotNull())), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
