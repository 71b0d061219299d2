"""Fill-in-the-middle transformation on ropes.

A text becomes a rope of lines (rope.py). Two unit ranks, drawn by a keyed hash of doc_id, cut its tree into prefix, middle and
suffix; the subtrees are joined anew with sentinels between them, as psm (prefix, suffix, middle) or spm (suffix, prefix,
middle). The inverse cuts the output's tree behind and before the sentinels and joins the three parts in their old order. A text
that holds a sentinel stays plain, so each sentinel of an output stands exactly once.

Draws: h1 to h4 are the first four groups of 8 digits of the hex sha256 of "<seed>:<doc_id>", as unsigned numbers. Prefix ends
after the smaller of h1 % (n + 1) and h2 % (n + 1) of n units, middle after the larger; h3 % 100 below RATE transforms,
h4 % 100 below SPM makes it spm.

Defined results: null text is empty, empty text is plain. A null doc_id draws as the empty string. Rows with equal doc_id draw
alike, and stay apart. Texts of any length are one row each. An empty table gives an empty one. Extra columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curio.llm import rope
from curio.llm.common import docs_of, map_arrow, materialise

PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
SEED, RATE, SPM = 7, 100, 50


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def rearrange(text: str, h: list[int], rate: int = RATE, spm: int = SPM) -> tuple[str, rope.Rope, rope.Rope, rope.Rope, rope.Rope]:
    """(form, output, whole text, prefix, middle)."""
    whole = rope.build(text)
    n = whole.units
    if not text or h[2] % 100 >= rate or any(m in text for m in MARKS):
        return "plain", whole, whole, rope.EMPTY, rope.EMPTY
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    head, suffix = rope.split_units(whole, second)
    prefix, middle = rope.split_units(head, first)
    part = {PREFIX: prefix, SUFFIX: suffix, MIDDLE: middle}
    form = "spm" if h[3] % 100 < spm else "psm"
    out = rope.EMPTY
    for mark in ORDERS[form]:
        out = rope.concat(rope.concat(out, rope.leaf(mark, 0)), part[mark])
    return form, out, whole, prefix, middle


def restore(output: str, form: str) -> rope.Rope:
    """The text before its rearrangement."""
    rest = rope.build(output)
    if form == "plain":
        return rest
    part: dict[str, rope.Rope] = {}
    for mark in reversed(ORDERS[form]):
        at = rope.find(rest, mark)
        if at < 0:
            raise ValueError(f"an output of form {form} without {mark}")
        rest, tail = rope.split_chars(rest, at)
        part[mark] = rope.split_chars(tail, len(mark))[1]
    if rest.chars:
        raise ValueError(f"an output of form {form} that does not begin with a sentinel")
    return rope.concat(rope.concat(part[PREFIX], part[MIDDLE]), part[SUFFIX])


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (null where plain), output."""

    def run(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                form, out, whole, prefix, middle = rearrange(text, draws(doc, seed), rate, spm)
                plain = form == "plain"
                rows.append((doc, whole.units, form, None if plain else prefix.chars, None if plain else middle.chars, str(out)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows, strict=True)) or [()] * len(schema), schema, strict=True)], schema=schema)

    return map_arrow(docs_of(docs), run, f"doc_id {dict(docs.dtypes)['doc_id']}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def invert(transformed: DataFrame) -> DataFrame:
    """The columns of transform(), and the text rebuilt from output and form alone."""

    def run(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [str(restore(o, f)) for o, f in zip(b.column(5).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(b.columns, schema)), pa.array(texts, schema.field("text").type)], schema=schema)

    d = transformed.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    return map_arrow(d, run, ", ".join(f"{n} {t}" for n, t in d.dtypes) + ", text string")


def report(docs: DataFrame) -> DataFrame:
    """Writes the transformed texts, reads them back, inverts them and gives the digests of both."""
    d = invert(materialise(transform(docs), "fill-middle"))
    return d.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256"))


ORACLE = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), drawn AS (
  SELECT *, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 100 THEN 'plain'
         WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM units
), cut AS (
  SELECT *, array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(u[greatest(a, b) + 1:n], '') AS s
  FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut
"""
