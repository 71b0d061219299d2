"""Quality rules by weak supervision.

1. Rules. Each looks at a whole text and votes good, bad, or abstains (RULES). Base counts that contracts ask for are taken in the
   same pass: code points in words, symbols, repeated lines, words in repeated windows of three.
2. Label model. How often each combination of votes occurs is counted over all documents (at most 3**len(RULES) rows go to the
   driver, whatever the input). Expectation maximisation estimates for each rule how likely it votes each way on good and on bad
   documents, and how many documents are good, without labels. Votes are taken to be independent within a class; abstaining
   tells nothing, and a vote never counts against what it says.
3. Posterior. The probability that a document is good, given all its votes, replaces the filter that all rules must pass: a
   document is kept from KEEP on, unless it fails the base.

Words are maximal runs outside \\x20 and \\x09-\\x0D. A line is one of the parts between line feeds; those without a word are no
repeats. The base fails documents of under 50 words, or of which over half the words stand in repeated windows.

Defined results: null text has no words and fails the base. Rows with equal doc_id, or without one, stay apart. Texts of any
length are one row each. An empty table gives an empty one. report() ignores extra columns; keep_good() returns all columns.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curio.llm.common import docs_of, map_arrow, materialise

LEAST_WORDS, MOST_REPEATED = 50, 0.5
KEEP = 0.5
GOOD, ABSTAIN, BAD = 2, 1, 0  # digits of a vote
PRIOR = ((0.3, 0.25, 0.45), (0.02, 0.23, 0.75))  # how a rule votes on bad and on good documents: bad ones fail some rules only
WEIGHT = 0.02  # share of all documents that the prior counts for
SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\x0b\x0c\r"
_NO_SYMBOL = bytes(b for b in range(256) if chr(b) not in SYMBOLS + _BLANKS)
_UPPER = bytes(set(range(256)) - set(range(0x41, 0x5B)))
_DIGITS = bytes(set(range(256)) - set(range(0x30, 0x3A)))
_NO_LETTER = bytes(b for b in range(0x21, 0x80) if not chr(b).isalpha())  # bytes from 0x80 on count as letters
_END = re.compile(rb"[.!?][\"')\]]*(?![^\x20\x09-\x0D])")
# Frequent function words of several languages.
FUNCTION_WORDS = frozenset(
    w.encode() for w in "the of and to in is that it for was with as be on by this are or an at from le la les de des du et un une que qui dans pour pas der die das und den ist von mit zu im ein eine nicht el los las del y en por con una se no su para".split()
)


@dataclass(frozen=True)
class Facts:
    """What the rules look at."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_lines: int
    n_dup_lines: int
    n_repeat_words: int
    n_symbol_words: int
    n_letter_words: int
    n_echoes: int  # words equal to the one before
    n_function_words: int  # distinct ones
    n_ends: int
    n_bytes: int  # in words
    n_upper: int
    n_digits: int


def repeat_words(words: list[bytes], width: int = 3) -> int:
    """Words in windows of the given width that the text holds twice or more."""
    windows = list(zip(*(words[i:] for i in range(width)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    often, n, upto = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if often[w] > 1:
            n += i + width - max(i, upto)
            upto = i + width
    return n


def facts(text: str) -> Facts:
    raw = text.encode()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return Facts(
        n_words=len(words),
        word_chars=len(text) - sum(map(text.count, _BLANKS)),
        n_symbols=sum(map(text.count, SYMBOLS)),
        n_lines=len(lines),
        n_dup_lines=len(lines) - len(set(lines)),
        n_repeat_words=repeat_words(words),
        n_symbol_words=len(raw.translate(None, _NO_SYMBOL).split()),
        n_letter_words=len(raw.translate(None, _NO_LETTER).split()),
        n_echoes=sum(map(eq, words, words[1:])),
        n_function_words=len(FUNCTION_WORDS.intersection(words)),
        n_ends=len(_END.findall(raw)),
        n_bytes=sum(map(len, words)),
        n_upper=len(raw.translate(None, _UPPER)),
        n_digits=len(raw.translate(None, _DIGITS)),
    )


def _share(part: Callable[[Facts], int], whole: Callable[[Facts], int], good: tuple[float, float], fair: tuple[float, float], least: int = 1) -> Callable[[Facts], int]:
    """Votes good where the share lies in good, bad where it lies outside fair; abstains between, and where whole is below least."""

    def vote(f: Facts) -> int:
        n = whole(f)
        if n < least:
            return ABSTAIN
        x = part(f) / n
        return GOOD if good[0] <= x <= good[1] else BAD if not fair[0] <= x <= fair[1] else ABSTAIN

    return vote


def _words(f: Facts) -> int:
    return f.n_words


RULES: dict[str, Callable[[Facts], int]] = {
    "length": lambda f: GOOD if f.n_words >= 100 else ABSTAIN if f.n_words >= LEAST_WORDS else BAD,
    "word_length": _share(lambda f: f.word_chars, _words, (3.5, 9.0), (3.0, 10.0)),
    "symbols": _share(lambda f: f.n_symbols, _words, (0.0, 0.02), (0.0, 0.1)),
    "repeated_lines": _share(lambda f: f.n_dup_lines, lambda f: f.n_lines, (0.0, 0.1), (0.0, 0.3), least=2),
    "repeated_words": _share(lambda f: f.n_repeat_words, _words, (0.0, 0.1), (0.0, MOST_REPEATED), least=3),
    "symbol_words": _share(lambda f: f.n_symbol_words, _words, (0.0, 0.05), (0.0, 0.25)),
    "echoes": _share(lambda f: f.n_echoes, _words, (0.0, 0.05), (0.0, 0.2), least=3),
    "letter_words": _share(lambda f: f.n_letter_words, _words, (0.9, 1.0), (0.8, 1.0)),
    "function_words": lambda f: GOOD if f.n_function_words >= 2 else ABSTAIN if f.n_function_words or f.n_words < LEAST_WORDS else BAD,
    "sentence_ends": _share(lambda f: f.n_ends, _words, (0.01, 0.35), (0.001, 0.6), least=20),
    "capitals": _share(lambda f: f.n_upper, lambda f: f.n_bytes, (0.0, 0.15), (0.0, 0.5)),
    "digits": _share(lambda f: f.n_digits, lambda f: f.n_bytes, (0.0, 0.1), (0.0, 0.3)),
}


def votes(f: Facts) -> int:
    """All rules' votes as one number, a digit to base 3 each, the first rule's lowest."""
    out = 0
    for rule in reversed(RULES.values()):
        out = out * 3 + rule(f)
    return out


def digits(codes: np.ndarray, k: int = len(RULES)) -> np.ndarray:
    return (codes[:, None] // 3 ** np.arange(k, dtype=np.int64)) % 3


def fit_label_model(codes: np.ndarray, counts: np.ndarray, k: int = len(RULES), rounds: int = 500) -> tuple[float, np.ndarray]:
    """(log odds of a good document before its votes, log likelihood ratio of each rule's votes [rule, digit]).

    codes: distinct combinations of votes; counts: how many documents have each. The start is the prior accuracy of all rules.
    """
    v = digits(np.asarray(codes, np.int64), k)
    counts = np.asarray(counts, float)
    prior = np.repeat(np.array(PRIOR)[:, None, :], k, axis=1)  # [bad or good, rule, digit]
    table, share, weight = prior.copy(), 0.5, max(1.0, WEIGHT * counts.sum())
    rows = np.arange(k)
    last = None
    for _ in range(rounds):
        ratio = np.log(table[1] / table[0])
        ratio[:, GOOD], ratio[:, ABSTAIN], ratio[:, BAD] = np.maximum(ratio[:, GOOD], 0.0), 0.0, np.minimum(ratio[:, BAD], 0.0)
        odds = np.log(share / (1 - share))
        z = odds + ratio[rows, v].sum(axis=1)
        good = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        if last is not None and np.abs(good - last).max(initial=0.0) < 1e-9:
            break
        last = good
        share = (counts @ good + weight / 2) / (counts.sum() + weight)
        for c, n in enumerate((counts * (1 - good), counts * good)):
            seen = np.stack([n @ (v == d) for d in range(3)], axis=1)
            table[c] = (seen + weight * prior[c]) / (n.sum() + weight)
    return float(odds), ratio


def accuracies(model: tuple[float, np.ndarray]) -> dict[str, tuple[float, float, float]]:
    """Per rule the log likelihood ratios of a bad vote, of abstaining and of a good vote."""
    return {name: tuple(map(float, r)) for name, r in zip(RULES, model[1], strict=True)}


def _base_failed(f: Facts) -> bool:
    return f.n_words < LEAST_WORDS or 100 * f.n_repeat_words > 100 * MOST_REPEATED * f.n_words


def tally(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed and votes of every row."""

    def run(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                f = facts(text)
                rows.append((doc, f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words, _base_failed(f), votes(f)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(list(zip(*rows, strict=True)) or [()] * len(schema), schema, strict=True)], schema=schema)

    counts = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
    return map_arrow(docs_of(docs), run, f"doc_id {dict(docs.dtypes)['doc_id']}, {counts}, base_failed boolean, votes bigint")


def fit(tallied: DataFrame) -> tuple[float, np.ndarray]:
    """The label model over all rows of tally()."""
    seen = tallied.groupBy("votes").count().orderBy("votes").collect()  # at most 3**len(RULES) rows
    return fit_label_model(np.array([r.votes for r in seen], np.int64), np.array([r["count"] for r in seen], float))


def report(docs: DataFrame) -> DataFrame:
    """Base counts, base_failed, kept, the posterior quality and the votes of every row."""
    seen = materialise(tally(docs), "quality-votes")
    odds, ratio = fit(seen)
    z = F.lit(odds)
    for i, r in enumerate(ratio):
        digit = F.col("votes") / 3**i
        z = z + F.element_at(F.array(*map(F.lit, map(float, r))), (F.floor(digit) % 3 + 1).cast("int"))
    quality = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return seen.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (quality >= KEEP)).alias("kept"), quality.alias("quality"), "votes")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows that are kept, with all their columns."""
    odds, ratio = fit(materialise(tally(docs).select("votes"), "quality-votes"))
    at, least = docs.columns.index("text"), float(np.log(KEEP / (1 - KEEP)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                got = [facts(t or "") for t in b.column(at).to_pylist()]
                z = odds + ratio[np.arange(len(RULES)), digits(np.array([votes(f) for f in got], np.int64))].sum(axis=1)
                yield b.filter(pa.array((z >= least) & ~np.array([_base_failed(f) for f in got])))

    return docs.mapInArrow(run, docs.schema)
