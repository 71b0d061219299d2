"""Toxicity by weak supervision.

1. Voters. Fixed lexicons and patterns, and lexicons of words and word beginnings that labelled rows show to be far likelier in
   toxic texts (beginnings catch inflected stems). Each voter says yes or no about a whole text.
2. Generative label model. How often each combination of votes occurs is counted over all documents (at most 2**VOTERS rows).
   Expectation maximisation estimates each voter's accuracy per class, anchored by the labelled rows; residual correlations
   within the classes weaken voters that say the same twice. This gives every combination a posterior.
3. Linear classifier. Logistic regression of the posteriors on vote and count features, then calibrated on the labels.

Labels come only from rows whose crc32(doc_id) mod 4 is not 2. The fit uses at most FIT_ROWS labelled rows (those with the
smallest hashes of doc_id); vote statistics and scores cover all documents. lang, source and doc_id are never inputs.

Defined results: null or empty text has no votes and gets the score of that combination. Several label rows of a document:
the largest counts. Without labels of both classes the learned voters stay empty and the calibration is left out. Null doc_id
is not held out. Equal rows get equal scores. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curio.llm.common import byte_column, docs_of, map_arrow, materialise

FIT_ROWS = 20_000
MIN_TOXIC = 4  # sampled toxic documents that hold a feature, for it to be tested
MIN_RATIO = 6.0  # how much likelier a learned feature is in toxic documents, at least
CHANCE = 0.1  # expected number of learned features that are there by chance
LEARNED = 600  # size of the model: features that it looks at, those that tell most
THRESHOLD = 0.3
ROOT = 4  # bytes of the shortest learned word beginning
PREFIXES = (4, 5, 6, 7, 8, 9)

# Voter lexicons.
LEXICONS = {
    "intellect": "idiot idiots moron morons stupid stupidity dumb dumbass imbecile imbeciles brainless halfwit dimwit nitwit cretin",
    "worth": "worthless pathetic loser losers useless failure nobody",
    "contempt": "scum trash garbage vermin filth filthy lowlife parasite parasites",
    "disgust": "disgusting revolting vile repulsive sickening gross",
    "ridicule": "clown clowns joke buffoon laughingstock freak freaks",
    "hostile": "hate shut kill threaten punch destroy",
    "others": "idiota imbecil estupido basura payaso crétin débile ordure clochard dummkopf abschaum versager trottel arschloch",
}
_LEX = {k: frozenset(w.encode() for w in v.split()) for k, v in LEXICONS.items()}
_ALL = frozenset().union(*_LEX.values())
_STRONG = _ALL - _LEX["hostile"]

_LETTERS = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else (b + 32 if 0x41 <= b <= 0x5A else 0x20) for b in range(256))
_SPELLED = bytes.maketrans(b"0134578@$!", b"oieastbasi")
_MASKED = re.compile(rb"[A-Za-z][0134578@$!]+[A-Za-z]")
_ADDRESSED = re.compile(rb"(?i)\b(?:you|your|you're|u)\b(?:\W+\w+){0,2}?\W+(?:" + b"|".join(sorted(_STRONG, key=len, reverse=True)) + rb")\b")

VOTERS = [*LEXICONS, "two_insults", "addressed", "masked", "dense", "learned_1", "learned_2", "learned_3", "learned_many"]
N_REAL = 5


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_LETTERS).split()


def marks(word_set: set[bytes]) -> set[bytes]:
    """Words and word beginnings, as features: a whole word ends with a blank."""
    out = {w + b" " for w in word_set if len(w) <= 24}
    for n in PREFIXES:
        out.update(w[:n] for w in word_set if len(w) > n)
    return out


class Voters:
    """learned: feature -> (tier, log odds)."""

    def __init__(self, learned: dict[bytes, tuple[int, float]]):
        self.learned = learned
        self.roots = frozenset(k[:ROOT] for k in learned if not k.endswith(b" ") or len(k) > ROOT)
        self.short = frozenset(k[:-1] for k in learned if k.endswith(b" ") and len(k) <= ROOT)

    def look(self, raw: bytes) -> tuple[int, list[float]]:
        """Vote mask and real features of a text."""
        words = words_of(raw)
        own = set(words)
        mask, strong = 0, own & _STRONG
        hits = own & _ALL
        total = 0
        if hits:
            for i, lex in enumerate(_LEX.values()):
                mask |= (not lex.isdisjoint(hits)) << i
            total = sum(map(words.count, strong))
        base = len(_LEX)
        if len(strong) >= 2:
            mask |= 1 << base
        if strong and _ADDRESSED.search(raw):
            mask |= 1 << (base + 1)
        if _MASKED.search(raw) and (set(words_of(raw.translate(_SPELLED))) - own) & _STRONG:
            mask |= 1 << (base + 2)
        if total * 200 >= max(1, len(words)) and total:
            mask |= 1 << (base + 3)
        near = {w for w in own if w[:ROOT] in self.roots} | (own & self.short)
        odds, n = 0.0, 0
        if near:
            for w in near:
                best = None
                for k in (w + b" ", *(w[:i] for i in PREFIXES if len(w) > i)):
                    got = self.learned.get(k)
                    if got and (best is None or got[1] > best[1]):
                        best = got
                if best:
                    mask |= 1 << (base + 4 + best[0])
                    odds += best[1]
                    n += 1
            if n >= 2:
                mask |= 1 << (base + 7)
        size = np.log1p(len(words))
        return mask, [float(np.log1p(total)), float(len(strong)), float(np.log1p(odds)), float(np.log1p(n)), float(size)]


def held_out(key: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _tally(sample: DataFrame) -> DataFrame:
    """Per feature the numbers of toxic (t) and of clean (c) documents that hold it; those of at least MIN_TOXIC toxic ones."""

    def run(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        tables: tuple[Counter[bytes], Counter[bytes]] = Counter(), Counter()
        for b in batches:
            for raw, toxic in zip(byte_column(b.column(0)), b.column(1).to_pylist(), strict=True):
                tables[toxic].update(marks(set(words_of(raw))))
        for toxic, table in enumerate(tables):
            n = pa.array(list(table.values()), pa.int64())
            none = pa.array([0] * len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(list(table), schema.field(0).type), n if toxic else none, none if toxic else n], schema=schema)

    sums = map_arrow(sample.select("text", "toxic"), run, "k binary, t bigint, c bigint").groupBy("k").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    return sums.where(F.col("t") >= MIN_TOXIC)


def learn_lexicon(sample: DataFrame, n_toxic: int, n_clean: int) -> dict[bytes, tuple[int, float]]:
    """Features that are likelier in toxic documents by more than chance, with tier and log odds: the LEARNED that tell most.

    All features of the sample are tested. Beyond those that tell most, what passes is mostly words of a few documents and their
    copies: with all of them the model rejects clean documents (README).
    """
    if not n_toxic or not n_clean:
        return {}
    tested = materialise(_tally(sample), "toxicity-features")
    base, need = n_toxic / (n_toxic + n_clean), float(np.log(max(1, tested.count()) / CHANCE))
    t, c = F.col("t"), F.col("c")
    ratio = ((t + 0.5) / (n_toxic + 1)) / ((c + 0.5) / (n_clean + 1))
    share = t / (t + c)
    gain = t * F.log(share / base) + F.when(c > 0, c * F.log((1 - share) / (1 - base))).otherwise(0.0)  # log of the likelihood ratio against the base rate
    found = tested.where((ratio >= MIN_RATIO) & (gain >= need)).select("k", F.log(ratio).alias("odds"), gain.alias("gain")).orderBy(F.desc("gain"), "k").limit(LEARNED).collect()
    cuts = np.quantile([r.odds for r in found], [1 / 3, 2 / 3]) if found else (0, 0)
    return {bytes(r.k): (int(r.odds > cuts[0]) + int(r.odds > cuts[1]), r.odds) for r in found}


def bits(masks: np.ndarray, k: int) -> np.ndarray:
    return ((masks[:, None] >> np.arange(k)) & 1).astype(float)


def fit_label_model(masks: np.ndarray, counts: np.ndarray, anchors: np.ndarray, k: int, rounds: int = 60) -> np.ndarray:
    """Posterior of class 1 for each combination of votes.

    masks: combinations; counts: documents of each; anchors: per combination, labelled documents of class 0 and 1.
    """
    v = bits(masks, k)
    known = anchors.sum()
    prior = (anchors[:, 1].sum() + 1) / (known + 2) if known else 0.1
    post = (anchors[:, 1] + prior) / (anchors.sum(axis=1) + 1) if known else np.where(v.sum(axis=1) > 0, 0.9, 0.02)
    free = np.maximum(counts - anchors.sum(axis=1), 0.0)
    weight = np.ones(k)
    for _ in range(rounds):
        n1 = free * post + anchors[:, 1]
        n0 = free * (1 - post) + anchors[:, 0]
        p1 = (v.T @ n1 + 0.5) / (n1.sum() + 1)
        p0 = (v.T @ n0 + 0.5) / (n0.sum() + 1)
        prior = (n1.sum() + 1) / (n0.sum() + n1.sum() + 2)
        corr = np.zeros((k, k))
        for n, p in ((n1, p1), (n0, p0)):
            d = v - p
            corr += (d.T @ (d * n[:, None])) / max(n.sum(), 1) / np.sqrt(np.outer(p * (1 - p), p * (1 - p))) / 2
        np.fill_diagonal(corr, 0)
        weight = 1 / (1 + np.clip(corr, 0, 1).sum(axis=1))
        yes, no = np.log(p1 / p0), np.log((1 - p1) / (1 - p0))
        z = np.log(prior / (1 - prior)) + v @ (weight * (yes - no)) + (weight * no).sum()
        new = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        if np.abs(new - post).max() < 1e-6:
            post = new
            break
        post = new
    return post


def fit_logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> np.ndarray:
    """Newton's method with soft labels; the last coefficient is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    b = np.zeros(x.shape[1])
    pen = np.full(x.shape[1], ridge)
    pen[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (w * (y - p)) - pen * b
        h = (x * (w * p * (1 - p))[:, None]).T @ x + np.diag(pen + 1e-9)
        step = np.linalg.solve(h, g)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return b


def fit_scorer(masks: np.ndarray, counts: np.ndarray, fit: np.ndarray, k: int) -> np.ndarray:
    """Coefficients of votes, real features and constant. fit: rows of (mask, real features, label)."""
    if not len(masks):
        return np.zeros(k + N_REAL + 1)
    at = {m: i for i, m in enumerate(masks.tolist())}
    anchors = np.zeros((len(masks), 2))
    for m, y in fit[:, [0, -1]].astype(int).tolist():
        anchors[at[m], y] += 1
    post = fit_label_model(masks, counts, anchors, k)
    if len(fit):
        x = np.column_stack([bits(fit[:, 0].astype(np.int64), k), fit[:, 1:-1]])
        y = post[[at[m] for m in fit[:, 0].astype(int).tolist()]]
        coef = fit_logistic(x, y, np.ones(len(x)))
        truth = fit[:, -1]
        if 0 < truth.sum() < len(truth):
            z = x @ coef[:-1] + coef[-1]
            a, c = fit_logistic(z[:, None], truth, np.ones(len(z)), ridge=1e-3)
            coef = coef * max(a, 1e-3)
            coef[-1] += c
        return coef
    v = np.column_stack([bits(masks, k), np.zeros((len(masks), N_REAL))])
    return fit_logistic(v, post, counts)


def fit(d: DataFrame, labels: DataFrame):
    """(broadcast learned lexicon, coefficients, table of votes and features of all documents)."""
    train = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = train.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
    chosen = materialise(chosen, "toxicity-rows")
    sample = materialise(d.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic"), "toxicity-sample")
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    voters = d.sparkSession.sparkContext.broadcast(learn_lexicon(sample, sizes.get(1, 0), sizes.get(0, 0)))

    def look(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        own = Voters(voters.value)
        for b in batches:
            got = [own.look(raw) for raw in byte_column(b.column(1))]
            cols = [[m for m, _ in got], *([f[i] for _, f in got] for i in range(N_REAL))]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), *(pa.array(c, t.type) for c, t in zip(cols, list(schema)[1:], strict=True))], schema=schema)

    ddl = "doc_id bigint, mask int, " + ", ".join(f"f{i} double" for i in range(N_REAL))
    seen = materialise(map_arrow(d, look, ddl), "toxicity-votes")
    combos = seen.groupBy("mask").count().collect()  # at most 2**VOTERS rows
    named = ["mask", *(f"f{i}" for i in range(N_REAL)), "toxic"]
    picked = seen.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max(F.struct(*named)).alias("x"))  # one row of each doc_id: FIT_ROWS at most
    rows = [tuple(r) for r in picked.select("x.*").collect()]
    coef = fit_scorer(np.array([r["mask"] for r in combos], np.int64), np.array([r["count"] for r in combos], float), np.array(rows, float).reshape(-1, N_REAL + 2), len(VOTERS))
    return voters, coef, seen


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, and the label model's vote mask."""
    _, coef, seen = fit(docs_of(docs), labels)
    k = len(VOTERS)
    z = F.lit(float(coef[-1]))
    for i in range(k):
        z = z + F.when(F.col("mask").bitwiseAND(1 << i) != 0, float(coef[i])).otherwise(0.0)
    for i in range(N_REAL):
        z = z + F.col(f"f{i}") * float(coef[k + i])
    s = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))
    out = seen.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), s.alias("score"), "mask")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.col("mask").alias("votes"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows that are not predicted toxic, with all their columns: they are scored and dropped where they are read."""
    voters, coef, _ = fit(docs_of(docs), labels)
    at, k = docs.columns.index("text"), len(VOTERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, least = Voters(voters.value), np.log(THRESHOLD / (1 - THRESHOLD))
        for b in batches:
            if b.num_rows:
                got = [own.look(raw) for raw in byte_column(b.column(at))]
                x = np.column_stack([bits(np.array([m for m, _ in got], np.int64), k), np.array([f for _, f in got])])
                yield b.filter(pa.array(x @ coef[:-1] + coef[-1] < least))

    return docs.mapInArrow(run, docs.schema)
