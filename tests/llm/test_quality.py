"""Quality rules: base counts against a plain reading, the label model on simulated votes, verdicts on labelled documents."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from curio.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def plainly(text):
    text = text or ""
    words = WORD.findall(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] >= 2:
            inside |= {i, i + 1, i + 2}
    n, r = len(words), len(inside)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, r, n < 50 or 100 * r > 50 * n


ROWS = [(1, None), (2, ""), (3, " \n\t\x0b "), (4, "a b c a b c"), (5, "x " * 60), (6, "Une phrase été à lire. " * 9_000), (7, "a\x1fb\x85c\xa0d é漢𝄞 | # ###\r\n|\n|\n | \n"), (None, "the of and. " * 3), (7, "same"), (7, "same"), (8, "漢" * 50_000)]
EXTRA = "doc_id bigint, text string, votes string, kept string, quality int, n_words string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, "z") for r in rows], EXTRA)


def test_base_counts(spark):
    rng = random.Random(2)
    rows = ROWS + [(100 + i, "".join(rng.choice(["ab", "cd", "ef. ", " ", " ", "\n", "|", "é"]) for _ in range(rng.randrange(300)))) for i in range(80)]
    got = quality.report(table(spark, rows).repartition(3)).collect()
    assert sorted(((r.doc_id, *(r[c] for c in BASE)) for r in got), key=str) == sorted(((d, *plainly(t)) for d, t in rows), key=str)
    assert all(not r.kept for r in got if r.base_failed) and all(0 < r.quality < 1 for r in got)
    assert quality.report(table(spark, rows).limit(0)).collect() == []


def test_label_model_finds_the_accuracies_of_simulated_rules():
    rng, k = np.random.default_rng(4), len(quality.RULES)
    good = rng.random(60_000) < 0.8
    on_good = np.stack([(0.01 + 0.02 * (i % 3), 0.2, 0.79 - 0.02 * (i % 3)) for i in range(k)])
    on_bad = np.stack([(0.15 + 0.05 * (i % 6), 0.2, 0.65 - 0.05 * (i % 6)) for i in range(k)])
    v = np.stack([(rng.random(len(good))[:, None] > np.cumsum(np.where(good[:, None], on_good[i], on_bad[i]), axis=1)).sum(axis=1) for i in range(k)], axis=1)
    codes, where, counts = np.unique(v @ 3 ** np.arange(k), return_inverse=True, return_counts=True)
    odds, ratio = quality.fit_label_model(codes, counts)
    want = np.log(on_good / on_bad)
    assert np.abs(ratio[:, quality.BAD] - want[:, quality.BAD]).max() < 0.5 and np.abs(ratio[:, quality.GOOD] - want[:, quality.GOOD]).max() < 0.15
    z = odds + ratio[np.arange(k), quality.digits(codes)].sum(axis=1)
    best = (np.log(0.8 / 0.2) + np.where(v == quality.ABSTAIN, 0, want[np.arange(k), v]).sum(axis=1)) >= 0
    assert (((z >= 0)[where]) == good).mean() > (best == good).mean() - 0.005
    assert quality.fit_label_model(codes, counts * 10)[0] == pytest.approx(odds, abs=0.01)  # alike at every size


def test_a_single_weak_vote_does_not_reject_and_agreeing_votes_do(spark):
    rng = random.Random(6)
    names = "the of and stone river house garden letter window morning paper small green walks writes under over with from table".split()
    clean = [" ".join(rng.choice(names) for _ in range(rng.randint(60, 300))) + "." for _ in range(400)]
    clean = [re.sub(r"((?:\S+ ){9}\S+) ", r"\1. ", t) for t in clean]
    numbers = [f"{t} {' '.join(str(rng.randint(10**6, 10**7)) for _ in range(20))}" for t in clean[:8]]
    junk = [" ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in t.split()) for t in clean[:40]]
    rows = list(enumerate(clean + numbers + junk))
    got = {r.doc_id: r for r in quality.report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(got[i].kept for i in range(408) if not got[i].base_failed)
    assert not any(got[i].kept for i in range(408, 448))


def test_verdicts_on_labelled_documents(spark):
    """Labels are used here alone, to hold the unsupervised verdicts against."""
    d = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{d}/labels.parquet")
    got = quality.report(docs).withColumnRenamed("quality", "posterior").join(labels, "doc_id").where("not base_failed").groupBy("quality", "kept").count()
    n = {(r.quality, r.kept): r["count"] for r in got.collect()}
    assert n.get((1, False), 0) <= 0.002 * n[(1, True)] and n.get((0, True), 0) <= 0.02 * n[(0, False)]
    kept = {r.doc_id for r in quality.keep_good(docs).select("doc_id").collect()}
    assert kept == {r.doc_id for r in quality.report(docs).where("kept").select("doc_id").collect()}
