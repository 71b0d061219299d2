"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

from curio.llm import spelling

RUN = re.compile(r"[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_step(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plainly(rows):
    n = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 97 == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1 :]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = {w: [x for x in n if x != w and abs(len(x) - len(w)) < 2 and one_step(w, x)] for w in n}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


def got(docs):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect())


SCHEMA = "doc_id bigint, text string, word string, n int, form string, key string"


def test_equals_all_pairs(spark):
    for seed, letters in enumerate(["aab", "aaabc", "aaàé÷", "aaaaabcdefgÀÈß"]):
        rng = random.Random(seed)
        texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.choice([4, 5, 5, 6, 7]))) for _ in range(rng.randrange(400))) for _ in range(30)]
        rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (1, texts[1]), (1, texts[1]), (2, None), (3, "")]
        docs = spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], SCHEMA).repartition(4)
        want = plainly(rows)
        assert got(docs) == want and len(want) > 30
        assert sum(x[1] is not None for x in want) > 3


def test_chains_and_ties(spark):
    words = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "zzzzz": 7, "zzzzy": 15, "zzzzx": 15, "lonely": 4, "aaaaaa": 3}
    rows = [(i, " ".join(w for w, n in words.items() if i < n)) for i in range(48)]
    found = got(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert found == plainly(rows) and any(f and f != r for _, f, r, *_ in found)


def test_odd_texts_and_slips(spark):
    rows = [(1, "NAÏVE naïve Naïve naÏve"), (None, "x" * 5000 + " " + "word's word_s wörds " * 4), (5, "漢字abcde漢abcde\x00abcde 𝄞"), (6, "multiplied×times÷by " * 3), (7, " \n\t")]
    rows += [(i, "frequent words of every document here") for i in range(200, 900)]  # so that slips occur
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = plainly(rows)
    assert got(docs) == want and any(f == "frequent" for _, f, *_ in want)
    assert got(docs.limit(0)) == [] and got(docs.where("doc_id = 7")) == []


def test_counts_are_sent_on_when_a_task_holds_many(spark, monkeypatch):
    rows = [(i, f"alpha{chr(97 + i % 26)} alphas betas gammas") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(spelling, "HELD", 3)
    assert got(docs) == plainly(rows)


def test_the_smallest_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert got(docs) == plainly([(r.doc_id, r.text) for r in docs.collect()])
