"""Cases at the edges of the training-data operators: hot and long parts, repeated keys, other plans, emptied documents."""

import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from curio.llm import jaccard_join, packing, token_counts  # noqa: E402

WORD, PIECE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


def test_long_pretokens_and_repeated_rows(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    banner = "=" * 80
    rows = [(7, f"{banner} a {banner}"), (7, f"{banner} a {banner}"), (7, "other"), (None, banner), (None, None)] + [(i, f"x{i} {banner}\n{banner}{i}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs, PIECE).collect())
    assert got == sorted((str(d), len((t or "").encode()), len(sp.encode(t or ""))) for d, t in rows)
    known = token_counts.frequent(docs.selectExpr("doc_id", "coalesce(text, '') AS text"), PIECE)
    assert token_counts.entry(f" {banner}".encode()) in known and all(len(k) <= token_counts.NAMED_BYTES + 1 for k in known)


def _family(rng):
    base = [rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(rng.randint(20, 90))]
    for _ in range(rng.randint(2, 25)):
        w = list(base)
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = f"w{rng.randint(0, 999)}"
        yield " ".join(w)


@pytest.mark.parametrize("small", [{"KNOWN": 0}, {"CHUNK": 3, "QUERIES": 2}])
def test_jaccard_plans_agree(spark, monkeypatch, small):
    """Without a broadcast of classes, and with small parts of groups and of queries, links are the same."""
    rng = random.Random(3)
    texts = [t for _ in range(12) for t in _family(rng)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    whole = sorted(map(tuple, jaccard_join.components(docs).collect()))
    for k, v in small.items():
        monkeypatch.setattr(jaccard_join, k, v)
    assert sorted(map(tuple, jaccard_join.components(docs).collect())) == whole and len({c for _, _, c in whole}) < len(texts)


def test_every_true_link_of_the_sample_is_found(spark):
    """Recall over all pairs of sf0.01's documents, at the contract's threshold and at the pipeline's."""
    import pyarrow.parquet as pq

    t = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    for width, percent in ((4, 85), (5, 80)):
        sets = {}
        for d, x in zip(t["doc_id"], t["text"], strict=True):
            w = (x or "").lower().split()
            sets[d] = frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()
        root = {d: d for d in sets}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        order = sorted((d for d in sets if sets[d]), key=lambda d: len(sets[d]))
        links = 0
        for i, a in enumerate(order):
            for b in order[i + 1 :]:
                if len(sets[a]) * 100 < percent * len(sets[b]):
                    break
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    links += 1
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
        got = {r.doc_id: r.component_id for r in jaccard_join.components(docs, width, percent).collect()}
        assert links > 50 and got == {d: find(d) for d in sets}


def test_sequences_at_powers_of_two_stay(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e f g")], "doc_id bigint, text string")
    pieces = packing.pack(docs.where("doc_id = 1"), WORD, window=16, with_ids=True)
    (r,) = packing.sequences(pieces, 16).collect()
    assert (r.n_ids, len(r.ids)) == (4, 16)
    (r,) = packing.sequences(packing.pack(docs.where("doc_id = 2"), WORD, window=16, with_ids=True), 16).collect()
    assert (r.n_ids, len(r.ids)) == (5, 64)


def test_emptied_documents_do_not_reach_packing(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    text = "one line of several words here\nand another line of several words"
    rows = [(1, text, 64), (2, text, 64), (3, text + "\nown words", 74), (4, "", 0), (5, None, None), (6, " ", 1)]
    out = corpus_pipeline.dedup_lines(spark, spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint"), "").collect()
    assert sorted((r.doc_id, r.text, r.n_chars) for r in out if r.text is not None) == [(1, text, 64), (3, "own words", 9), (4, "", 0), (6, " ", 1)]
    assert [r.doc_id for r in out if r.text is None] == [5]


def test_rows_without_a_key_are_spread(spark):
    """A key that most rows share, as null, does not end in one partition."""
    from curio.llm import token_ids

    rows = [(None if i % 3 else i, f"some words of text number {i} " * (i % 7 + 1)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r.n for r in token_ids.write_ids(docs, WORD).groupBy("part").agg({"n_ids": "sum"}).withColumnRenamed("sum(n_ids)", "n").collect()]
        found = token_ids.round_trip(docs, WORD).orderBy("start").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 2 and max(sizes) < 2 * sum(sizes) / len(sizes)
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens
    keys = [r.doc_id for r in found]
    assert keys == [None] * 2000 + sorted(k for k in keys if k is not None)
