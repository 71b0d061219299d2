"""A benchmark in several automata gives what one gives."""

from curio.llm import decontaminate


def test_overlapping_items_and_repeated_keys(spark, monkeypatch):
    words = [f"w{i}" for i in range(40)]
    bench = spark.createDataFrame([(i, " ".join(words[i : i + 12])) for i in range(25)] + [(i, " ".join(words[:12])) for i in range(50, 60)], "item_id bigint, text string")
    texts = [(1, "x, " + ", ".join(words) + " y"), (1, "z " + " ".join(words[:15])), (1, "clean"), (None, " ".join(words[5:20])), (None, "none"), (2, None)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    order = lambda df: sorted(map(repr, df.collect()))
    whole, hits = order(decontaminate.report(docs, bench)), order(decontaminate.find_hits(docs, bench))
    assert len(whole) == len(texts)
    monkeypatch.setattr(decontaminate, "MAX_AUTOMATON_BYTES", 9000)
    assert decontaminate._windows(bench, decontaminate.WIDTH)[1] > 3
    assert order(decontaminate.report(docs, bench)) == whole and order(decontaminate.find_hits(docs, bench)) == hits
    assert {(r.doc_id, r.n_words): r.n_hit for r in decontaminate.report(docs, bench).collect()}[1, 42] == 36
    kept = sorted(r.n_words for r in decontaminate.report(decontaminate.remove_contaminated(docs, bench), bench).collect())
    assert kept == [0, 1, 1]
    assert decontaminate.report(docs.limit(0), bench).count() == 0 == decontaminate.report(docs, bench.limit(0)).where("n_hit > 0").count()


def test_one_item_is_split(spark, monkeypatch):
    """A single item beyond the bound is dealt out, too."""
    text = " ".join(f"w{i}" for i in range(300))
    bench = spark.createDataFrame([(1, text), (None, "lost"), (2, None)], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, f"a {text} b"), (2, "lost")], "doc_id bigint, text string")
    monkeypatch.setattr(decontaminate, "MAX_AUTOMATON_BYTES", 100_000)
    assert decontaminate._windows(bench, decontaminate.WIDTH)[1] > 2
    assert sorted((r.doc_id, r.n_hit, r.n_items) for r in decontaminate.report(docs, bench).collect()) == [(1, 300, 1), (2, 0, 0)]


def test_words_beyond_two_signs(spark):
    """More distinct words than two signs are used for; unknown words and equal beginnings do not match."""
    import random

    rng = random.Random(3)
    names = [f"w{i}".encode() for i in range(70_000)]
    windows = tuple((b" ".join(names[i : i + 10]), (str(i),)) for i in range(0, 69_990, 7))
    extra = tuple((b" ".join(names[i : i + 10]), ("x",)) for i in range(1, 69_990, 9))
    both = decontaminate.Scanner(tuple(sorted({w: i for w, i in windows + extra}.items())))
    assert both.signs == 3
    text = b" ".join([*names[700:712], b"unknown", *names[14:23], b"no", *names[21:40], *rng.sample(names, 500)])
    words = decontaminate.words_of(text)
    table = {w: i for w, i in windows + extra}
    want = sorted((i, i + 10, table[b" ".join(words[i : i + 10])]) for i in range(len(words) - 9) if b" ".join(words[i : i + 10]) in table)
    assert sorted(both.find(words)) == want and len(want) == 3
    assert list(decontaminate.Scanner(()).find(words)) == []


def test_memory_stays_within_the_estimate():
    """An automaton takes no more than NODE_BYTES for each word of its windows."""
    import random

    rng = random.Random(4)
    names = [f"{rng.getrandbits(40):x}".encode() for _ in range(5000)]
    windows = tuple((b" ".join(rng.choices(names, k=10)), ("1",)) for _ in range(20_000))
    s = decontaminate.Scanner(windows)
    stats = s.automaton.get_stats()
    assert stats["total_size"] < 200_000 * decontaminate.NODE_BYTES[s.signs]
