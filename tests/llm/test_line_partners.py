"""Line dedup of a document that shares its lines with very many others, and with partners that hold them in other orders."""

import random

from curio.llm import line_dedup


def test_thousands_of_partners(spark):
    lines = [f"shared line number {i} of the collection" for i in range(3000)]
    rows = [(i, f"own line of document {i} stands here\n{x}") for i, x in enumerate(lines)] + [(5000, "\n".join([*lines[:1500], "something that no other document has at all", *lines[1500:]]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r for r in line_dedup.dedup(docs, report=True).collect()}
    assert got[5000].text == "something that no other document has at all" and got[5000].lines_removed == 3000 and got[5000].partners == list(range(3000))
    assert all(got[i].text == t for i, t in rows[:3000])
    plan = line_dedup.removals(docs)
    assert plan.count() == 1


def test_work_grows_with_marks_not_with_partners(monkeypatch):
    """Each partner is aligned over the lines that it shares alone."""
    seen = []
    whole = line_dedup.common_blocks

    def counted(early, late, words, least):
        seen.append(len(early) + len(late))
        return whole(early, late, words, least)

    monkeypatch.setattr(line_dedup, "common_blocks", counted)
    keys = [i.to_bytes(16, "big") for i in range(2000)]
    shared = [{"first": i, "key": k, "at": 7, "run": None} for i, k in enumerate(keys)]
    cuts = line_dedup.aligned(shared, keys, [6] * 2000, 5)
    assert len(cuts) == 2000 and cuts[3] == [(3, 4)] and sum(seen) == 4000


def plainly(rows, least):
    """The lines of each document that stand in a block of at least least words that an earlier document holds, by all pairs of places."""
    out = {}
    for d, text in rows:
        late = text.split("\n")
        gone = set()
        for e, other in rows:
            if e < d:
                early = other.split("\n")
                for i in range(len(early)):
                    for j in range(len(late)):
                        n = 0
                        while i + n < len(early) and j + n < len(late) and early[i + n] == late[j + n]:
                            n += 1
                        if sum(len(x.split()) for x in late[j : j + n]) >= least:
                            gone |= set(range(j, j + n))
        out[d] = "\n".join(x for k, x in enumerate(late) if k not in gone)
    return out


def test_equals_all_pairs_of_places(spark):
    for seed in range(3):
        rng = random.Random(seed)
        pool = ["a b", "c d e", "f", "g h i j k", "l m", "n o p", "q"]
        rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 14)))) for i in range(40)]
        got = {r.doc_id: r.text for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
        assert got == plainly(rows, 5)
