"""Fill-in-the-middle: ropes against plain strings, the whole operator against a plain reading and its SQL."""

import hashlib
import random
import re

import pytest

from curio.llm import fill_middle, rope

UNIT = re.compile(r"[^\n]*\n|[^\n]+")


def random_text(rng):
    return "".join(rng.choice("ab\n\n<PSM>é漢𝄞") for _ in range(rng.randrange(rng.choice([3, 10, 60, 300]))))


def sound(r):
    if r.left is not None:
        assert abs(r.left.height - r.right.height) <= 1
        assert (r.units, r.chars) == (r.left.units + r.right.units, r.left.chars + r.right.chars)
        sound(r.left)
        sound(r.right)


@pytest.mark.parametrize("leaf", [1, 5, 2048])
def test_ropes_cut_and_join_as_strings_do(monkeypatch, leaf):
    monkeypatch.setattr(rope, "LEAF_CHARS", leaf)
    rng = random.Random(leaf)
    for _ in range(600):
        text = random_text(rng)
        units, r = UNIT.findall(text), rope.build(text)
        sound(r)
        assert (str(r), r.units, r.chars) == (text, len(units), len(text))
        for k in {0, len(units), rng.randrange(len(units) + 2)}:
            a, b = rope.split_units(r, k)
            assert (str(a), str(b), a.units) == ("".join(units[:k]), "".join(units[k:]), min(k, len(units)))
            turned = rope.concat(b, a)
            for x in (a, b, turned):
                sound(x)
            assert str(turned) == str(b) + str(a)
        k = rng.randrange(len(text) + 1)
        a, b = rope.split_chars(r, k)
        sound(a)
        sound(b)
        assert (str(a), str(b), a.units + b.units) == (text[:k], text[k:], r.units)
        assert rope.find(r, "<P>") == text.find("<P>")


def test_a_cut_touches_few_leaves():
    r = rope.build("one line of some words\n" * 200_000)
    old = {id(x) for x in nodes(r)}
    a, b = rope.split_units(r, 123_457)
    new = [x for x in (*nodes(a), *nodes(b)) if id(x) not in old]
    assert a.units == 123_457 and len(new) < 4 * r.height


def nodes(r):
    todo = [r]
    while todo:
        x = todo.pop()
        yield x
        if x.left is not None:
            todo += (x.left, x.right)


def plainly(doc_id, text):
    """The contract, word by word."""
    text = text or ""
    u = UNIT.findall(text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return doc_id, len(u), "plain", None, None, sha(text), sha(text)
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 50 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return doc_id, len(u), form, len(p), len(m), sha(out), sha(text)


ROWS = [(None, "key less\n\nx"), (1, None), (2, ""), (3, "\n"), (4, "a <S> b\nc"), (5, "x" * 300_000 + "\nend"), (6, "é漢\n𝄞\r\n\x00\x0b\nlast"), (7, "line\n" * 50_000), (7, "line\n" * 50_000), (8, "<P\n><S\n")]


def test_the_operator_does_what_the_contract_says(spark):
    rng = random.Random(5)
    rows = ROWS + [(i, random_text(rng)) for i in range(100, 160)]
    docs = spark.createDataFrame([(*r, "x", 3, "f") for r in rows], "doc_id bigint, text string, output string, n int, form string").repartition(3)
    key = lambda r: (r[0] is None, *map(str, r))
    assert sorted(map(tuple, fill_middle.report(docs).collect()), key=key) == sorted((plainly(*r) for r in rows), key=key)
    assert fill_middle.report(docs.limit(0)).collect() == []
    assert {r.form for r in fill_middle.transform(docs, rate=0).collect()} == {"plain"}
    assert {r.text for r in fill_middle.invert(fill_middle.transform(docs, seed=9, spm=100)).collect()} == {t or "" for _, t in rows}


def test_equals_sql(spark, sf):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    got = fill_middle.report(spark.read.parquet(f"{sf}/documents.parquet"))
    want = con.sql(fill_middle.ORACLE)
    assert sorted(map(tuple, got.collect())) == sorted(want.select(*got.columns).fetchall())


def test_a_damaged_output_is_not_restored():
    with pytest.raises(ValueError, match="without"):
        fill_middle.restore("<P>a<S>b", "psm")
    with pytest.raises(ValueError, match="begin"):
        fill_middle.restore("x<P>a<S>b<M>c", "psm")
