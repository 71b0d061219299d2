"""Surrogates against a plain reading of the texts: what is found, one replacement for each entity, and formats."""

import ipaddress
import random

import pytest

regex = pytest.importorskip("regex")

from curio.llm import surrogates  # noqa: E402

FORMS = [
    lambda r: f"user{r.randint(1, 60)}@mail{r.randint(1, 5)}.example.com",
    lambda r: f"+1 (555) 123-{r.randint(1000, 1030)}",
    lambda r: f"+44 555 123 {r.randint(1000, 1030)}",
    lambda r: f"555-123-{r.randint(1000, 1030)}",
    lambda r: f"(555) 123-{r.randint(1000, 1030)}",
    lambda r: f"10.{r.randint(0, 255)}.{r.randint(0, 9)}.7",
    lambda r: f"2001:db8::{r.randint(0, 0xFFFF):x}",
    lambda r: f"AKIA{r.randint(0, 10**16 - 1):016d}",
    lambda r: f'token = "{r.randint(0, 16**20 - 1):020x}"',
    lambda r: f"password: hunter{r.randint(10, 40)}hunter",
    lambda r: "4111111111111111",
    lambda r: f"DE{r.randint(10, 99)} 3704 0044 0532 0130 {r.randint(10, 30)}",
    lambda r: f"{r.randint(100, 120)}-45-6789",
    lambda r: "1234567890123456",
]
PLAIN = ["and", "then,", "x7", "3.14", "Anna", "end.", "é", "line\nbreak", "12-34", "\x01", "\x02a"]


def key_of(kind, ent):
    digits = regex.sub(r"[^0-9]", "", ent)
    if kind == "PHONE":
        return digits if ent.startswith("+") or len(digits) != 10 else f"1{digits}"
    if kind == "SECRET":
        return regex.sub(surrogates.ASSIGNED, "", ent)
    return ent.lower() if kind in ("EMAIL", "IPV6") else digits if kind in ("CARD", "SSN") else ent.replace(" ", "") if kind == "IBAN" else ent


def shape(kind, s):
    """Classes of characters; letters of hexadecimal numbers count as digits."""
    low = "0" if kind in ("SECRET", "IPV6") else "a"
    return regex.sub("[0-9]", "0", regex.sub("[a-z]", low, regex.sub("[A-Z]", "A", s)))


def test_equals_a_plain_reading(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(FORMS)(rng) if rng.random() < 0.3 else rng.choice(PLAIN) for _ in range(rng.randint(0, 30))) for _ in range(150)] + [None, ""]
    texts += texts[:20]
    docs = spark.createDataFrame([(i % 140, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    rows = surrogates.pseudonymise(docs.withColumn("old", docs.text), key="k").collect()
    assert len(rows) == len(texts) and sorted(r.old or "" for r in rows) == sorted(t or "" for t in texts)
    found, entity = {}, regex.compile(surrogates.ANY)
    for r in rows:
        if r.old is None:
            assert r.text is None and r.pii_count == 0
            continue
        kinds, skeleton, at, places = [], "", 0, []
        for m in entity.finditer(r.old):
            kind = next(k for k, p in surrogates.PATTERNS.items() if regex.match(p if k != "SECRET" else surrogates.ASSIGNED, m[0]))
            if m[0] == "1234567890123456":
                continue
            kinds.append(kind)
            skeleton += regex.escape(r.old[at : m.start()]) + ("([0-9.]+)" if kind == "IP" else f"(.{{{len(m[0])}}})")
            places.append(m[0])
            at = m.end()
        assert r.pii_types == kinds and r.pii_count == len(kinds)
        got = regex.fullmatch(skeleton + regex.escape(r.old[at:]), r.text, regex.DOTALL)
        assert got, (r.old, r.text)
        for kind, old, new in zip(kinds, places, got.groups(), strict=True):
            found.setdefault((kind, key_of(kind, old)), set()).add((key_of(kind, new), old, new))
    images = {}
    for (kind, canon), news in found.items():
        images.setdefault((kind, *{k for k, _, _ in news}), set()).add(canon)  # one surrogate for each entity
        for new, old, shown in news:
            assert new != canon and (kind, new) not in found
            if kind not in ("IP", "IBAN"):
                assert shape(kind, shown) == shape(kind, old)
            if kind == "IBAN":
                assert int("".join(str(int(c, 36)) for c in new[4:] + new[:4])) % 97 == 1 and len(shown) == len(old) and new[:2] == canon[:2]
            if kind in ("IP", "IPV6"):
                ipaddress.ip_address(shown)
            if kind == "PHONE":
                assert new.startswith("1") == canon.startswith("1") and (canon.startswith("1") or new[:2] == canon[:2])
    assert all(len(k) == 2 and len(v) == 1 for k, v in images.items())  # distinct entities, distinct surrogates
    assert {k for k, _ in found} == set(surrogates.PATTERNS) - {"NAME"}


def test_names_are_one_person(spark):
    texts = ["Dr Anna Smith met Mrs Anna Smith. Later Anna Smith and SMITH left; Annabel Smithson stayed.", "Then Mr. John Doe came, and Doe spoke.", "Mr Doe again, Herr Karl Smith.", "Anna Smith alone, no title", "Госпожа Вера Попова и Попова"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = [r.text for r in sorted(surrogates.pseudonymise(docs, key="k").collect(), key=lambda r: r.doc_id)]
    w = got[0].replace(";", "").replace(".", "").split()
    given, family = w[1], w[2]
    assert given in surrogates.GIVEN["f_latin"].split() and w[5:7] == [given, family] and w[8:10] == [given, family] and w[11] == family.upper()
    assert "Annabel Smithson stayed." in got[0] and "Smith " not in got[0]
    doe = got[1].split()[3]
    assert got[1] == f"Then Mr. {got[1].split()[2]} {doe} came, and {doe} spoke." and doe != "Doe" and got[2].startswith(f"Mr {doe} again, Herr ") and got[2].split()[5] == f"{family}."
    assert got[3] == texts[3]
    assert got[4].split()[2] == got[4].split()[4] != "Попова"


def test_columns_that_clash(spark):
    docs = spark.createDataFrame([(1, "a@b.example.com", 7, "x", "y")], "doc_id bigint, text string, PII_COUNT int, pii_types string, `t.id` string")
    (r,) = surrogates.pseudonymise(docs, key="k").collect()
    assert r.asDict().keys() == {"doc_id", "text", "PII_COUNT", "pii_types", "t.id", "pii_count_", "pii_types_"}
    assert (r.PII_COUNT, r.pii_types, r["t.id"], r.pii_count_, r.pii_types_) == (7, "x", "y", 1, ["EMAIL"])
    with pytest.raises(TypeError):
        surrogates.pseudonymise(docs)


def one(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [r.text for r in sorted(surrogates.pseudonymise(docs, key="k").collect(), key=lambda r: r.doc_id)]


def test_names_of_all_forms(spark):
    long = "Wolfeschlegelsteinhausenbergerdorff" * 2
    got = one(
        spark, "Mr. Smith-Jones sat. Smith-Jones left, Smith-Hay stayed.", "Mr. Juan Carlos Perez went; Perez ate, Juan Perez slept.", "Mr. O'Brien and O'Brien's dog", "Dr. J. Smith said; Smith replied; J. Smith left",
        f"Frau {long} und {long}.", f"to {'x' * 90}@{'y' * 80}.example.com!", "Prof. Dr. Anna van der Berg, then Berg", "Mr. Park drove. The Park is closed. Park drove.", "call 555 123 4567 or 555-123-4567",
    )
    w = got[0].replace(".", " ").replace(",", " ").split()
    assert w[1] == w[3] and w[1].count("-") == 1 and "Smith-Jones" not in got[0] and w[5] == "Smith-Hay" and all(x[0].isupper() for x in w[1].split("-"))
    w = got[1].replace(";", "").replace(",", "").split()
    assert w[3] == w[5] == w[8] and w[1] == w[7] and not {"Juan", "Carlos", "Perez"} & set(w) and w[4] == "went"
    w = got[2].split()
    assert w[1][1] == "'" and w[3] == f"{w[1]}'s" and "Brien" not in got[2]
    w = got[3].replace(";", "").split()
    assert w[2] == w[4] == w[7] != "Smith" and w[1] == w[6] != "J." and len(w[1]) == 2
    assert "Wolf" not in got[4] and got[4].split()[1] == got[4].split()[3].rstrip(".")
    assert "xxxx" not in got[5] and got[5].endswith(".com!") and len(got[5]) == 90 + 80 + len("to @.example.com!")
    w = got[6].replace(",", "").split()
    assert w[:2] == ["Prof.", "Dr."] and w[3:5] == ["van", "der"] and w[5] == w[7] != "Berg" and w[2] != "Anna"
    assert "The Park is closed" in got[7] and got[7].count("Park") == 1
    assert got[8].split()[1:4] == got[8].split()[5].split("-") != ["555", "123", "4567"]


def test_country_codes_stay(spark):
    codes = ["+506 8888 7777", "+351 912 345 678", "+44 20 7946 0958", "+1 555 123 4567", "+7 495 123 45 67", "+420 123 456 789", "+34 91 234 56 78"]
    for old, new in zip(codes, one(spark, *codes), strict=True):
        assert new.split()[0] == old.split()[0] and new != old and [len(x) for x in new.split()] == [len(x) for x in old.split()]


def test_random_names_equal_a_plain_reading(spark):
    """Every name word changes as its entity does, wherever it stands; every other word stays."""
    rng = random.Random(12)
    given = ["Ann", "Bo", "Jean-Luc", "Zoë", "Ivy", "Åsa", "Élise", "Tom"]
    family = ["Stone", "O'Hara", "Day-Lewis", "Ng", "Müller", "Quill", "D'Arcy-Hall", "Vale"]
    titles = ["Mr.", "Mrs.", "Ms", "Dr.", "Herr", "Frau", "Prof.", "Prof. Dr."]
    plain = ["went", "and", "the", "river", "7", "stone", "said,", "to"]
    rows = []
    for _ in range(120):
        tokens, known = [], {}
        for _ in range(rng.randint(1, 4)):
            names, last = rng.sample(given, rng.randint(0, 3)), rng.choice(family)
            tokens += [(x, None) for x in rng.choice(titles).split()]
            for x in names:
                tokens.append((x, "GIVEN"))
                if rng.random() < 0.2:
                    tokens.append((rng.choice(["van", "de"]), None))
            tokens.append((last, "FAMILY"))
            known[last] = names
            tokens.append(("went", None))
            for _ in range(rng.randint(0, 6)):
                if rng.random() < 0.4:
                    who = rng.choice(list(known))
                    if known[who] and rng.random() < 0.5:
                        tokens.append((rng.choice(known[who]), "GIVEN"))
                    tokens.append((who, "FAMILY"))
                    tokens.append(("and", None))
                else:
                    word = rng.choice(plain)
                    if word == "the":
                        tokens += [("the", None), ("river", None)]
                    else:
                        tokens.append((word, None))
        rows.append(tokens)
    image = {}
    for tokens, new in zip(rows, one(spark, *[" ".join(w for w, _ in t) for t in rows]), strict=True):
        shown = new.split(" ")
        assert len(shown) == len(tokens), (tokens, new)
        for (word, kind), x in zip(tokens, shown, strict=True):
            if kind is None:
                assert x == word, (tokens, new)
            else:
                image.setdefault((kind, word), set()).add(x)
                assert x != word and x[0].isupper()
                if kind == "FAMILY":
                    assert [c for c in x if c in "'-"] == [c for c in word if c in "'-"]
    assert all(len(v) == 1 for v in image.values()) and len({(k, *v) for (k, _), v in image.items()}) == len(image)


def test_many_names_stay_names(spark):
    """Far more family names than the first round has: each gets one of its own, none a tag."""
    ents = spark.range(30_000).selectExpr("'FAMILY' AS kind", "concat('name', translate(cast(id AS string), '0123456789', 'abcdefghij')) AS canon")
    got = [r.surrogate for r in surrogates.assign(ents, "k").collect()]
    assert len(set(got)) == 30_000 and all(x.isalpha() for x in got)
