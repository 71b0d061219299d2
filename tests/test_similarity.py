"""Name similarity against plain loops over all pairs."""

import random
import re
import unicodedata
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from curio.operators import candidates, matching, ratio
from curio.plans.registry import Data

c = F.col


def plain_fold(s):
    s = "".join(x for x in unicodedata.normalize("NFKD", s or "") if not unicodedata.combining(x)).casefold()
    return re.sub("[^a-z0-9]+", " ", s).strip()


def plain_similarity(expected, observed):
    expected = re.split(r"\s+-\s+(?:Playa |Cahuita|Manzanillo|Puerto Viejo|Hone Creek|Sixaola|Gandoca|Punta Uva|Lim[oó]n|Costa Rica)", expected, maxsplit=1)[0].strip()
    a, b = plain_fold(expected), plain_fold(observed)
    if not a or not b:
        return 0.0
    x, y = set(a.split()), set(b.split())
    return round(max(SequenceMatcher(None, a, b).ratio(), len(x & y) / max(1, len(x))), 3)


def test_similarity_equals_a_loop_over_all_pairs(spark):
    """All pairs of names of sf0.01's two lists, every name once."""
    q = Data(spark, "/root/testdata/sf0.01")
    left = sorted({r[0] for r in q.master.select("business_name").collect()})[:260] + ["Casa - Cahuita, Limón", "Hotel - Nowhere", "", "É ß Ñandú"]
    right = sorted({r[0] for r in q.second.select("name").collect()}) + ["", "casa", "E SS nandu"]
    pairs = [(a, b) for a in left for b in right]
    df = spark.createDataFrame(pairs, "x string, y string").repartition(4).select("x", "y", ratio.plain(ratio.without_place(c("x"))).alias("a"), ratio.plain(c("y")).alias("b"))
    got = df.select("x", "y", ratio.similarity(c("a"), c("b")).alias("v"), ratio.ratio_from(0.82, c("a"), c("b")).alias("r"), ratio.most(ratio.letters(c("a")), ratio.letters(c("b"))).alias("m"), "a", "b").collect()
    for r in got:
        assert r.v == pytest.approx(plain_similarity(r.x, r.y), abs=1e-9), r
        exact = SequenceMatcher(None, r.a, r.b).ratio()
        assert r.r == (exact if exact >= 0.82 else None) and r.m >= exact - 1e-12
    assert sum(r.v == 1 for r in got) > 3 and sum(r.r is not None for r in got) > 100


def plain_compared(a, b):
    stop = {"puerto", "viejo", "playa", "costa", "rica", "limon", "de", "la", "the", "and"}
    if len(b) >= 4 and (b in a or a in b):
        return "match", 0.95
    x, y = ({t for t in s.split() if len(t) > 2 and t not in stop} for s in (a, b))
    return ("probable_match", 0.75) if x | y and len(x & y) / len(x | y) >= 0.5 else ("mismatch", 0.8)


def test_compared_names(spark):
    names = ["", "la", "casa azul", "casa azul verde", "casa del sol", "the blue house", "blue house puerto viejo", "spa", "hotel luna", "luna hotel playa"]
    pairs = [(a, b) for a in names for b in names]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", ratio.compared(c("a"), c("b")).alias("v")).collect()
    assert all((r.v.label, r.v.confidence) == plain_compared(r.a, r.b) for r in got)


def names_of(rng, n, hot):
    words = ["sol", "luna", "mar", "ab", "x", "casita", "azulejo", "azul", "12", "1", "verde"]
    return sorted({" ".join(([hot] if hot else []) + [rng.choice(words) for _ in range(rng.randint(1, 5))]) for _ in range(n)})


@pytest.mark.parametrize("hot", ["casa", ""])
def test_candidates_miss_no_similar_name(spark, hot):
    """Also where every name holds the same token, and where names are parts of others in the middle of words."""
    rng = random.Random(len(hot))
    left, right = names_of(rng, 160, hot), names_of(rng, 120, hot) + ["asa sol", "sol l", "casa"]
    table = lambda names: spark.createDataFrame(list(enumerate(names)), "id long, name string")
    got = {(r.l_name, r.r_name) for r in candidates.similar_candidates(table(left), table(right)).collect()}
    want = set()
    for a in left:
        for b in right:
            x, y = set(a.split()), set(b.split())
            i, m = len(x & y), min(len(x), len(y))
            shares = bool(x & {t for t in b.split()})
            if shares and (i / len(x | y) >= 0.5 or a in b or b in a or i >= (m if m <= 2 else m - 1) or i >= 0.6 * m):
                want.add((a, b))
    assert want <= got and len(got) < len(left) * len(right)
    heads = lambda b: [t for t in b.split() if len(t) > 2][:2]
    best = {}
    for a in left:
        for k, b in enumerate(right):
            x, y = set(a.split()), set(b.split())
            if any(t in x for t in heads(b)):
                m = min(len(x), len(y))
                s = max(len(x & y) / len(x | y), 0.7 if a in b or b in a or len(x & y) >= (m if m <= 2 else m - 1) else 0)
                if s >= 0.5 and (a not in best or (-s, k) < best[a]):
                    best[a] = (-s, k)
    found = {r.l: (-r.score, r.r) for r in matching.best_match(table(left), table(right)).collect()}
    assert found == {i: pytest.approx(best[a]) for i, a in enumerate(left) if a in best}
    with pytest.raises(ValueError):
        candidates.similar_candidates(table(left), table(right), 0.3)


def test_a_token_in_every_name_makes_no_pairs(spark):
    """Names that share nothing but one hot token are no candidates: their number does not grow with the square of the names."""
    left = spark.range(3000).selectExpr("id", "concat('hotel a', id, ' x', id) AS name")
    right = spark.range(3000).selectExpr("id", "concat('hotel b', id, ' y', id) AS name")
    assert candidates.similar_candidates(left, right).count() < 3000
