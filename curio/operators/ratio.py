"""Similarity of names by matching blocks (Ratcliff-Obershelp) and by shared tokens, with bounds that spare most of that work.

Letters are counted once per name and compared by built-in functions: two names cannot have more in common than the smaller count
of each letter. Python sees only pairs whose bound may change the result; within a batch they are ordered by the second name,
whose index is built once.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from curio.functions import text as T
from curio.operators.matching import unicode_fold

SIGNS = "abcdefghijklmnopqrstuvwxyz0123456789 "  # of folded names
# How a place suffix behind a name begins, and words that tell no places apart.
PLACES = ("Playa ", "Cahuita", "Manzanillo", "Puerto Viejo", "Hone Creek", "Sixaola", "Gandoca", "Punta Uva", "Limón", "Limon", "Costa Rica")
COMMON = ("puerto", "viejo", "playa", "costa", "rica", "limon", "de", "la", "the", "and")


@F.pandas_udf(DoubleType())
def block_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratio of each pair; null where either is null. No built-in function has it."""
    out: list[float | None] = [None] * len(a)
    left, right = a.tolist(), b.tolist()
    m = SequenceMatcher(None)
    last = None
    for i in sorted((i for i in range(len(left)) if left[i] is not None and right[i] is not None), key=right.__getitem__):
        if right[i] != last:
            last = right[i]
            m.set_seq2(last)
        m.set_seq1(left[i])
        out[i] = m.ratio()
    return pd.Series(out, dtype="Float64")


def plain(c: Column) -> Column:
    """Compatibility forms without marks, case-folded, other signs than a-z and 0-9 as single blanks."""
    return F.trim(F.regexp_replace(unicode_fold(T.clean(c)), "[^a-z0-9]+", " "))


def without_place(c: Column, places: tuple[str, ...] = PLACES) -> Column:
    """A name up to the first dash that a place stands behind, with mojibake repaired."""
    return F.trim(F.split(T.repair_mojibake(T.clean(c)), r"\s+-\s+(?:" + "|".join(places) + ")", 2)[0])


def letters(name: Column) -> Column:
    """How often each of SIGNS occurs in a folded name; to be kept beside it."""
    return F.transform(F.array(*map(F.lit, SIGNS)), lambda s: F.length(name) - F.length(F.replace(name, s, F.lit(""))))


def most(a: Column, b: Column) -> Column:
    """A ratio's upper bound, from the letters of two folded names."""
    total = lambda x: F.aggregate(x, F.lit(0), lambda s, v: s + v)
    both = total(F.zip_with(a, b, lambda x, y: F.least(x, y)))
    whole = total(a) + total(b)
    return F.when(whole > 0, 2.0 * both / whole).otherwise(1.0)


def ratio_from(least: float, a: Column, b: Column, bound: Column | None = None) -> Column:
    """Ratio of folded names where it is `least` or more, else null."""
    bound = bound if bound is not None else most(letters(a), letters(b))
    maybe = bound >= least
    r = block_ratio(F.when(maybe, a), F.when(maybe, b))
    return F.when(r >= least, r)


def similarity(expected: Column, observed: Column) -> Column:
    """Of folded names: the greater of the ratio and of the share of the expected name's tokens that the other has; three places."""
    own, other = T.tokens(expected), T.tokens(observed)
    shared = F.size(F.array_intersect(own, other)) / F.greatest(F.size(own), F.lit(1))
    unsure = most(letters(expected), letters(observed)) > shared
    ratio = block_ratio(F.when(unsure, expected), F.when(unsure, observed))
    return F.when((expected == "") | (observed == ""), 0.0).otherwise(F.bround(F.greatest(shared, F.coalesce(ratio, F.lit(0.0))), 3))


def compared(expected: Column, displayed: Column, common: tuple[str, ...] = COMMON) -> Column:
    """(label, confidence) of plain names: containment, half of the telling words, or neither."""
    words = lambda c: F.filter(T.tokens(c), lambda w: (F.length(w) > 2) & ~w.isin(*common))
    inside = (F.length(displayed) >= 4) & (F.contains(expected, displayed) | F.contains(displayed, expected))
    x, y = words(expected), words(displayed)
    union = F.size(F.array_union(x, y))
    half = 2 * F.size(F.array_intersect(x, y)) >= union
    told = lambda label, confidence: F.struct(F.lit(label).alias("label"), F.lit(confidence).alias("confidence"))
    return F.when(inside, told("match", 0.95)).when((union > 0) & half, told("probable_match", 0.75)).otherwise(told("mismatch", 0.8))
