"""Column functions for arrays, maps and nested records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once, wherever use looks at it."""
    return F.get(F.transform(F.array(value), use), 0)


def ordered_distinct(a: Column, keep: str | None = None, drop: str | None = None) -> Column:
    """Trimmed elements in order without repeats; `keep` and `drop` are patterns for the lower-case text."""
    x = F.transform(F.coalesce(a, F.array().cast("array<string>")), lambda v: F.trim(v))
    x = F.filter(x, lambda v: v != "")
    if keep:
        x = F.filter(x, lambda v: F.lower(v).rlike(keep))
    if drop:
        x = F.filter(x, lambda v: ~F.lower(v).rlike(drop))
    return F.array_distinct(x)


def valid_element(v: Column, keep: str, drop: str) -> Column:
    return F.lower(v).rlike(keep) & ~F.lower(v).rlike(drop)


def add_unique(a: Column, v: Column) -> Column:
    """a with v at its end, unless v is empty or there by its comparison form (case, closing slashes)."""
    form = lambda x: F.lower(F.regexp_replace(F.trim(x), "/+$", ""))
    return F.when((F.trim(v) == "") | F.exists(a, lambda x: form(x) == form(v)), a).otherwise(F.concat(a, F.array(v)))


def facets(tags: Column, attributes: Column, primary: Column, most: int = 6) -> Column:
    return F.slice(F.array_except(F.array_union(tags, attributes), primary), 1, most)


def values_of(fields: Column) -> Column:
    """Map of {value, ...} structs to a map of values."""
    return F.transform_values(fields, lambda _, v: v["value"])


def tag_category(tags: Column, rules: list[tuple[str, str | None, str]], none: str = "other") -> Column:
    """Category of a tag map by the first rule (key, value or None for any, category)."""
    out = F.lit(none)
    for k, v, cat in reversed(rules):
        has = F.map_contains_key(tags, k) if v is None else F.coalesce(F.try_element_at(tags, F.lit(k)) == v, F.lit(False))
        out = F.when(has, cat).otherwise(out)
    return out


def order_by_table(a: Column, table: list[str]) -> Column:
    """Elements in the table's order, others behind, by name."""
    known = F.array(*map(F.lit, table))
    ranked = F.transform(a, lambda x: F.struct(F.when(F.array_position(known, x) > 0, F.array_position(known, x)).otherwise(len(table) + 1).alias("k"), x.alias("x")))
    return F.transform(F.array_sort(ranked), lambda r: r["x"])


def clean_group(a: Column, aliases: dict[str, str]) -> Column:
    """Elements without repeats by folded form; an alias goes where its main form is there."""
    from curio.functions.text import strip_accents

    form = lambda x: F.lower(strip_accents(F.trim(x)))
    folded = F.transform(a, form)
    first = F.filter(a, lambda x, i: F.array_position(folded, form(x)) == i + 1)
    out = first
    for alias, main in aliases.items():
        out = F.filter(out, lambda x: ~((form(x) == alias) & F.array_contains(folded, main)))
    return out
