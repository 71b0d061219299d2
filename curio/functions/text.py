"""Column functions for names, identifiers, phones, links and labels. Missing text is the empty string throughout."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Letters with accents and the plain ones they fold to.
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçýÿÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇÝ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncyyAAAAAAEEEEIIIIOOOOOUUUUNCY"

COUNTRY_PREFIX = "506"
PLATFORM_HOSTS = ("facebook.com", "instagram.com", "wa.me", "booking.com", "tripadvisor.com", "google.com", "linktr.ee")


def clean(c: Column) -> Column:
    """Trimmed text, missing as the empty string."""
    return F.trim(F.coalesce(c.cast("string"), F.lit("")))


def present(c: Column) -> Column:
    return F.length(clean(c)) > 0


def strip_accents(c: Column) -> Column:
    return F.translate(c, ACCENTED, PLAIN)


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Compatibility composition (NFKC); no built-in function has it. Plain ASCII is left alone."""
    return pd.Series([x if x is None or x.isascii() else unicodedata.normalize("NFKC", x) for x in s], dtype=object)


def norm_text(c: Column) -> Column:
    """NFKC, lower case, runs of white space as one blank."""
    return F.trim(F.regexp_replace(F.lower(nfkc(clean(c))), r"(?U)\s+", " "))


def norm_name(c: Column) -> Column:
    """norm_text without punctuation; letters of any script stay."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(clean(c)), r"[^\p{L}\p{N}_\s]", ""), r"\s+", " "))


def fold(c: Column) -> Column:
    """Comparison key: no place suffix behind ' - ', no accents, lower case, other signs as blanks."""
    head = F.regexp_replace(clean(c), r"\s+-\s+.*$", "")
    return F.trim(F.regexp_replace(F.lower(strip_accents(head)), r"[^a-z0-9]+", " "))


def digits(c: Column) -> Column:
    return F.regexp_replace(clean(c), r"[^0-9]", "")


def phone_e164(c: Column) -> Column:
    """+ and 10 to 15 digits; local 8-digit numbers get the country prefix; anything else is empty."""
    d = digits(c)
    d = F.when(F.length(d) == 8, F.concat(F.lit(COUNTRY_PREFIX), d)).otherwise(d)
    return F.when(F.length(d).between(10, 15), F.concat(F.lit("+"), d)).otherwise("")


def phone_local(c: Column) -> Column:
    """The older rule: prefixes by how the number begins, and the country prefix before any longer one."""
    raw = F.regexp_extract(clean(c), r"[+(]?[0-9][0-9\s()+-]*", 0)  # the number without labels before and behind it
    s, d = F.regexp_replace(raw, r"[\s\-()]", ""), F.regexp_replace(raw, r"[^0-9]", "")
    return (
        F.when(~present(c), "").when(s.startswith("506") & (F.length(s) >= 11), F.concat(F.lit("+"), s)).when(s.startswith("+506"), s)
        .when(s.startswith("00"), F.concat(F.lit("+"), F.substring(s, F.lit(3), F.length(s)))).when(s.startswith("0"), F.concat(F.lit("+506"), F.substring(s, F.lit(2), F.length(s))))
        .when(F.length(d) == 8, F.concat(F.lit("+506"), d)).when((F.length(d) > 8) & d.startswith("506"), F.concat(F.lit("+"), d))
        .when(F.length(d) > 8, F.concat(F.lit("+506"), d)).otherwise(clean(c))
    )


def phone_tail(c: Column) -> Column:
    """The last eight digits, where there are eight."""
    d = digits(c)
    return F.when(F.length(d) >= 8, F.right(d, F.lit(8))).otherwise("")


def whatsapp(c: Column) -> Column:
    """Destination of an explicit WhatsApp field; never inferred from a phone."""
    linked = F.regexp_extract(clean(c), r"(?:phone=|wa\.me/)([0-9]{8,15})", 1)
    d = F.when(linked != "", linked).otherwise(digits(c))
    d = F.when(F.length(d) == 8, F.concat(F.lit(COUNTRY_PREFIX), d)).otherwise(d)
    return F.when(F.length(d).between(10, 15), F.concat(F.lit("+"), d)).otherwise("")


def route(number: Column) -> Column:
    return F.when(number.rlike(r"^\+[0-9]{10,15}$"), F.concat(F.lit("https://wa.me/"), F.substring(number, F.lit(2), F.length(number)))).otherwise("")


def handle(c: Column) -> Column:
    h = F.regexp_replace(clean(c), "^@+", "")
    return F.when(h.rlike(r"^[A-Za-z0-9._]{1,30}$"), h).otherwise("")


def handle_norm(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(clean(c), "^@+|@+$", ""), r"[^a-zA-Z0-9_.]", "")


def handle_key(c: Column) -> Column:
    """Handle from a profile link, lower case."""
    return F.lower(F.regexp_extract(clean(c), r"(?i)instagram\.com/([A-Za-z0-9._]+)", 1))


def https_url(c: Column) -> Column:
    """Links with https and a host stay, all others are dropped (http is not upgraded)."""
    u = clean(c)
    return F.when(u.rlike(r"^https://[^/?#]+"), u).otherwise("")


def url_scheme(c: Column) -> Column:
    u = clean(c)
    return F.when((u != "") & ~u.rlike(r"^https?://"), F.concat(F.lit("https://"), u)).otherwise(u)


def url_norm(c: Column) -> Column:
    return F.lower(F.regexp_replace(clean(c), "/+$", ""))


def host(c: Column) -> Column:
    h = F.lower(F.regexp_extract(clean(c), r"^[A-Za-z]+://([^/?#:]+)", 1))
    return F.regexp_replace(h, r"^www\.", "")


def host_key(c: Column) -> Column:
    h = host(c)
    return F.when(h.isin(*PLATFORM_HOSTS), "").otherwise(h)


def slug(name: Column, area: Column, size: int = 80) -> Column:
    s = F.regexp_replace(F.lower(F.concat(clean(name), F.lit("-"), clean(area))), r"[^a-z0-9]+", "-")
    return F.substring(F.regexp_replace(s, "^-+|-+$", ""), 1, size)


def id_md5(name: Column, cid: Column, phone: Column) -> Column:
    return F.substring(F.md5(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in (name, cid, phone)]).cast("binary")), 1, 12)


def id_sha(name: Column, area: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in (name, area)]), 256), 1, 16)


def semantic_key(cid: Column, name: Column, area: Column) -> Column:
    return F.when(present(cid), F.concat(F.lit("cid:"), clean(cid))).otherwise(F.concat(F.lit("record:"), id_sha(name, area)))


def display_name(name: Column, area: Column, places: str) -> Column:
    """Name without place suffixes; `places` is a regular expression of known places in lower case."""

    def cut(n: Column) -> Column:
        right = F.lower(F.regexp_extract(n, r"^.*? - (.*)$", 1))
        return F.when(right.rlike(places) | ((right != "") & right.contains(F.lower(area))), F.trim(F.regexp_extract(n, r"^(.*?) - ", 1))).otherwise(n)

    n = cut(cut(clean(name)))
    n = F.trim(F.regexp_replace(n, r"(?i)[,–—\- ]*Costa Rica$", ""))
    last = F.lower(F.regexp_extract(n, r"^.*,\s*([^,]*)$", 1))
    n = F.when((last != "") & (last.rlike(f"^(?:{places})$") | (last == F.lower(area))), F.trim(F.regexp_replace(n, r"\s*,[^,]*$", ""))).otherwise(n)
    n = F.trim(F.regexp_replace(n, r"[\s,–—-]+$", ""))
    return F.when(n != "", n).otherwise(clean(name))


def strip_suffix(c: Column, suffixes: list[str]) -> Column:
    """Text without one of the given endings."""
    quoted = "|".join(s.replace("|", r"\|").replace(".", r"\.") for s in suffixes)
    return F.trim(F.regexp_replace(clean(c), f"(?:{quoted})$", ""))


def label(c: Column, names: dict[str, str]) -> Column:
    """A code's label, else the code in title case."""
    out = F.initcap(F.regexp_replace(clean(c), "_", " "))
    for k, v in names.items():
        out = F.when(clean(c) == k, v).otherwise(out)
    return out


def snippet(text: Column, needle: Column, width: int = 40) -> Column:
    """The first occurrence with its surroundings, marked; empty if there is none."""
    at = F.instr(text, needle)
    lo = F.greatest(F.lit(1), at - width)
    before, after = F.substring(text, lo, at - lo), F.substring(text, at + F.length(needle), F.lit(width))
    lead = F.when(lo > 1, "…").otherwise("")
    tail = F.when(at + F.length(needle) + width <= F.length(text), "…").otherwise("")
    return F.when(at > 0, F.concat(lead, before, F.lit("«"), needle, F.lit("»"), after, tail)).otherwise("")


def url_encode(c: Column) -> Column:
    return F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))


def message_link(number: Column, name: Column, template: str) -> Column:
    """wa.me link with a message; {name} in the template is the name."""
    text = F.replace(F.lit(template), F.lit("{name}"), name)
    return F.when(number != "", F.concat(route(number), F.lit("?text="), url_encode(text))).otherwise("")


def join_items(items: Column) -> Column:
    """'a', 'a and b', 'a, b, and c'."""
    n = F.size(items)
    return F.when(n == 0, "").when(n == 1, items[0]).when(n == 2, F.concat(items[0], F.lit(" and "), items[1])).otherwise(
        F.concat(F.array_join(F.slice(items, F.lit(1), n - 1), ", "), F.lit(", and "), F.element_at(items, -1))
    )


def article(c: Column) -> Column:
    return F.when(F.lower(c).rlike("^[aeiou]"), "an").otherwise("a")


def amenity_key(c: Column) -> Column:
    """Key of an amenity's name: NFKC, letters and digits of any script, all else as one underscore."""
    s = F.lower(nfkc(F.regexp_replace(clean(c), r"(?i)wi[ -]?fi", "wifi")))
    s = F.regexp_replace(s, "&", " and ")
    return F.regexp_replace(F.regexp_replace(s, r"[^\p{L}\p{N}]+", "_"), "^_+|_+$", "")


def split_list(c: Column) -> Column:
    parts = F.transform(F.split(clean(c), r"[,;\n]"), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def tokens(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(c, " "), lambda x: x != ""))


def repair_mojibake(c: Column) -> Column:
    """Latin-1 text that is UTF-8 really; only where it shows and where every character has a Latin-1 byte."""
    # a cast does not look at the bytes; what is no UTF-8 after all becomes null and stays as it was
    fixed = F.try_validate_utf8(F.encode(F.regexp_replace(c, r"[^\x00-\xFF]", ""), "ISO-8859-1").cast("string"))
    return F.when(c.rlike("[ÃÂ]") & c.rlike(r"^[\x00-\xFF]*$"), F.coalesce(fixed, c)).otherwise(c)


def is_auto_description(c: Column, templates: str) -> Column:
    return present(c) & ((F.length(clean(c)) < 100) | F.lower(c).rlike(templates))
