"""Multi-label classification of directory records with evidence, groups, synonyms and contradictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curio.functions.text import nfkc
from curio.operators.relations import pinned

# Groups and tag of a primary category, groups of a tag, words by which a group is searched, and labels of tags that
# are not just the tag with blanks.
PRIMARY_GROUPS = {
    "hotel": ["stay"], "hostel": ["stay"], "vacation_rental": ["stay"], "restaurant": ["eat"], "tour_company": ["things-to-do"], "shopping": ["shopping"],
    "wellness": ["wellness"], "nightlife": ["nightlife", "eat"], "transport": ["transport"], "services": ["services"], "real_estate": ["services"],
}
PRIMARY_TAGS = {
    "hotel": "hotel", "hostel": "hostel", "vacation_rental": "vacation-rental", "restaurant": "restaurant", "tour_company": "tour-operator", "shopping": "shop",
    "wellness": "wellness", "nightlife": "nightlife", "transport": "transport", "services": "local-service", "real_estate": "real-estate",
}
TAG_GROUPS = {
    "hotel": ["stay"], "hostel": ["stay"], "vacation-rental": ["stay"], "bed-and-breakfast": ["stay"], "ecolodge": ["stay"], "cabins": ["stay"],
    "restaurant": ["eat"], "cafe": ["eat"], "bakery": ["eat"], "ice-cream": ["eat"], "bar": ["eat", "nightlife"], "grocery": ["shopping"],
    "tour-operator": ["things-to-do"], "surf": ["things-to-do"], "diving": ["things-to-do"], "snorkeling": ["things-to-do"], "kayaking": ["things-to-do"],
    "fishing": ["things-to-do"], "wildlife": ["things-to-do"], "yoga": ["wellness", "things-to-do"], "massage": ["wellness"], "spa": ["wellness"], "gym": ["wellness"],
    "shop": ["shopping"], "clothing": ["shopping"], "pharmacy": ["shopping", "services"], "supermarket": ["shopping"], "local-service": ["services"],
    "real-estate": ["services"], "laundry": ["services"], "medical": ["services", "wellness"], "dental": ["services", "wellness"], "beauty": ["services", "wellness"],
    "veterinary": ["services"], "pet-care": ["services"], "banking": ["services"], "nightlife": ["nightlife"], "live-music": ["nightlife"],
    "transport": ["transport"], "shuttle": ["transport"], "taxi": ["transport"], "car-rental": ["transport"],
}
SYNONYMS = {
    "stay": ["stay", "stays", "lodging", "accommodation", "places to stay", "hospedaje", "alojamiento"],
    "eat": ["eat", "drink", "food", "dining", "restaurants", "comer", "bebidas"],
    "things-to-do": ["things to do", "activities", "tours", "adventures", "actividades", "paseos"],
    "shopping": ["shopping", "shops", "stores", "tiendas", "compras"],
    "wellness": ["wellness", "health", "bienestar", "salud"],
    "services": ["services", "local services", "servicios"],
    "nightlife": ["nightlife", "evening", "bars", "vida nocturna"],
    "transport": ["transport", "transportation", "getting around", "transporte"],
}
LABELS = {"bed-and-breakfast": "bed & breakfast", "cafe": "café", "tour-operator": "tours"}

# Patterns of each tag, in order, and categories in which a tag is not given.
RULES = {
    "hotel": [r"\bhotel\b", r"\blodge\b", r"\bposada\b"],
    "hostel": [r"\bhostel\b", r"\balbergue\b"],
    "vacation-rental": [r"\bvacation rental\b", r"\bholiday home\b", r"\bapartments?\b", r"\bvillas?\b", r"\bguest\s*house\b", r"\bcasitas\b", r"\balojamiento\b", r"\bhospedaje\b"],
    "bed-and-breakfast": [r"\bbed\s*(?:&|and)\s*breakfast\b", r"\bb\s*&\s*b\b"],
    "ecolodge": [r"\beco[ -]?lodge\b", r"\becological lodge\b"],
    "cabins": [r"\bcabinas?\b", r"\bcabins?\b", r"\bcabañas?\b"],
    "cafe": [r"\bcaf[eé]\b", r"\bcafeter[ií]a\b", r"\bcoffee shop\b"],
    "bakery": [r"\bbakery\b", r"\bpanader[ií]a\b", r"\bpasteler[ií]a\b"],
    "ice-cream": [r"\bice cream\b", r"\bhelader[ií]a\b", r"\bgelato\b"],
    "bar": [r"\bbar\b", r"\bpub\b", r"\bcocktail(?:s)?\b"],
    "supermarket": [r"\bsupermarket\b", r"\bsupermercado\b"],
    "grocery": [r"\bgrocery\b", r"\btienda de comestibles\b"],
    "surf": [r"\bsurf(?:ing)?\b", r"\bsurf school\b", r"\bescuela de surf\b"],
    "diving": [r"\bscuba\b", r"\bdiv(?:e|ing)\b", r"\bbuceo\b"],
    "snorkeling": [r"\bsnorkel(?:ing)?\b"],
    "kayaking": [r"\bkayak(?:ing)?\b"],
    "fishing": [r"\bfishing\b", r"\bpesca\b"],
    "wildlife": [r"\bwildlife\b", r"\banimal rescue\b", r"\brescate animal\b"],
    "yoga": [r"\byoga\b", r"\bacroyoga\b"],
    "massage": [r"\bmassage\b", r"\bmasajes?\b"],
    "spa": [r"\bspa\b"],
    "gym": [r"\bgym\b", r"\bgimnasio\b", r"\bfitness\b"],
    "clothing": [r"\bclothing\b", r"\btienda de ropa\b", r"\bropa\b"],
    "pharmacy": [r"\bpharmacy\b", r"\bfarmacia\b"],
    "real-estate": [r"\breal estate\b", r"\bbienes ra[ií]ces\b", r"\binmobiliaria\b"],
    "laundry": [r"\blaundry\b", r"\blavander[ií]a\b"],
    "veterinary": [r"\bveterinari[ao]\b", r"\bvet clinic\b", r"\bvet\b", r"\bveterinary\b"],
    "pet-care": [r"\bpet care\b", r"\bgrooming\b", r"\bmascotas?\b", r"\bdog (?:grooming|boarding|daycare)\b", r"\bgroomer\b"],
    "medical": [r"\bmedical\b", r"\bclinic(?:a)?\b(?!\s*veterinari)", r"\bcl[ií]nica\b(?!\s*veterinari)", r"\bdoctor(?:s)?\b"],
    "dental": [r"\bdent(?:al|ist)\b", r"\bdentista\b", r"\bodontolog"],
    "beauty": [r"\bbeauty\b", r"\bsalon\b", r"\bsal[oó]n\b", r"\bbarber"],
    "banking": [r"\bbank\b", r"\bbanco\b", r"\batm\b", r"\bcajero\b"],
    "live-music": [r"\blive music\b", r"\bm[uú]sica en vivo\b"],
    "shuttle": [r"\bshuttle\b", r"\btransfer(?:s)?\b"],
    "taxi": [r"\btaxi\b"],
    "car-rental": [r"\bcar rental\b", r"\brent a car\b", r"\balquiler de (?:autos|carros|coches)\b"],
}
ACTIVITIES, ELSEWHERE = ("surf", "diving", "snorkeling", "kayaking", "fishing", "wildlife"), ["restaurant", "hotel", "vacation_rental", "hostel", "shopping", "services", "real_estate", "wellness"]
NO_ANIMALS = ["restaurant", "hotel", "vacation_rental", "hostel", "shopping"]
EXCLUDED = {t: ELSEWHERE for t in ACTIVITIES} | {"gym": ["restaurant", "shopping"], "veterinary": NO_ANIMALS, "pet-care": NO_ANIMALS}

# Sources in order of precedence, with confidence; those that say what a record is, not what it has.
SOURCES = [("master.name", "business_name", 0.96), ("master.description", "description_full", 0.92), ("maps.subcategory", "subcategory", 0.90), ("maps.cuisine", "cuisine", 0.90), ("maps.amenities", "amenities", 0.90)]
IDENTITY = ["master.category", "master.name", "maps.subcategory", "maps.cuisine"]
LODGING = ["hotel", "hostel", "vacation_rental"]

_GAP = "\x1f"
_ASSERTION = "struct<tag:string,confidence:double,source:string,rule:string,evidence:string>"


def _table(d: dict) -> Column:
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v))])


def _assertion(tag: Column, sure: Column, source: Column, rule: Column, evidence: Column) -> Column:
    return F.struct(tag.alias("tag"), sure.alias("confidence"), source.alias("source"), rule.alias("rule"), evidence.alias("evidence"))


def assertions(df: DataFrame) -> DataFrame:
    """df with primary (category as a code) and assertions: per tag the first source, then the first pattern, that matches.

    All sources are normalised together (NFKC, lower case, single blanks). A record's own category asserts its tag with certainty.
    """
    raw = F.concat_ws(_GAP, *[F.coalesce(F.regexp_replace(F.col(c), _GAP, " "), F.lit("")) for c in ("category", *(c for _, c, _ in SOURCES))])
    df = pinned(df, _texts=F.transform(F.split(F.lower(nfkc(raw)), _GAP, -1), lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " "))))
    primary = F.replace(F.get("_texts", 0), F.lit(" "), F.lit("_"))
    df = pinned(df, primary=primary, _own=F.try_element_at(_table(PRIMARY_TAGS), primary), **{f"_t{i}": F.get("_texts", i + 1) for i in range(len(SOURCES))})
    first = []  # number of the first source that matches each rule
    for tag, patterns in RULES.items():
        out = F.lit(None).cast("int")
        for i in reversed(range(len(SOURCES))):
            out = F.when(F.col(f"_t{i}").rlike("(?U)" + "|".join(patterns)), i).otherwise(out)
        first.append(F.when(~F.col("primary").isin(EXCLUDED[tag]), out) if tag in EXCLUDED else out)
    df = pinned(df, _first=F.array(*first))
    names, sure = F.array(*[F.lit(n) for n, _, _ in SOURCES]), F.array(*[F.lit(x) for _, _, x in SOURCES])
    found = [F.when(F.col("_own").isNotNull(), _assertion(F.col("_own"), F.lit(1.0), F.lit("master.category"), F.concat(F.lit("primary:"), F.col("primary")), F.col("category")))]
    for n, (tag, patterns) in enumerate(RULES.items()):
        k = F.get("_first", n)
        text = F.get("_texts", k + 1)
        words = F.coalesce(*[F.nullif(F.regexp_extract(text, f"(?U){p}", 0), F.lit("")) for p in patterns])
        found.append(F.when(k.isNotNull() & ~F.col("_own").eqNullSafe(tag), _assertion(F.lit(tag), F.get(sure, k), F.get(names, k), F.lit(f"explicit:{tag}"), words)))
    df = pinned(df, assertions=F.array_compact(F.array(*[x.cast(_ASSERTION) for x in found])))
    return df.drop("_texts", "_own", "_first", *[f"_t{i}" for i in range(len(SOURCES))])


def _spread(table: dict, keys: Column) -> Column:
    return F.flatten(F.array_compact(F.transform(keys, lambda k: F.try_element_at(_table(table), k))))


def records(df: DataFrame) -> DataFrame:
    """assertions with tags, attributes, groups, synonyms (sorted), conflicts and review_state."""
    df = assertions(df)
    tags = lambda keep: F.array_sort(F.array_distinct(F.transform(F.filter("assertions", keep), lambda a: a["tag"])))
    df = pinned(df, tags=tags(lambda a: a["source"].isin(IDENTITY)), attributes=tags(lambda a: ~a["source"].isin(IDENTITY)))
    df = pinned(df, groups=F.array_sort(F.array_distinct(F.concat(_spread(PRIMARY_GROUPS, F.array("primary")), _spread(TAG_GROUPS, F.col("tags"))))))
    labels = F.transform(F.concat("tags", "attributes"), lambda t: F.coalesce(F.try_element_at(_table(LABELS), t), F.replace(t, F.lit("-"), F.lit(" "))))
    df = df.withColumn("synonyms", F.array_sort(F.array_distinct(F.concat(_spread(SYNONYMS, F.col("groups")), labels))))
    has = lambda *g: F.arrays_overlap("groups", F.array(*map(F.lit, g)))
    p = F.col("primary")
    df = df.withColumn("conflicts", _conflicts({
        "missing_primary_category": p == "", "no_discovery_group": F.size("groups") == 0, "restaurant_with_lodging_evidence": (p == "restaurant") & has("stay"),
        "restaurant_with_non_food_identity": (p == "restaurant") & has("wellness", "services", "transport"), "lodging_with_food_evidence": p.isin(LODGING) & has("eat"),
        "tour_company_with_transport_identity": (p == "tour_company") & has("transport"),
    }))
    return df.withColumn("review_state", F.when(F.size("conflicts") > 0, "review").otherwise("accepted_deterministic"))


def _conflicts(rules: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(c, n) for n, c in rules.items()]))


def recommendation(r: DataFrame) -> Column:
    """What a reviewer is told about a record's primary category."""
    p, has, tag = F.col("primary"), lambda g: F.array_contains("groups", g), lambda t: F.array_contains("tags", t)
    stay = F.when(tag("hostel"), "hostel").when(tag("bed-and-breakfast") | tag("hotel"), "hotel").otherwise("vacation_rental")
    return (
        F.when((p == "restaurant") & has("stay"), stay).when((p == "restaurant") & has("wellness"), "wellness").when((p == "tour_company") & has("transport"), "transport")
        .when(p.isin(LODGING) & has("eat"), "retain_lodging").otherwise("retain")
    )


# Signs of a workshop in a record that is tagged medical, and signs that it treats animals.
AUTOMOTIVE, ANIMALS = ["taller", "auto", "car ", "automotriz", "mecánico", "mecanico", "repair", "lubric", "tire", "llanta"], ["vet", "mascota"]


def suspicious(r: DataFrame) -> Column:
    """Tagged medical, but named or described as a workshop."""
    low = F.lower(F.concat_ws(" ", "business_name", "description_full"))
    any_of = lambda words: low.rlike("|".join(words))
    return F.array_contains(F.concat("tags", "attributes"), "medical") & any_of(AUTOMOTIVE) & ~any_of(ANIMALS)
