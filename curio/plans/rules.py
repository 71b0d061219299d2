"""Rule-based classification and data-quality audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from curio.functions import geo as G
from curio.functions import text as T
from curio.operators import audits as U
from curio.operators import classify as C
from curio.operators import quality as Q
from curio.operators import taxonomy as X
from curio.operators.relations import pinned, spread
from curio.plans.basics import CLOSED, NORM, PHONE, SLUG, WA
from curio.plans.ledgers import _folder
from curio.plans.registry import Data, query

c = F.col


def _norm(c: str) -> str:
    return f"trim(regexp_replace(lower({c}), '\\s+', ' ', 'g'))"


def _q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _pattern(p: str) -> str:
    """A rule's pattern for an engine whose word boundaries are those of ASCII: the word is group 1."""
    core, end = p.replace(r"(?!\s*veterinari)", ""), r"(?:$|[^\pL\pN_])"
    core = core[2:] if core.startswith(r"\b") else core
    return rf"(?:^|[^\pL\pN_])({core[:-2]}){end}" if core.endswith(r"\b") else rf"(?:^|[^\pL\pN_])({core})"


VETO = r"(?:^|[^\pL\pN_])cl[ií]nica?\s*veterinari"


def _hit(tag: str, patterns: list[str]) -> str:
    """SQL for what a rule finds in a text, or null."""
    text = f"regexp_replace(text, {_q(VETO)}, '', 'g')" if any("(?!" in p for p in patterns) else "text"
    words = ", ".join(f"nullif(regexp_extract({text}, {_q(_pattern(p))}, 1), '')" for p in patterns)
    banned = f"p NOT IN ({', '.join(map(_q, X.EXCLUDED[tag]))}) AND " if tag in X.EXCLUDED else ""
    return f"CASE WHEN {banned}own IS DISTINCT FROM '{tag}' AND coalesce({words}) IS NOT NULL THEN {{'tag': '{tag}', 'evidence': coalesce({words})}} END"


LISTED = ", ".join(f"{{'k': {k}, 'source': '{n}', 'sure': {sure}, 'text': {_norm(col)}}}" for k, (n, col, sure) in enumerate(X.SOURCES))


def _arms(d: dict) -> str:
    return " ".join(f"WHEN {_q(k)} THEN " + (f"[{', '.join(map(_q, v))}]" if isinstance(v, list) else _q(v)) for k, v in d.items())


EVIDENCE = f"""WITH x AS (SELECT id, category, replace({_norm('category')}, ' ', '_') AS p, list_filter([{LISTED}], lambda s: s.text <> '') AS ss FROM places ),
o AS (SELECT *, CASE p {_arms(X.PRIMARY_TAGS)} END AS own FROM x), y AS (SELECT id, p, own, unnest(ss) AS s FROM o), t AS (SELECT id, p, own, s.k AS k, s.source AS source, s.sure AS sure, s.text AS text FROM y),
e AS (SELECT id, k, source, sure, unnest(list_filter([{', '.join(_hit(t, ps) for t, ps in X.RULES.items())}], lambda h: h IS NOT NULL)) AS h FROM t),
m AS (SELECT id, source, sure, h.tag AS tag, h.evidence AS evidence, row_number() OVER (PARTITION BY id, h.tag ORDER BY k) AS n FROM e),
a AS (SELECT id, tag, CAST(sure AS DOUBLE) AS confidence, source, 'explicit:' || tag AS rule, evidence FROM m WHERE n = 1 UNION ALL SELECT id, own, 1.0, 'master.category', 'primary:' || p, category FROM o WHERE own IS NOT NULL)
"""
IDS = "('" + "', '".join(X.IDENTITY) + "')"
NONE = "CAST([] AS VARCHAR[])"
ASSEMBLED = EVIDENCE + f""", g AS (SELECT id, list(tag) FILTER (WHERE source IN {IDS}) AS t, list(tag) FILTER (WHERE source NOT IN {IDS}) AS b FROM a GROUP BY id),
f AS (SELECT o.id, p, list_sort(coalesce(t, {NONE})) AS tags, list_sort(coalesce(b, {NONE})) AS attributes FROM o LEFT JOIN g ON g.id = o.id),
h AS (SELECT *, list_sort(list_distinct(list_concat(CASE p {_arms(X.PRIMARY_GROUPS)} ELSE {NONE} END, flatten(list_transform(tags, lambda t: CASE t {_arms(X.TAG_GROUPS)} ELSE {NONE} END))))) AS groups FROM f),
z AS (SELECT *, list_sort(list_distinct(list_concat(flatten(list_transform(groups, lambda t: CASE t {_arms(X.SYNONYMS)} ELSE {NONE} END)), list_transform(list_concat(tags, attributes), lambda t: CASE t {_arms(X.LABELS)} ELSE replace(t, '-', ' ') END)))) AS synonyms,
  list_filter([CASE WHEN p = '' THEN 'missing_primary_category' END, CASE WHEN len(groups) = 0 THEN 'no_discovery_group' END, CASE WHEN p = 'restaurant' AND list_contains(groups, 'stay') THEN 'restaurant_with_lodging_evidence' END,
    CASE WHEN p = 'restaurant' AND list_has_any(groups, ['wellness', 'services', 'transport']) THEN 'restaurant_with_non_food_identity' END, CASE WHEN p IN ('hotel', 'hostel', 'vacation_rental') AND list_contains(groups, 'eat') THEN 'lodging_with_food_evidence' END,
    CASE WHEN p = 'tour_company' AND list_contains(groups, 'transport') THEN 'tour_company_with_transport_identity' END], lambda x: x IS NOT NULL) AS conflicts FROM h)
"""


def _records(q: Data):
    return X.records(spread(q.places))


def _joined(q: Data, *names: str):
    return _records(q).select("id", *[F.array_join(n, "|").alias(n) for n in names])


JOINED = lambda *names: ", ".join(f"array_to_string({n}, '|') AS {n}" for n in names)
query("cl_first_evidence", EVIDENCE + "SELECT id, tag, confidence, source, rule, evidence FROM a")(lambda q: X.assertions(spread(q.places)).select("id", F.inline("assertions")).select("id", "tag", "confidence", "source", "rule", "evidence"))
query("cl_rules", EVIDENCE + "SELECT tag, rule, source, count(*) AS n FROM a GROUP BY ALL")(lambda q: X.assertions(spread(q.places)).select(F.inline("assertions")).groupBy("tag", "rule", "source").agg(F.count("*").alias("n")))
query("cl_identity_split", ASSEMBLED + f"SELECT id, {JOINED('tags', 'attributes')} FROM z")(lambda q: _joined(q, "tags", "attributes"))
query("cl_group_expand", ASSEMBLED + f"SELECT id, {JOINED('groups')} FROM z")(lambda q: _joined(q, "groups"))
query("cl_conflicts", ASSEMBLED + f"SELECT id, {JOINED('conflicts')} FROM z")(lambda q: _joined(q, "conflicts"))
query("cl_record", ASSEMBLED + f"SELECT id, {JOINED('tags', 'attributes', 'groups', 'synonyms', 'conflicts')}, CASE WHEN len(conflicts) > 0 THEN 'review' ELSE 'accepted_deterministic' END AS review_state, coalesce(e, '') AS evidence FROM z LEFT JOIN (SELECT id, string_agg(tag || '=' || evidence, ';' ORDER BY tag) AS e FROM a GROUP BY id) USING (id)")(
    lambda q: _records(q).select("id", *[F.array_join(x, "|").alias(x) for x in ("tags", "attributes", "groups", "synonyms", "conflicts")], "review_state", F.array_join(F.transform(F.array_sort(F.transform("assertions", lambda a: F.struct(a["tag"].alias("t"), a["evidence"].alias("e")))), lambda a: F.concat(a["t"], F.lit("="), a["e"])), ";").alias("evidence"))
)


@query("cl_resolution", ASSEMBLED + "SELECT id, CASE WHEN area LIKE 'NATION_1%' THEN 'resolved' WHEN len(conflicts) > 0 THEN 'review' ELSE 'accepted_deterministic' END AS review_state FROM z JOIN (SELECT id, area FROM places ) USING (id)")
def _resolution(q: Data):
    done = q.places.where(c("area").startswith("NATION_1")).select("id", F.lit("resolved").alias("decision"))
    return _records(q).select("id", "review_state").join(done, "id", "left").select("id", F.coalesce("decision", "review_state").alias("review_state"))


query("cl_recommend", ASSEMBLED + "SELECT id, CASE WHEN p = 'restaurant' AND list_contains(groups, 'stay') THEN CASE WHEN list_contains(tags, 'hostel') THEN 'hostel' WHEN list_has_any(tags, ['bed-and-breakfast', 'hotel']) THEN 'hotel' ELSE 'vacation_rental' END WHEN p = 'restaurant' AND list_contains(groups, 'wellness') THEN 'wellness' WHEN p = 'tour_company' AND list_contains(groups, 'transport') THEN 'transport' WHEN p IN ('hotel', 'hostel', 'vacation_rental') AND list_contains(groups, 'eat') THEN 'retain_lodging' ELSE 'retain' END AS v FROM z")(
    lambda q: (r := _records(q)).select("id", X.recommendation(r).alias("v"))
)
_tagged = lambda column, could: F.transform(column, lambda t: F.struct(t.alias("tag"), F.lit(could).alias("could")))
query("cl_exposure", ASSEMBLED + "SELECT coalesce(a.tag, b.tag) AS tag, coalesce(a.n, 0) AS now, coalesce(b.n, 0) AS could, coalesce(b.n, 0) - coalesce(a.n, 0) AS delta FROM (SELECT tag, count(DISTINCT id) AS n FROM (SELECT id, unnest(tags) AS tag FROM z) GROUP BY tag) a FULL JOIN (SELECT tag, count(DISTINCT id) AS n FROM (SELECT id, unnest(list_concat(tags, attributes)) AS tag FROM z) GROUP BY tag) b ON a.tag = b.tag")(
    lambda q: C.exposed(_records(q).select("id", F.explode(F.concat(_tagged("tags", False), _tagged("tags", True), _tagged("attributes", True))).alias("x")).select("id", "x.tag", "x.could"))
)


def _best(text: str) -> str:
    """The category of most keywords in a text, earlier ones first; empty if there are none."""
    counts = ", ".join("{'n': " + " + ".join(f"CAST(contains({text}, {_q(w)}) AS INT)" for w in words) + f", 'k': {-i}, 'cat': '{k}'}}" for i, (k, words) in enumerate(U.KEYWORDS))
    return f"(list_sort([{counts}])[-1])"


LOW = "lower(trim(business_name)) || ' ' || lower(trim(subcategory))"
query("cl_keyword_cat", f"SELECT id, CASE WHEN b.n > 0 THEN b.cat ELSE 'unknown' END AS v FROM (SELECT id, {_best(LOW)} AS b FROM places )")(
    lambda q: q.places.select("id", C.keyword_argmax(F.concat_ws(" ", F.lower(F.trim("business_name")), F.lower(F.trim("subcategory"))), U.KEYWORDS).alias("v"))
)
query("cl_evidence_route", f"SELECT id, CASE WHEN {WA} <> '' AND contains(whatsapp, 'wa.me') THEN 'explicit_link' WHEN {WA} <> '' THEN 'explicit_number' WHEN whatsapp <> '' THEN 'invalid' WHEN phone <> '' THEN 'candidate' ELSE 'none' END AS v FROM master ")(
    lambda q: q.master.select("id", F.when((T.whatsapp(c("whatsapp")) != "") & F.contains("whatsapp", F.lit("wa.me")), "explicit_link").when(T.whatsapp(c("whatsapp")) != "", "explicit_number").when(T.present(c("whatsapp")), "invalid").when(T.present(c("phone")), "candidate").otherwise("none").alias("v"))
)
query("cl_queue_split", f"SELECT id, CASE WHEN {WA} <> '' THEN 'explicit' ELSE 'candidate' END AS queue FROM master WHERE {WA} <> '' OR {PHONE} <> ''")(
    lambda q: q.master.select("id", T.whatsapp(c("whatsapp")).alias("w"), T.phone_e164(c("phone")).alias("p")).where("w <> '' OR p <> ''").select("id", F.when(c("w") != "", "explicit").otherwise("candidate").alias("queue"))
)
SEEN = "CASE id % 5 WHEN 0 THEN ['Chat on WhatsApp with +506', business_name] WHEN 1 THEN ['Chat on WhatsApp with +506'] WHEN 2 THEN [' ', split_part(business_name, ' ', 1) || ' Luna extra'] WHEN 3 THEN ['Another place'] ELSE CAST([] AS VARCHAR[]) END"
VISUAL = f"""WITH n AS (SELECT id, {NORM.format(c=f"translate(business_name, '{T.ACCENTED}', '{T.PLAIN}')")} AS a, list_filter(list_transform({SEEN}, lambda x: trim(x)), lambda x: x <> '' AND NOT starts_with(x, 'Chat on')) AS named, len({SEEN}) AS seen FROM places ),
k AS (SELECT *, {NORM.format(c=f"translate(named[1], '{T.ACCENTED}', '{T.PLAIN}')")} AS b FROM n),
u AS (SELECT *, list_distinct(list_filter(string_split(a, ' '), lambda t: t <> '')) AS x, list_distinct(list_filter(string_split(b, ' '), lambda t: t <> '')) AS y FROM k)
SELECT id, CASE WHEN len(named) > 0 THEN 'business_target_visible' WHEN seen > 0 AND id % 5 < 2 THEN 'target_visible' ELSE 'unexpected_page' END AS state,
  CASE WHEN len(named) = 0 THEN 'unclear' WHEN a <> '' AND b <> '' AND (contains(a, b) OR contains(b, a)) THEN 'match' WHEN len(list_intersect(x, y)) * 1.0 / len(list_distinct(list_concat(x, y))) >= 0.5 THEN 'probable_match' ELSE 'mismatch' END AS result, coalesce(named[1], '') AS shown FROM u"""


@query("cl_visual", VISUAL)
def _visual(q: Data):
    k, name = c("id") % 5, c("business_name")
    number = F.lit("Chat on WhatsApp with +506")
    seen = F.when(k == 0, F.array(number, name)).when(k == 1, F.array(number)).when(k == 2, F.array(F.lit(" "), F.concat(F.substring_index(name, " ", 1), F.lit(" Luna extra")))).when(k == 3, F.array(F.lit("Another place"))).otherwise(F.array().cast("array<string>"))
    return q.places.select("id", U.headings(name, seen).alias("h")).select("id", "h.*")


P_PHONE, P_WA = PHONE, WA
SHOWN = f"WITH s AS (SELECT m.*, {P_PHONE} AS shown_phone, {P_WA} AS shown_whatsapp, {SLUG.format(n='m.business_name', a='m.area')} AS slug, replace({_norm('m.category')}, ' ', '_') AS p FROM places m)"
SHUT = "operating_status IN ('closed', 'permanently_closed')"
BROKEN = {
    "blank_name": "trim(business_name) = ''", "no_group": "len(groups) = 0", "lodging_without_stay": "s.p IN ('hotel', 'hostel', 'vacation_rental') AND NOT list_contains(groups, 'stay')", "category_rewritten": "s.p <> trim(category)",
    "inferred_whatsapp": "shown_whatsapp <> '' AND trim(whatsapp) = ''", "local_whatsapp": "shown_whatsapp <> '' AND NOT starts_with(shown_whatsapp, '+')", "local_phone": "shown_phone <> '' AND NOT starts_with(shown_phone, '+')",
    "closed_with_contact": f"{SHUT} AND (shown_phone <> '' OR shown_whatsapp <> '')", "unsafe_website": "website <> '' AND NOT starts_with(website, 'https://')",
    "bad_coordinates": "(latitude <> '' OR longitude <> '') AND NOT coalesce(TRY_CAST(latitude AS DOUBLE) BETWEEN -90 AND 90 AND TRY_CAST(longitude AS DOUBLE) BETWEEN -180 AND 180, false)",
}
LIST_BROKEN = "unnest(list_filter([" + ", ".join(f"CASE WHEN {x} THEN '{n}' END" for n, x in BROKEN.items()) + "], lambda x: x IS NOT NULL)) AS rule"
SOURCE_SQL = ASSEMBLED + f", {SHOWN[5:]}, w AS (SELECT s.*, z.groups FROM s JOIN z ON z.id = s.id) SELECT id, {LIST_BROKEN.replace('s.p', 'p')} FROM w UNION ALL SELECT id, 'repeated_slug' FROM w WHERE slug <> '' AND slug IN (SELECT slug FROM w GROUP BY slug HAVING count(*) > 1) UNION ALL SELECT id, 'repeated_map_id' FROM w WHERE google_maps_cid <> '' AND google_maps_cid IN (SELECT google_maps_cid FROM w GROUP BY 1 HAVING count(*) > 1)"


def _published(q: Data):
    r = _records(q)
    for k in U.LINKS:
        if k not in r.columns:
            r = r.withColumn(k, F.lit(""))
    r = pinned(r, shown_category=c("primary"), shown_phone=T.phone_e164(c("phone")), shown_whatsapp=T.whatsapp(c("whatsapp")))
    return U.published(r, q.places.select("id", T.slug(c("business_name"), c("area")).alias("slug"), "google_maps_cid"))


query("dq_source", SOURCE_SQL)(_published)

DEFECTS = {"bad_coordinates": ("latitude <> '' AND NOT coalesce(TRY_CAST(latitude AS DOUBLE) BETWEEN -90 AND 90, false)", lambda: (c("latitude") != "") & ~G.valid(c("latitude"), c("longitude")), "high"), "http_website": ("starts_with(website, 'http://')", lambda: F.startswith("website", F.lit("http://")), "medium"), "no_contact": ("phone = '' AND email = ''", lambda: (c("phone") == "") & (c("email") == ""), "high"), "bad_handle": ("contains(instagram_handle, ' ')", lambda: F.contains("instagram_handle", F.lit(" ")), "low"), "short_phone": (f"phone <> '' AND {PHONE} = ''", lambda: (c("phone") != "") & (T.phone_e164(c("phone")) == ""), "medium"),
           "hostless_website": ("regexp_matches(website, '^https?:///')", lambda: c("website").rlike("^https?:///"), "high"), "unlinked_handle": ("instagram_handle <> '' AND instagram_url = ''", lambda: (c("instagram_handle") != "") & (c("instagram_url") == ""), "low"), "closed_with_route": (f"{CLOSED} AND {WA} <> ''", lambda: F.lower("operating_status").isin("closed", "permanently_closed") & (T.whatsapp(c("whatsapp")) != ""), "medium"), "invalid_route": (f"whatsapp <> '' AND {WA} = ''", lambda: (c("whatsapp") != "") & (T.whatsapp(c("whatsapp")) == ""), "high"), "unverified": ("verified_date = '' AND google_maps_cid = ''", lambda: (c("verified_date") == "") & (c("google_maps_cid") == ""), "low")}
DEFECT_ROWS = "unnest(list_filter([" + ", ".join(f"CASE WHEN {s} THEN '{n}' END" for n, (s, _, _) in DEFECTS.items()) + "], lambda x: x IS NOT NULL)) AS rule"
query("dq_defects", "SELECT id, rule, CASE rule " + " ".join(f"WHEN '{n}' THEN '{v}'" for n, (_, _, v) in DEFECTS.items()) + f" END AS severity FROM (SELECT id, {DEFECT_ROWS} FROM master )")(lambda q: Q.graded(q.master, "id", {n: (f(), v) for n, (_, f, v) in DEFECTS.items()}))

ANY_OF = lambda text, words: "(" + " OR ".join(f"contains({text}, {_q(w)})" for w in words) + ")"
FAM = "CASE {x} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in U.FAMILY.items()) + " ELSE 'other' END"
MISMATCH = f"cat <> '' AND best <> '' AND {FAM.format(x='cat')} <> {FAM.format(x='best')}"
ISSUES = {
    "category_mismatch": MISMATCH, "no_category": "cat = ''", "unreachable": "phone = '' AND whatsapp = '' AND google_maps_cid = ''", "no_map_id": "google_maps_cid = ''", "no_website": "website = ''", "no_area": "area = ''",
    "place_in_name": ANY_OF("low", U.PLACES), "long_name": "length(trim(business_name)) > 60", "short_name": "length(trim(business_name)) BETWEEN 1 AND 4",
    "generic_name": "NOT regexp_matches(trim(business_name), '(?:^|\\s)\\p{Lu}') AND len(list_filter(string_split(low, ' '), lambda w: w <> '' AND NOT list_contains([" + ", ".join(map(_q, U.GENERIC)) + "], rtrim(w, 's')))) = 0",
    "no_description": "description_full = ''", "short_description": "length(description_full) BETWEEN 1 AND 24", "template_description": f"length(description_full) >= 25 AND {ANY_OF('lower(description_full)', U.TEMPLATES)}",
}
FIXES = {"set_category": f"({MISMATCH}) OR (cat = '' AND best <> '')", "strip_place": ANY_OF("low", U.PLACES)}
for _k, (_signs, _fine) in U.SUBJECTS.items():
    ISSUES[f"subcategory_{_k}"] = FIXES[f"change_to_{_k}"] = f"sub <> '' AND cat <> '' AND {ANY_OF('sub', _signs)} AND cat NOT IN ({', '.join(map(_q, _fine))})"
NAMED = lambda d: "list_filter([" + ", ".join(f"CASE WHEN {x} THEN '{n}' END" for n, x in d.items()) + "], lambda x: x IS NOT NULL)"
ENTRY = f"""WITH b AS (SELECT *, lower(trim(business_name)) AS low, lower(trim(category)) AS cat, lower(trim(subcategory)) AS sub, {_best(LOW)} AS bb FROM places ), e AS (SELECT *, CASE WHEN bb.n > 0 THEN bb.cat ELSE '' END AS best FROM b),
i AS (SELECT *, {NAMED(ISSUES)} AS issues, {NAMED(FIXES)} AS fixes FROM e)
SELECT id, array_to_string(issues, '|') AS issues, array_to_string(fixes, '|') AS fixes, greatest(0, least(100, greatest(0, 100 - len(issues) * 15 - CASE WHEN length(description_full) > 30 THEN 0 ELSE 10 END) - CASE WHEN google_maps_cid <> '' THEN 0 ELSE 10 END + CASE WHEN phone <> '' OR whatsapp <> '' THEN 5 ELSE 0 END + CASE WHEN website <> '' THEN 5 ELSE 0 END)) AS score FROM i"""
query("dq_entry", ENTRY)(lambda q: U.entry(q.places).select("id", F.array_join("issues", "|").alias("issues"), F.array_join("fixes", "|").alias("fixes"), c("score").cast("bigint").alias("score")))

WEEK = "SELECT p.id, description_full AS d, day, k, (p.id + k) % 5 = 0 AS closed, (p.id + k) % 5 = 1 AS open24 FROM places p CROSS JOIN (VALUES " + ", ".join(f"('{d}', {k})" for k, d in enumerate(U.DAYS)) + ") t(day, k)"
MENTION = "CASE day " + " ".join(f"WHEN '{d}' THEN regexp_matches(lower(d), '(?:^|[^\\pL\\pN_])(?:{w})')" for d, w in U.DAYS.items()) + " END"
SAYS = "CASE day " + " ".join(f"WHEN '{d}' THEN regexp_matches(lower(d), '{U.said_closed(d)}')" for d in U.DAYS) + " END"


@query("dq_desc_hours", f"WITH w AS ({WEEK}), m AS (SELECT * FROM w WHERE {MENTION}) SELECT id, day, 'said_closed_is_open' AS conflict FROM m WHERE {SAYS} AND NOT closed UNION ALL SELECT id, day, 'mentioned_is_closed' FROM m WHERE closed UNION ALL SELECT id, arg_min(day, k), 'always_open' FROM w WHERE {ANY_OF('lower(d)', U.ALWAYS)} AND (closed OR NOT open24) GROUP BY id")
def _desc(q: Data):
    days = F.posexplode(F.lit(list(U.DAYS))).alias("k", "day")
    w = q.places.select("id", c("description_full").alias("description"), days)
    return U.described_hours(w.withColumn("closed", (c("id") + c("k")) % 5 == 0).withColumn("open24", (c("id") + c("k")) % 5 == 1))


TOGETHER = "lower(business_name || ' ' || description_full)"
query("dq_taxonomy", ASSEMBLED + f"SELECT z.id FROM z JOIN places m ON m.id = z.id WHERE list_contains(list_concat(tags, attributes), 'medical') AND {ANY_OF(TOGETHER, X.AUTOMOTIVE)} AND NOT {ANY_OF(TOGETHER, X.ANIMALS)}")(
    lambda q: (r := _records(q)).where(X.suspicious(r)).select("id")
)


def _routes(q: Data):
    r = q.master.select("id", "whatsapp", T.whatsapp(c("whatsapp")).alias("route"))
    n = r.groupBy("route").agg(F.count("*").alias("n"))
    return r.where("whatsapp <> ''").join(n, "route").select("id", "route", F.when(c("route") == "", "invalid").when(c("n") > 1, "shared").otherwise("ok").alias("state"))


query("dq_routes", f"SELECT id, {WA} AS route, CASE WHEN {WA} = '' THEN 'invalid' WHEN n > 1 THEN 'shared' ELSE 'ok' END AS state FROM (SELECT *, count(*) OVER (PARTITION BY {WA}) AS n FROM master ) WHERE whatsapp <> ''")(_routes)
AMENITY, AMENITY_NOISE, AMENITY_PLACES = "wifi|pool|spa|gimnasio|view", r"\.(?:com|net|org)$", ["limón", "limon"]
KEPT = "regexp_matches(lower(x), '" + AMENITY + "') AND NOT regexp_matches(lower(x), '" + AMENITY_NOISE + "') AND lower(x) NOT IN ('limón', 'limon')"
query("dq_amenities", f"WITH l AS (SELECT id, list_filter(list_transform(regexp_split_to_array(amenities, '[,;\\n]'), lambda x: trim(x)), lambda x: x <> '') AS a FROM places ) SELECT id, array_to_string(list_filter(a, lambda x: {KEPT}), '|') AS kept, array_to_string(list_filter(a, lambda x: NOT ({KEPT})), '|') AS removed FROM l WHERE len(a) > 0")(
    lambda q: q.places.select("id", T.split_list(c("amenities")).alias("a")).where("size(a) > 0").select("id", U.kept(c("a"), AMENITY, AMENITY_NOISE, AMENITY_PLACES).alias("k")).select("id", F.array_join("k.kept", "|").alias("kept"), F.array_join("k.removed", "|").alias("removed"))
)

TRIED = """SELECT seq, rid, CASE WHEN seq % 11 = 0 THEN NULL ELSE rid END AS record, CASE WHEN seq % 7 = 0 THEN 'https://other.example.com/1' ELSE 'https://wa.me/' || CAST(rid AS STRING) END AS route, CASE WHEN seq % 13 = 0 THEN 'https://wa.me/0' ELSE 'https://wa.me/' || CAST(rid AS STRING) END AS sent,
  CASE WHEN seq % 5 = 0 THEN 'negative_control' ELSE 'explicit' END AS source, CASE state WHEN 'click' THEN 'match' WHEN 'view' THEN 'probable_match' WHEN 'purchase' THEN 'unclear' WHEN 'error' THEN 'unavailable' ELSE state END AS result,
  CASE seq % 6 WHEN 0 THEN 'generic_send_page' WHEN 1 THEN 'no such state' ELSE 'target_visible' END AS rendered, CASE WHEN seq % 4 = 0 THEN ' ' ELSE 'Casa' END AS shown, CASE WHEN value > 100 THEN '1.5' WHEN value < 5 THEN 'x' ELSE '0.5' END AS sure FROM """
MATCHED = "result IN ('match', 'probable_match')"


@query("dq_attempt", f"""WITH t AS ({TRIED} ledger ), e AS (SELECT *, CASE WHEN record IS NULL THEN 'not_queued' WHEN sent <> route OR NOT starts_with(route, 'https://wa.me/') THEN 'route' WHEN result NOT IN ({', '.join(map(_q, U.RESULTS))}) THEN 'result' WHEN rendered NOT IN ({', '.join(map(_q, U.STATES))}) THEN 'state'
  WHEN {MATCHED} AND trim(shown) = '' THEN 'match_without_name' WHEN {MATCHED} AND rendered = 'generic_send_page' THEN 'match_on_generic_page' WHEN NOT coalesce(TRY_CAST(sure AS DOUBLE) BETWEEN 0 AND 1, false) THEN 'confidence' WHEN {MATCHED} AND source = 'negative_control' THEN 'matched_control' END AS error FROM t)
SELECT seq, error, CASE WHEN error IS NULL THEN CASE WHEN result IN ('probable_match', 'mismatch', 'unclear') THEN 'human_required' ELSE 'auto_complete' END END AS review FROM e""")
def _attempt(q: Data):
    t = q.spark.sql(TRIED + "{ledger}", ledger=q.ledger)
    return t.select("seq", U.attempt(c("record"), c("route"), c("sent"), c("source"), c("result"), c("rendered"), c("shown"), c("sure")).alias("a")).select("seq", "a.error", "a.review")


query("dq_unique_keys", "SELECT count(phone) AS n_rows, count(DISTINCT phone) AS n_keys, count(phone) = count(DISTINCT phone) AS ok FROM master ")(lambda q: Q.unique_keys(q.master, "phone"))
@query("dq_release", "WITH f AS (SELECT n_name AS file, repeat(n_name, 40) AS body FROM nation), b AS (SELECT file, octet_length(encode(body)) AS size, substr(sha256(body), 1, 16) AS digest FROM f) SELECT file, size, CASE WHEN size > 380 THEN 'over_budget' WHEN file LIKE '%2' THEN 'changed' ELSE 'ok' END AS verdict FROM b UNION ALL SELECT 'absent', NULL, 'missing'")
def _release(q: Data):
    """Files against a manifest of digests and a budget of bytes: one file is missing, some are not what the manifest says."""
    from curio.sources import readers

    base = _folder(q, "release")
    body = F.repeat(c("n_name"), 40)
    q.nation.select(body.alias("value"), c("n_name").alias("file")).write.partitionBy("file").option("lineSep", "\x00").text(base)
    manifest = q.nation.select(c("n_name").alias("file"), F.sha2(F.when(c("n_name").endswith("2"), "other").otherwise(F.concat(body, F.lit("\x00"))), 256).alias("digest"))
    manifest = manifest.unionByName(q.spark.createDataFrame([("absent", "0")], "file string, digest string"))
    return Q.release(readers.binary_files(q.spark, base, r"file=([^/]+)/"), manifest, 381).select("file", (c("size") - 1).alias("size"), "verdict")


query("dq_ts_listing", "SELECT id, regexp_full_match(google_maps_cid, '[0-9]+') AND business_name <> '' AS ok FROM master ")(
    lambda q: (lambda good, bad: good.select("id", F.lit(True).alias("ok")).unionByName(bad.select("id", F.lit(False).alias("ok"))))(*Q.split_valid(q.master, c("google_maps_cid").rlike("^[0-9]+$") & T.present(c("business_name"))))
)
