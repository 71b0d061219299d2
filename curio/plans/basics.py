"""Scalar functions, scores, projections, filters and predicates over the master view."""

from __future__ import annotations

from pyspark.sql import functions as F

from curio.functions import scores as S
from curio.functions import text as T
from curio.plans.registry import Data, query

M = "business_name"
# Pieces of SQL used more than once.
E164 = "(CASE WHEN length(CASE WHEN length({d}) = 8 THEN '506' || {d} ELSE {d} END) BETWEEN 10 AND 15 THEN '+' || (CASE WHEN length({d}) = 8 THEN '506' || {d} ELSE {d} END) ELSE '' END)"
DIG = "regexp_replace({c}, '[^0-9]', '', 'g')"
PHONE = E164.format(d=DIG.format(c="phone"))
WA_DIGITS = "(CASE WHEN regexp_extract(whatsapp, '(?:phone=|wa\\.me/)([0-9]{8,15})', 1) <> '' THEN regexp_extract(whatsapp, '(?:phone=|wa\\.me/)([0-9]{8,15})', 1) ELSE " + DIG.format(c="whatsapp") + " END)"
WA = E164.format(d=WA_DIGITS)
HANDLE = "(CASE WHEN regexp_full_match(ltrim(trim(instagram_handle), '@'), '[A-Za-z0-9._]{1,30}') THEN ltrim(trim(instagram_handle), '@') ELSE '' END)"
HTTPS = "(CASE WHEN regexp_matches({c}, '^https://[^/?#]+') THEN {c} ELSE '' END)"
FOLD = "trim(regexp_replace(lower(translate(regexp_replace({c}, '\\s+-\\s+.*$', ''), '" + T.ACCENTED + "', '" + T.PLAIN + "')), '[^a-z0-9]+', ' ', 'g'))"
NORM = "trim(regexp_replace(regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g'), '\\s+', ' ', 'g'))"
SLUG = "substr(trim(regexp_replace(lower({n} || '-' || {a}), '[^a-z0-9]+', '-', 'g'), '-'), 1, 80)"
CLOSED = "lower(operating_status) IN ('closed', 'permanently_closed')"
CONTACT = f"(CASE WHEN {WA} <> '' THEN 40 ELSE 0 END + CASE WHEN phone <> '' THEN 30 ELSE 0 END + CASE WHEN {HANDLE} <> '' THEN 15 ELSE 0 END + CASE WHEN website <> '' THEN 10 ELSE 0 END + CASE WHEN facebook_url <> '' THEN 5 ELSE 0 END)"


def _one(name: str, column, sql: str) -> None:
    """Registers a scalar function: id and v."""
    query(name, f"SELECT id, {sql} AS v FROM master ")(lambda q: q.master.select("id", column().alias("v")))


c = F.col
_one("fn_norm_text", lambda: T.norm_text(c(M)), r"trim(regexp_replace(lower(business_name), '\s+', ' ', 'g'))")
_one("er_norm_name", lambda: T.norm_name(c(M)), NORM.format(c=M))
_one("er_fold", lambda: T.fold(c(M)), FOLD.format(c=M))
_one("er_dedup_norm", lambda: T.norm_name(T.strip_accents(c(M))), NORM.format(c=f"translate({M}, '{T.ACCENTED}', '{T.PLAIN}')"))
_one("fn_amenity_key", lambda: T.amenity_key(c(M)), r"trim(regexp_replace(replace(regexp_replace(lower(business_name), 'wi[ -]?fi', 'wifi', 'g'), '&', ' and '), '[^\p{L}\p{N}]+', '_', 'g'), '_')")
_one("fn_slug", lambda: T.slug(c(M), c("area")), SLUG.format(n=M, a="area"))
_one("fn_id_md5", lambda: T.id_md5(c(M), c("google_maps_cid"), c("phone")), "substr(md5(business_name || '|' || google_maps_cid || '|' || phone), 1, 12)")
_one("fn_id_sha", lambda: T.id_sha(c(M), c("area")), "substr(sha256(business_name || '|' || area), 1, 16)")
_one("fn_semantic_key", lambda: T.semantic_key(c("google_maps_cid"), c(M), c("area")), "CASE WHEN google_maps_cid <> '' THEN 'cid:' || google_maps_cid ELSE 'record:' || substr(sha256(business_name || '|' || area), 1, 16) END")
_one("fn_display_name", lambda: T.display_name(c(M), c("area"), "limón|limon|costa rica"), r"CASE WHEN id % 5 = 1 THEN regexp_extract(business_name, '^(.*?) - ', 1) WHEN id % 5 = 2 THEN regexp_extract(business_name, '^(.*?),', 1) ELSE business_name END")
_one("fn_clean_name", lambda: F.trim(F.regexp_replace(T.repair_mojibake(F.when(c("id") % 2 == 0, F.decode(F.encode(c(M), "UTF-8"), "ISO-8859-1")).otherwise(c(M))), r"\s+-\s+.*$", "")), r"trim(regexp_replace(business_name, '\s+-\s+.*$', ''))")
_one("fn_title_clean", lambda: T.strip_suffix(c(M), [", Costa Rica", " Azul", " Luna"]), "trim(regexp_replace(business_name, '(?:, Costa Rica| Azul| Luna)$', ''))")
_one("fn_phone_e164", lambda: T.phone_e164(c("phone")), PHONE)
_one("fn_phone_cr", lambda: T.phone_local(c("phone")), "CASE id % 8 WHEN 0 THEN '' WHEN 1 THEN '+506' || phone WHEN 2 THEN '+506' || substr(replace(replace(phone, ' ', ''), '-', ''), 5) WHEN 3 THEN '+' || substr(phone, 8) WHEN 4 THEN '123' WHEN 5 THEN '+506' || regexp_replace(phone, '[^0-9]', '', 'g') WHEN 6 THEN '+506' || phone ELSE '+' || phone END")
_one("er_phone8", lambda: T.phone_tail(c("phone")), "CASE WHEN length(" + DIG.format(c="phone") + ") >= 8 THEN right(" + DIG.format(c="phone") + ", 8) ELSE '' END")
_one("fn_whatsapp", lambda: T.whatsapp(c("whatsapp")), WA)
_one("fn_route", lambda: T.route(T.whatsapp(c("whatsapp"))), f"CASE WHEN {WA} <> '' THEN 'https://wa.me/' || substr({WA}, 2) ELSE '' END")
_one("prd_handle", lambda: T.handle(c("instagram_handle")), HANDLE)
_one("fn_handle_norm", lambda: T.handle_norm(c("instagram_handle")), "regexp_replace(trim(instagram_handle, '@'), '[^a-zA-Z0-9_.]', '', 'g')")
_one("er_ig_key", lambda: T.handle_key(c("instagram_url")), r"lower(regexp_extract(instagram_url, '(?i)instagram\.com/([A-Za-z0-9._]+)', 1))")
_one("prd_publishable_url", lambda: T.https_url(c("website")), HTTPS.format(c="website"))
_one("fn_url_scheme", lambda: T.url_scheme(c("website")), "CASE WHEN website <> '' AND NOT regexp_matches(website, '^https?://') THEN 'https://' || website ELSE website END")
_one("fn_url_norm", lambda: T.url_norm(c("website")), "lower(rtrim(website, '/'))")
HOST = r"regexp_replace(lower(regexp_extract(website, '^[A-Za-z]+://([^/?#:]+)', 1)), '^www\.', '')"
_one("er_host_key", lambda: T.host_key(c("website")), f"CASE WHEN {HOST} IN ('facebook.com','instagram.com','wa.me','booking.com','tripadvisor.com','google.com','linktr.ee') THEN '' ELSE {HOST} END")
_one("fn_label", lambda: T.label(c("category"), {"building": "Buildings", "machinery": "Machines & tools"}), "CASE category WHEN 'building' THEN 'Buildings' WHEN 'machinery' THEN 'Machines & tools' ELSE upper(category[1]) || substr(category, 2) END")
_one("fn_snippet", lambda: T.snippet(c("description_full"), F.lit("the beach"), 10), "CASE WHEN instr(description_full, 'the beach') > 0 THEN '…' || substr(description_full, instr(description_full, 'the beach') - 10, 10) || '«the beach»' || substr(description_full, instr(description_full, 'the beach') + 9, 10) || '…' ELSE '' END")
_one("fn_template", lambda: T.message_link(T.whatsapp(c("whatsapp")), T.strip_accents(c(M)), "Hello {name}"), f"CASE WHEN {WA} <> '' THEN 'https://wa.me/' || substr({WA}, 2) || '?text=' || url_encode('Hello ' || translate(business_name, '{T.ACCENTED}', '{T.PLAIN}')) ELSE '' END")
_one("fn_join_items", lambda: T.join_items(T.tokens(T.norm_name(c("category")))), "category")
_one("fn_is_auto_desc", lambda: T.is_auto_description(c("description_full"), "long story"), "description_full <> '' AND (length(description_full) < 100 OR contains(lower(description_full), 'long story'))")
_one("fn_describe", lambda: F.concat_ws(" ", F.concat(c(M), F.lit(" is "), T.article(c("category")), F.lit(" "), c("category"), F.lit(" in "), c("area"), F.lit(".")), F.when(T.present(c("email")), F.lit("It can be reached by e-mail."))),
     "business_name || ' is ' || CASE WHEN regexp_matches(category, '^[aeiou]') THEN 'an' ELSE 'a' END || ' ' || category || ' in ' || area || '.' || CASE WHEN email <> '' THEN ' It can be reached by e-mail.' ELSE '' END")
_one("er_mojibake", lambda: T.repair_mojibake(F.when(c("id") % 2 == 0, F.decode(F.encode(c(M), "UTF-8"), "ISO-8859-1")).otherwise(c(M))), "business_name")

f = F.col
_one("sc_contact", lambda: S.contact(f), CONTACT)
_one("sc_visibility", lambda: S.visibility(f), "CASE WHEN google_maps_cid <> '' THEN 35 ELSE 0 END + CASE WHEN latitude <> '' THEN 25 ELSE 0 END + CASE WHEN booking_url <> '' THEN 15 ELSE 0 END + CASE WHEN tripadvisor_url <> '' THEN 10 ELSE 0 END + CASE WHEN email <> '' THEN 5 ELSE 0 END + CASE WHEN instagram_confidence = 'verified' THEN 10 ELSE 0 END")
COMPLETE = "30 + CASE WHEN latitude <> '' THEN 15 ELSE 0 END + CASE WHEN phone <> '' THEN 10 ELSE 0 END + CASE WHEN website <> '' THEN 10 ELSE 0 END + CASE WHEN instagram_handle <> '' OR facebook_url <> '' THEN 10 ELSE 0 END + CASE WHEN description_full <> '' THEN 10 ELSE 0 END + CASE WHEN operating_status <> '' THEN 5 ELSE 0 END + CASE WHEN verified_date <> '' THEN 10 ELSE 0 END"
_one("sc_complete", lambda: S.completeness(f), COMPLETE)
_one("sc_entry", lambda: S.entry_score((c("id") % 8).cast("int"), T.present(c("phone"))), "greatest(0, least(100, 100 - (id % 8) * 15 - CASE WHEN phone <> '' THEN 0 ELSE 10 END))")
_one("sc_resolve_conf", lambda: S.confidence(T.present(c("google_maps_cid")), T.present(c("latitude")), c("id") % 2 == 0), "CASE WHEN google_maps_cid <> '' AND latitude <> '' AND id % 2 = 0 THEN 'high' WHEN google_maps_cid <> '' OR (latitude <> '' AND id % 2 = 0) THEN 'medium' ELSE 'low' END")
_one("sc_tier", lambda: F.when(c("category").isin("building", "furniture"), 1).when(c("category").isin("machinery"), 2).otherwise(3), "CASE WHEN category IN ('building', 'furniture') THEN 1 WHEN category = 'machinery' THEN 2 ELSE 3 END")


@query("sc_stars", "SELECT p_partkey AS id, CAST(floor(CAST(p_size AS DOUBLE) / 10) AS INT) AS full_stars, CAST(p_size AS DOUBLE) / 10 - floor(CAST(p_size AS DOUBLE) / 10) >= 0.3 AS half FROM part")
def _stars(q: Data):
    s = S.stars(F.col("p_size").cast("double") / 10)
    return q.part.select(F.col("p_partkey").alias("id"), s["full"].alias("full_stars"), s["half"].alias("half"))


_one("ar_badges", lambda: F.array_join(S.badges(f), "|"), f"CASE WHEN {CLOSED} THEN '' ELSE concat_ws('|', CASE WHEN {WA} <> '' THEN 'WhatsApp' END, CASE WHEN {HANDLE} <> '' AND instagram_confidence = 'verified' THEN 'Instagram' END, CASE WHEN booking_url <> '' THEN 'Booking' END, CASE WHEN {HTTPS.format(c='website')} <> '' THEN 'Website' END) END")
_one("ar_links", lambda: F.array_join(S.secondary(f), "|"), f"CASE WHEN {CLOSED} THEN '' ELSE concat_ws('|', CASE WHEN {PHONE} <> '' THEN 'Call' END, CASE WHEN {HANDLE} <> '' THEN 'Instagram' END, CASE WHEN facebook_url <> '' THEN 'Facebook' END, CASE WHEN {HTTPS.format(c='website')} <> '' THEN 'Website' END, CASE WHEN booking_url <> '' THEN 'Booking.com' END, CASE WHEN tripadvisor_url <> '' THEN 'TripAdvisor' END, CASE WHEN google_maps_cid <> '' OR latitude <> '' THEN 'Google Maps' END) END")
_one("ar_primary", lambda: F.concat_ws(" ", S.primary(f)["type"], S.primary(f)["url"]), f"CASE WHEN {CLOSED} THEN 'None ' WHEN {WA} <> '' THEN 'WhatsApp https://wa.me/' || substr({WA}, 2) WHEN {PHONE} <> '' THEN 'Call tel:' || {PHONE} WHEN {HANDLE} <> '' THEN 'Instagram https://instagram.com/' || {HANDLE} WHEN {HTTPS.format(c='website')} <> '' THEN 'Website ' || website WHEN google_maps_cid <> '' THEN 'Map https://www.google.com/maps?cid=' || google_maps_cid WHEN latitude <> '' THEN 'Map https://www.google.com/maps/search/' || latitude || ',' || longitude ELSE 'None #' END")
_one("ar_intents", lambda: F.array_join(S.intents(F.when(c("id") % 3 == 0, F.lit("hotel")).when(c("id") % 3 == 1, F.lit("Restaurant ")).otherwise(c("category"))), ","), "CASE id % 3 WHEN 0 THEN 'stay' WHEN 1 THEN 'eat' ELSE 'other' END")


@query("flt_nonempty", "SELECT id FROM master WHERE business_name <> '' AND latitude <> '' AND longitude <> ''")
def _nonempty(q: Data):
    return q.master.where(T.present(c(M)) & T.present(c("latitude")) & T.present(c("longitude"))).select("id")


@query("flt_set", "SELECT id, category IN ('building', 'furniture') AS lodging FROM master WHERE category NOT IN ('automobile')")
def _set(q: Data):
    return q.master.where(~c("category").isin("automobile")).select("id", c("category").isin("building", "furniture").alias("lodging"))


@query("flt_numeric_id", "SELECT id, google_maps_cid FROM master WHERE regexp_full_match(google_maps_cid, '[0-9]+')")
def _numeric(q: Data):
    return q.master.where(c("google_maps_cid").rlike("^[0-9]+$")).select("id", "google_maps_cid")


SEARCHED = (M, "area", "category", "description_full", "email", "website")


SEARCH = "SELECT id FROM master WHERE " + " OR ".join(f"contains(lower({x}), 'luna')" for x in SEARCHED)


@query("flt_search", SEARCH)
def _search(q: Data):
    from curio.operators.search import matches_text

    return q.master.where(matches_text("LUNA", [c(x) for x in SEARCHED])).select("id")


@query("flt_search_index", SEARCH)
def _search_index(q: Data):
    """The same search by a written index of runs of letters."""
    from curio.operators.search import search_index, write_index
    from curio.sources.shared import folder

    path = folder(q.spark, "search")
    write_index(q.master.select("id", *SEARCHED), list(SEARCHED), path)
    return search_index(q.spark, path, "LUNA", list(SEARCHED)).select("id")


@query("flt_facets", "SELECT id FROM master WHERE category = 'building' AND area = 'NATION_3' AND whatsapp <> ''")
def _facets(q: Data):
    from curio.operators.search import facets

    return facets(q.master, {"category": "building", "area": "NATION_3"}, has=["whatsapp"]).select("id")


@query("flt_classified", "SELECT p_partkey AS id FROM part WHERE contains(lower(p_name), 'blue') OR contains(lower(p_brand), 'blue') OR contains(lower(p_type), 'blue')")
def _classified(q: Data):
    from curio.operators.search import matches_text

    return q.part.where(matches_text("blue", [c("p_name"), c("p_brand"), c("p_type")])).select(c("p_partkey").alias("id"))


@query("flt_affiliate", r"SELECT id FROM master WHERE regexp_matches(booking_url || ' ' || tripadvisor_url, '(?i)booking\.com|tripadvisor\.')")
def _affiliate(q: Data):
    return q.master.where(F.concat_ws(" ", "booking_url", "tripadvisor_url").rlike(r"(?i)booking\.com|tripadvisor\.")).select("id")


@query("flt_listing_url", r"SELECT page_id, CASE WHEN regexp_matches(url, '^https?://[^/]+/(en|fr)/[0-9]+') THEN regexp_extract(url, '^(https?://[^/]+/(?:en|fr)/[0-9]+)', 1) END AS listing FROM pages")
def _listing_url(q: Data):
    u = F.regexp_extract("url", r"^(https?://[^/]+/(?:en|fr)/[0-9]+)", 1)
    return q.pages.select("page_id", F.when(u != "", u).alias("listing"))


@query("flt_ui_noise", "SELECT p_partkey AS id FROM part WHERE length(p_name) BETWEEN 3 AND 80 AND NOT regexp_full_match(p_name, '[0-9]+') AND NOT regexp_matches(lower(p_name), 'map|nut|photos|reviews')")
def _noise(q: Data):
    from curio.operators.search import is_name

    return q.part.where(is_name(c("p_name"), "map|nut|photos|reviews")).select(c("p_partkey").alias("id"))


@query("flt_missing", "SELECT o_orderkey AS id FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 25)")
def _missing(q: Data):
    done = q.lineitem.where("l_quantity > 25").select(c("l_orderkey").alias("o_orderkey"))
    return q.orders.join(done, "o_orderkey", "left_anti").select(c("o_orderkey").alias("id"))


@query("prd_evidence", "SELECT id, google_maps_cid <> '' AND length(description_full) > 20 AND sha256(description_full) = sha256(trim(description_full)) AS ok FROM master")
def _evidence(q: Data):
    from curio.operators.quality import evidence_ok

    return q.master.select("id", evidence_ok(c("google_maps_cid"), c("description_full"), F.sha2(F.trim(c("description_full")), 256), 20).alias("ok"))


@query("prd_affiliate_strip", "SELECT id, CASE WHEN id % 4 = 0 THEN 'https://plain.example.com/' || id ELSE 'https://www.example.com/h' || id END AS v FROM master ")
def _strip(q: Data):
    from curio.operators.search import unwrap_url

    wrapped = F.concat(F.lit("https://go.example.net/r?id=7&url=https%3A%2F%2Fwww.example.com%2Fh"), c("id"), F.lit("&z=1"))
    links = F.when(c("id") % 4 == 0, F.concat(F.lit("https://plain.example.com/"), c("id"))).otherwise(wrapped)
    return q.master.select("id", unwrap_url(links).alias("v"))


@query("prj_public", f"SELECT id, business_name, area, category, {WA} <> '' AS has_whatsapp, phone <> '' AS has_phone, {HANDLE} <> '' AS has_instagram, website <> '' AS has_website FROM master")
def _public(q: Data):
    from curio.operators.search import public_projection

    return public_projection(q.master)


@query("prj_business", f"SELECT id, {SLUG.format(n=M, a='area')} AS slug, {PHONE} AS phone, {WA} AS whatsapp, {CONTACT} AS contact, {COMPLETE} AS completeness, {CLOSED} AS closed FROM master")
def _business(q: Data):
    return q.master.select("id", T.slug(c(M), c("area")).alias("slug"), T.phone_e164(c("phone")).alias("phone"), T.whatsapp(c("whatsapp")).alias("whatsapp"), S.contact(f).alias("contact"), S.completeness(f).alias("completeness"), S.closed(f).alias("closed"))


@query("prj_rename_out", "SELECT s_suppkey AS osm_id, s_name AS osm_name, s_acctbal AS score FROM supplier")
def _rename(q: Data):
    return q.supplier.select(c("s_suppkey").alias("osm_id"), c("s_name").alias("osm_name"), c("s_acctbal").alias("score"))
