"""Page, map text and snapshot extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from curio.operators import extract as E
from curio.operators.relations import pinned, spread
from curio.plans.registry import Data, query

c = F.col
SCOPE = r"regexp_replace(regexp_replace(regexp_replace(html, '(?is)<nav\b.*?</nav>', '', 'g'), '(?is)<script\b.*?</script>', '', 'g'), '(?is)<(?:footer|header|aside|style)\b.*?</(?:footer|header|aside|style)>', '', 'g')"
NOTE = "CASE id % 5 WHEN 0 THEN 'Call +506 2750 1234 or +506 2750 9999' WHEN 1 THEN 'Average rating: 4.5 of 5. previously called Old Inn.' WHEN 2 THEN 'Verified 2026-03-04' ELSE 'plain words' END"


def _note():
    k = c("id") % 5
    return F.when(k == 0, "Call +506 2750 1234 or +506 2750 9999").when(k == 1, "Average rating: 4.5 of 5. previously called Old Inn.").when(k == 2, "Verified 2026-03-04").otherwise("plain words")


TRAILS = [("Hotels", "/en/hotels/", "/en/cocles/hotels/"), ("Eat", "/en/restaurants/", "/en/hone-creek/"), ("Tours", "/en/tour/x", "en/punta-uva/"), ("Home", "/en/", "/en/nowhere/"), ("Accommodations", "/en/a/", "/fr/cahuita/"), ("none", "", "")]


def _page(q: Data):
    """Listing pages made from the master view."""
    k = c("id") % 5
    img = F.when(c("id") % 7 == 0, '<img src="/i/closed.png">').when(c("id") % 7 == 1, '<img src="/i/caution.gif" alt="Temporarily closed">').when(c("id") % 7 == 2, '<img src="warning.png">').otherwise("")
    link = F.when(k == 0, F.concat(F.lit('<a href="https://maps.google.com/?cid='), c("id").cast("string"), F.lit('">map</a><a href="https://www.facebook.com/sharer?u=1">s</a><a href="https://www.facebook.com/f'), c("id").cast("string"), F.lit('">f</a>'))).when(k == 1, '<a href="https://instagram.com/p/1">x</a><a href="https://instagram.com/Luna.Sol/">@luna</a>').otherwise('<a href="https://own.example.com/">own.example.com</a><a href="//www.tiktok.com/@t">t</a>')
    trail = F.lit("")
    for i, (word, one, two) in enumerate(TRAILS[:-1]):
        trail = F.when(c("id") % 6 == i, f'<p class="c"><a href="{one}">{word}</a> &gt; <a href="{two}">Two</a></p>').otherwise(trail)
    cost = F.when(c("id") % 4 == 1, '<div class="p">$$ <img src="/i/Green-Dollar.png"><img src="/i/green-dollar.png"> fair</div>').when(c("id") % 4 == 2, '<div><img src="green-dollar.png"></div>').otherwise("")
    body = F.concat(F.lit("<p>First words of it.</p><p>"), _note(), F.lit("</p>"), F.when(c("id") % 3 != 2, '<h2 class="x">The Listing Details</h2><p>behind it all</p>').otherwise(""))
    html = F.concat(F.lit("<html><head><title>T "), "area", F.lit('</title></head><nav><a href="https://nav.example.com">n</a></nav>'), trail, F.lit("<h1>"), "category", F.lit("</h1>"), body, cost, img, link, F.lit("<script>var aLats=[9.5, '9.75',x];</script><footer>+506 1111 2222</footer></html>"))
    path = F.when(c("id") % 2 == 0, "en/a-b/c").otherwise("es")
    return spread(q.master.select("id", "area", "category")).select("id", F.concat(F.lit("https://x.example.com/"), path).alias("url"), html.alias("html"), F.when(c("id") % 50 == 3, 404).otherwise(200).alias("code"))


CATEGORY = "CASE id % 6 WHEN 0 THEN 'hotel' WHEN 1 THEN 'restaurant' WHEN 2 THEN 'tour_company' WHEN 4 THEN 'hotel' END"
NAMED_AREA = "CASE id % 6 WHEN 0 THEN 'Cocles' WHEN 1 THEN 'Hone Creek' END"
AREA = f"coalesce({NAMED_AREA}, CASE WHEN id % 2 = 0 THEN 'A B' END)"
PRICE = "CASE WHEN id % 4 = 1 THEN '$$ fair' END"
DESC = f"CASE WHEN id % 3 <> 2 THEN {NOTE} END"
PHONE_SQL, ALT_SQL = "CASE WHEN id % 5 = 0 THEN '+506 2750 1234' END", "CASE WHEN id % 5 = 1 THEN 'Old Inn' END"
STATUS_SQL = "CASE id % 7 WHEN 0 THEN 'closed' WHEN 1 THEN 'temporarily_closed' WHEN 2 THEN 'needs_verification' ELSE 'active' END"


def _listed(q: Data):
    return E.listings(_page(q), http_status="code")


def _listing(name: str, field: str, sql: str) -> None:
    query(name, f"SELECT id, {sql} AS v FROM master ")(lambda q: _listed(q).select("id", c(field).alias("v")))


_listing("ex_phone", "phone", PHONE_SQL)
_listing("ex_rating", "rating", "CASE WHEN id % 5 = 1 THEN CAST(4.5 AS DOUBLE) END")
_listing("ex_date", "verified_date", "CASE WHEN id % 5 = 2 THEN '2026-03-04' END")
_listing("ex_alt", "alternate_names", ALT_SQL)
_listing("ex_status", "status", STATUS_SQL)
_listing("ex_cid", "cid", "CASE WHEN id % 5 = 0 THEN CAST(id AS STRING) END")
_listing("ex_ig", "instagram", "CASE WHEN id % 5 = 1 THEN 'https://instagram.com/p/1' END")
_listing("ex_fb", "facebook", "CASE WHEN id % 5 = 0 THEN 'https://www.facebook.com/f' || id END")
_listing("ex_website", "website", "CASE WHEN id % 5 > 1 THEN 'https://own.example.com/' END")
_listing("ex_desc", "description", DESC)
_listing("ex_area", "page_area", AREA)
_listing("ex_category", "page_category", CATEGORY)
_listing("ex_price", "price", PRICE)
query("cl_status_map", f"SELECT {STATUS_SQL} AS status, count(*) AS n FROM master GROUP BY 1")(lambda q: _page(q).groupBy(E.status(c("html")).alias("status")).agg(F.count("*").alias("n")))


@query("ex_listing", f"""SELECT id, 'https://x.example.com/' || CASE WHEN id % 2 = 0 THEN 'en/a-b/c' ELSE 'es' END AS url, category AS name, 'T ' || area AS title, {CATEGORY} AS page_category, {AREA} AS page_area, {ALT_SQL} AS alternate_names, {PHONE_SQL} AS phone,
  CASE WHEN id % 5 > 1 THEN 'https://own.example.com/' END AS website, CASE WHEN id % 5 = 0 THEN CAST(id AS STRING) END AS cid, CASE WHEN id % 5 = 1 THEN 'Luna.Sol' END AS instagram_handle, CASE WHEN id % 5 = 1 THEN 'https://instagram.com/p/1' END AS instagram,
  CASE WHEN id % 5 = 0 THEN 'https://www.facebook.com/f' || id END AS facebook, {DESC} AS description, CASE WHEN id % 5 = 1 THEN CAST(4.5 AS DOUBLE) END AS rating, {PRICE} AS price, CASE WHEN id % 5 = 2 THEN '2026-03-04' END AS verified_date, {STATUS_SQL} AS status,
  CASE WHEN id % 50 = 3 THEN 404 ELSE 200 END AS page_status, CASE WHEN id % 5 = 0 THEN '+50627501234' ELSE '' END AS normalized_phone, CASE WHEN id % 5 = 1 THEN 'luna.sol' END AS normalized_instagram,
  concat_ws(',', CASE WHEN {CATEGORY} IS NULL THEN 'no_category' END, CASE WHEN {AREA} IS NULL THEN 'no_area' END, CASE WHEN {NAMED_AREA} IS NULL AND {AREA} IS NOT NULL THEN 'area_from_url' END, CASE WHEN id % 5 <> 0 THEN 'no_phone,no_cid' END, CASE WHEN id % 5 < 2 THEN 'no_website' END, CASE WHEN id % 50 = 3 THEN 'bad_status' END) AS warnings FROM master """)
def _full(q: Data):
    return _listed(q).withColumn("warnings", F.array_join("warnings", ",")).drop("html", "code")


@query("ex_breadcrumb", "SELECT id, CASE id % 6 " + " ".join(f"WHEN {i} THEN '{a}={w}" + (f"|{b}=Two" if b.startswith(("/en/", "en/")) else "") + "'" for i, (w, a, b) in enumerate(TRAILS[:-1])) + " ELSE '' END AS v FROM master ")
def _crumb(q: Data):
    return _page(q).select("id", F.array_join(F.transform(E.crumbs(c("html")), lambda x: F.concat(x["href"], F.lit("="), x["shown"])), "|").alias("v"))


@query("ex_scope", f"SELECT page_id, length({SCOPE}) AS n FROM pages")
def _scope(q: Data):
    return q.pages.select("page_id", F.length(E.scope(c("html"))).cast("bigint").alias("n"))


@query("ex_js_arrays", "SELECT id, '9.5|9.75|?' AS v FROM master ")
def _js(q: Data):
    return _page(q).select("id", F.array_join(F.transform(E.js_array(c("html"), "aLats"), lambda x: x.cast("string")), "|", "?").alias("v"))


@query("ex_urls", "SELECT page_id, CAST(len(list_distinct(list_filter(regexp_extract_all(html, '(?i)<a\\b[^>]*?href=\"([^\"]*)\"', 1), lambda u: starts_with(u, '/t')))) AS BIGINT) AS n FROM pages")
def _urls(q: Data):
    return q.pages.select("page_id", F.size(E.page_urls(c("html"), "^/t")).cast("bigint").alias("n"))


@query("ex_social", "SELECT id, CASE WHEN id % 5 = 0 THEN 'https://www.facebook.com/f' || id || '|https://www.facebook.com/sharer' WHEN id % 5 = 1 THEN 'https://instagram.com/Luna.Sol/|https://instagram.com/p/1' ELSE 'https://www.tiktok.com/@t' END AS v FROM master ")
def _social(q: Data):
    return _page(q).select("id", F.array_join(E.social(c("html")), "|").alias("v"))


query("ex_ig_handle", "SELECT id, CASE WHEN id % 5 = 1 THEN 'Luna.Sol' END AS v FROM master ")(lambda q: _page(q).select("id", E.handle(c("html")).alias("v")))


@query("ex_profile", "SELECT id, CASE id % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'not_found' WHEN 2 THEN 'login' ELSE 'challenged' END AS state, CASE WHEN id % 4 = 0 THEN CAST(id AS INT) END AS posts, CASE WHEN id % 4 = 0 THEN category END AS bio FROM master ")
def _profile(q: Data):
    k = c("id") % 4
    html = F.when(k == 0, F.concat(F.lit('<script type="application/json">{"posts": '), c("id").cast("string"), F.lit(', "bio": "'), "category", F.lit('"}</script>'))).when(k == 1, "Sorry, this page isn't available").when(k == 2, "Log in to continue").otherwise("Solve the challenge")
    return q.master.select("id", E.profile(html).alias("p")).select("id", "p.*")


query("ex_account_state", "SELECT id, CASE id % 3 WHEN 0 THEN 'broken' WHEN 1 THEN 'not_found' ELSE 'ok' END AS v FROM master ")(
    lambda q: q.master.select("id", E.account_state(F.when(c("id") % 3 == 0, " ").when(c("id") % 3 == 1, "Not found").otherwise("hello")).alias("v"))
)
query("ex_blocked", "SELECT doc_id, regexp_matches(text, '(?i)unusual traffic|captcha') AS v FROM documents")(lambda q: q.documents.select("doc_id", E.blocked(c("text")).alias("v")))


@query("ex_page_meta", "SELECT id, id % 2 = 0 AS limited_view, id % 3 = 0 AS booking, id % 5 = 0 AS overview, id % 7 = 0 AS information FROM master ")
def _meta(q: Data):
    t = F.concat_ws("\n", F.when(c("id") % 2 == 0, "Limited view of Google Maps"), F.when(c("id") % 3 == 0, "Compare prices"), F.when(c("id") % 5 == 0, 'tab "Overview of Casa"'), F.when(c("id") % 7 == 0, 'region "Information for Casa"'))
    return q.master.select("id", E.page_meta(t).alias("m")).select("id", "m.limited_view", "m.booking", "m.overview", "m.information")


def _snapshot(q: Data):
    k = c("id") % 3
    t = F.when(k == 0, '- img "Free Wi-Fi available"\n- img "Pool unavailable"\n- img "Pool available"').when(k == 1, '- img "Air & heat available"\n- img "Air & heat available"').otherwise("- text: none")
    return q.master.select("id", t.alias("t"))


@query("ex_aria_amen", "SELECT id, 'free_wifi' AS amenity, true AS available, 1 AS n FROM master WHERE id % 3 = 0 UNION ALL SELECT id, 'pool', NULL, 2 FROM master WHERE id % 3 = 0 UNION ALL SELECT id, 'air_and_heat', true, 2 FROM master WHERE id % 3 = 1")
def _amen(q: Data):
    return E.aria_amenities(_snapshot(q), "id", "t")


@query("ex_rebuild", "SELECT id, CASE WHEN id % 3 = 0 THEN 2 WHEN id % 3 = 1 THEN 1 ELSE 0 END AS n FROM master ")
def _rebuild(q: Data):
    found = E.aria_amenities(_snapshot(q), "id", "t").groupBy("id").agg(F.count("*").alias("n"))
    return q.master.select("id").join(found, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("n"))


@query("ex_aria_about", "SELECT id, 'Service' AS \"group\", 'Delivery|Takeout' AS attributes FROM master WHERE id % 2 = 0 UNION ALL SELECT id, 'Crowd', 'Quiet' FROM master ")
def _about(q: Data):
    service = F.when(c("id") % 2 == 0, '- heading "Service" [level=2]\n- list:\n  - listitem: Delivery\n  - listitem: Takeout\n- button "More"\n- listitem: Lost\n').otherwise('- heading "About this data" [level=2]\n- list:\n  - listitem: Hidden\n')
    t = F.concat(service, F.lit('- heading "Crowd" [level=2]\n- list:\n  - listitem: Quiet'))
    return E.aria_groups(q.master.select("id", t.alias("t")), "id", "t", ["About this data", "Pricing and availability"]).select("id", "group", F.array_join("attributes", "|").alias("attributes"))


# Lines of a map capture beside those about contacts: ten kinds by id.
SAID = [
    ["Free Wifi", "free wifi", "2 bedroom pool"], ["Swimming pool", "Blue Lagoon Garden"], ["Piscina Grande Azul", "Hot water"], ["Ocean view bar", "Reviews", "bares"], ["Beach hotel", "Hotel"],
    ["Cafe y pizza", "Heladeria"], ["seafood", "Sushi bar and more of it"], ["mariscos de la casa y del mar", "Grill"], ["Backpackers hostel", "surf shop"], ["Pizza Roma", "taco", "soda tica"],
]
KIND = ["hotel", "restaurant", "shopping", "tour_company", "services", "hostel", "other"]
KNOWN_NAMES = ["Grill", "Casa Azul"]
LINES = "CASE id % 10 " + " ".join(f"WHEN {i} THEN [{', '.join(repr(x) for x in v)}]" for i, v in enumerate(SAID)) + " END"
KIND_SQL = "CASE id % 7 " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(KIND)) + " END"


def _said(q: Data):
    lines, kind = F.lit(None).cast("array<string>"), F.lit("other")
    for i, v in enumerate(SAID):
        lines = F.when(c("id") % 10 == i, F.lit(v)).otherwise(lines)
    for i, k in enumerate(KIND):
        kind = F.when(c("id") % 7 == i, k).otherwise(kind)
    return q.master.select("id", c("business_name").alias("name"), kind.alias("kind"), F.array_join(lines, "\n").alias("t"))


def _capture(q: Data):
    k = c("id") % 4
    t = F.concat_ws("\n", "name", F.when(k != 3, F.concat(F.lit("4."), (c("id") % 10).cast("string"))), F.when(k == 0, "+506 2750 1234").when(k == 1, "27501234"), F.when(k == 1, "casa.example.com"), F.when(k == 2, "M742+8M Town").otherwise("12 calle Uno"), F.when(k == 0, "Abierto ahora"), F.when(k == 1, "lunes 9:00 a.m. - 5:00 p.m."), F.when(k == 2, "Hora de entrada: 3:00 p.m."), F.lit("Free Wifi"), F.lit("Reviews"), F.lit("Swimming pool"), F.lit("Beach hotel"))
    return spread(q.master.select("id", c("business_name").alias("name"))).select("id", "name", t.alias("t"))


MAP = {
    "rating": ("ex_m_rating", "CASE WHEN id % 4 <> 3 THEN CAST('4.' || id % 10 AS DOUBLE) END"), "phone": ("ex_m_phone", "CASE id % 4 WHEN 0 THEN '+506 2750 1234' WHEN 1 THEN '27501234' END"),
    "website": ("ex_m_website", "CASE WHEN id % 4 = 1 THEN 'casa.example.com' END"), "address": ("ex_m_address", "CASE WHEN id % 4 = 2 THEN 'M742+8M Town' ELSE '12 calle Uno' END"),
    "open_state": ("ex_m_open", "CASE WHEN id % 4 = 0 THEN 'abierto ahora' END"), "hours": ("ex_m_hours", "CASE WHEN id % 4 = 1 THEN 'lunes 9:00 a.m. - 5:00 p.m.' END"),
    "check_in": ("ex_m_checkin", "CASE WHEN id % 4 = 2 THEN '3:00 p.m.' ELSE '' END"),
}
for _field, (_name, _sql) in MAP.items():
    query(_name, f"SELECT id, {_sql} AS v FROM master ")(lambda q, f=_field: _capture(q).withColumn("m", E.map_fields(c("t"))).select("id", c(f"m.{f}").alias("v")))

def _list(words: list[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


UNNAMED = "regexp_matches(x, '^\\p{Lu}\\p{Ll}+(?: \\p{Lu}\\p{Ll}+)"
AMEN_OK = f"length(x) <= 45 AND NOT list_contains({_list(E.PAGE_WORDS + E.NEARBY)}, lower(x)) AND NOT regexp_matches(lower(x), '{E.ROOMS}') AND NOT ({UNNAMED}{{2,5}}$') AND len(list_filter({_list(E.LEADS)}, lambda w: starts_with(lower(x), w))) = 0) AND len(list_filter({_list(E.AMENITIES)}, lambda w: contains(lower(x), w))) > 0"
query("ex_m_amenities", f"WITH l AS (SELECT id, unnest({LINES}) AS x, generate_subscripts({LINES}, 1) AS i FROM master ), o AS (SELECT id, lower(x) AS low, min(i) AS i, arg_min(x, i) AS x FROM l WHERE {AMEN_OK} GROUP BY id, lower(x)) SELECT m.id, coalesce(string_agg(x, '|' ORDER BY i), '') AS v FROM master m LEFT JOIN o ON o.id = m.id GROUP BY m.id")(
    lambda q: _said(q).select("id", F.array_join(E.amenity_lines(c("t")), "|").alias("v"))
)
WORDS = "CASE k " + " ".join(f"WHEN '{k}' THEN {_list(w)}" for k, w in E.SUBCATEGORIES.items()) + " ELSE CAST([] AS VARCHAR[]) END"
FITS = "list_filter(w, lambda y: contains(lower(x), y))"
query("ex_m_subcat", f"""WITH l AS (SELECT id, {KIND_SQL} AS k, unnest({LINES}) AS x, generate_subscripts({LINES}, 1) AS i FROM master ), w AS (SELECT *, {WORDS} AS w FROM l WHERE length(x) <= 35 AND NOT list_contains({_list(E.PAGE_WORDS)}, lower(x)) AND NOT regexp_matches(x, '{E.NAMED_KIND}')),
d AS (SELECT id, x, i, {FITS}[-1] AS y FROM w WHERE len({FITS}) > 0), s AS (SELECT id, x, i, CASE WHEN lower(x) = y THEN 10 WHEN starts_with(lower(x), y) OR ends_with(lower(x), y) THEN 8 ELSE 5 END AS s FROM d),
z AS (SELECT id, x, row_number() OVER (PARTITION BY id ORDER BY s DESC, length(x), i) AS n FROM s) SELECT m.id, z.x AS v FROM master m LEFT JOIN z ON z.id = m.id AND n = 1""")(lambda q: _said(q).select("id", E.subcategory(c("t"), c("kind")).alias("v")))
KITCHEN = f"list_filter({_list(E.KITCHENS)}, lambda y: contains(lower(x), y))"
query("ex_m_cuisine", f"""WITH l AS (SELECT id, unnest({LINES}) AS x, generate_subscripts({LINES}, 1) AS i FROM master ), k AS (SELECT id, x, i, length({KITCHEN}[1]) * 1.0 / length(x) AS r FROM l WHERE length(x) <= 35 AND NOT regexp_matches(lower(x), '{E.NO_KITCHEN}') AND NOT {UNNAMED}{{1,5}}$') AND lower(x) NOT IN ({', '.join(repr(n.lower()) for n in KNOWN_NAMES)}) AND NOT ({' OR '.join(f"contains(lower(x), {n.lower()!r})" for n in KNOWN_NAMES if len(n) > 15) or 'false'}) AND len({KITCHEN}) > 0),
z AS (SELECT id, x, r, row_number() OVER (PARTITION BY id ORDER BY r DESC, i) AS n FROM k WHERE r > 0.3) SELECT id, x AS value, CAST(CASE WHEN r > 0.4 THEN 0.6 ELSE 0.5 END AS DOUBLE) AS confidence FROM z WHERE n = 1""")(
    lambda q: E.cuisine_lines(_said(q), "id", "t", q.spark.createDataFrame([(n,) for n in KNOWN_NAMES], "name string"))
)
POINTS = ", ".join(f"{{'n': len(list_filter({_list(w)}, lambda y: contains(low, y))) + CASE WHEN list_contains({_list(E.SUBCATEGORIES[k])}, sub) THEN 5 ELSE 0 END, 'k': {-i}, 'name': '{k}'}}" for i, (k, w) in enumerate(E.CATEGORY_WORDS))
SUB = "CASE id % 4 WHEN 0 THEN 'Cabin' WHEN 1 THEN 'pharmacy' ELSE '' END"
query("ex_m_infer_cat", f"WITH x AS (SELECT id, lower({SUB}) AS sub, lower(business_name || ' ' || {SUB} || ' ' || array_to_string({LINES}, chr(10))) AS low FROM master ), p AS (SELECT id, list_sort([{POINTS}])[-1] AS b FROM x) SELECT id, CASE WHEN b.n > 0 THEN b.name ELSE 'unknown' END AS v FROM p")(
    lambda q: _said(q).select("id", E.infer_category(c("name"), F.when(c("id") % 4 == 0, "Cabin").when(c("id") % 4 == 1, "pharmacy").otherwise(""), c("t")).alias("v"))
)


# Lines of a fuller map page, added to a capture by id: more amenities than a summary takes, one of them twice, and prices.
OFFER = ["Wi-Fi gratis", "Estacionamiento privado", "Piscina", "Aire acondicionado", "Restaurante", "Gimnasio", "Desayuno incluido", "Transporte desde/hacia el aeropuerto", "Admite perros", "Mascotas", "Acceso a la playa por un sendero entre las palmeras", "Room service", "Ocean view", "Laundry", "Piscina"]
OFFER_SQL = "CASE WHEN id % 3 = 0 THEN '|" + "|".join(x for x in OFFER if x != "Ocean view") + "' ELSE '' END"


def _fuller(q: Data):
    prices = F.concat(F.lit("CRC "), (c("id") % 90 + 10).cast("string"), F.lit(",422\nBooking.com\ndesde CRC 9,900 por noche"))
    more = F.concat_ws("\n", F.when(c("id") % 4 == 2, "Hora de salida: 11:00 a.m."), F.when(c("id") % 3 == 0, "\n".join(OFFER)), F.when(c("id") % 3 == 1, prices))
    return _capture(q).withColumn("t", F.concat_ws("\n", "t", more))


@query("ex_maps_v1", f"""SELECT id, CASE WHEN id % 4 <> 3 THEN CAST('4.' || id % 10 AS DOUBLE) END AS rating, CASE id % 4 WHEN 0 THEN '+506 2750 1234' WHEN 1 THEN '27501234' END AS phone, CASE WHEN id % 4 = 1 THEN 'casa.example.com' WHEN id % 3 = 1 THEN 'Booking.com' END AS website,
  CASE WHEN id % 4 = 2 THEN 'M742+8M Town' END AS address, CASE WHEN id % 4 = 2 THEN '3:00 p.m.' END AS check_in, CASE WHEN id % 4 = 2 THEN '11:00 a.m.' END AS check_out,
  CASE WHEN {AMEN_OK} THEN x || '|' ELSE '' END || 'Free Wifi|Swimming pool' || {OFFER_SQL} AS amenities, CASE WHEN id % 3 = 1 THEN 'CRC ' || (id % 90 + 10) || ',422|desde CRC 9,900 por noche' ELSE '' END AS prices FROM (SELECT id, trim(business_name) AS x FROM master )""")
def _v1(q: Data):
    """Every field that the plain scan of a capture gives, all its amenities and all its prices."""
    return pinned(_fuller(q), m=E.map_scan(c("t"))).select("id", *[f"m.{k}" for k in ("rating", "phone", "website", "address", "check_in", "check_out")], *[F.array_join(f"m.{k}", "|").alias(k) for k in ("amenities", "prices")])


query("ex_maps_v2", "SELECT id, CASE id % 4 WHEN 0 THEN '+506 2750 1234' WHEN 1 THEN '27501234' END AS phone, CASE WHEN id % 4 = 2 THEN 'M742+8M Town' ELSE '12 calle Uno' END AS address FROM master ")(
    lambda q: pinned(_capture(q), m=E.map_fields(c("t"))).select("id", "m.phone", "m.address")
)


V3 = {
    "rating": ("CASE WHEN id % 4 <> 3 THEN '4.' || id % 10 END", "0.9", None), "phone": ("CASE id % 4 WHEN 0 THEN '+506 2750 1234' WHEN 1 THEN '27501234' END", "0.85", None), "website": ("CASE WHEN id % 4 = 1 THEN 'casa.example.com' END", "0.7", None),
    "address": ("CASE WHEN id % 4 = 2 THEN 'M742+8M Town' ELSE '12 calle Uno' END", "CASE WHEN id % 4 = 2 THEN 0.5 ELSE 0.8 END", None), "open_status": ("CASE WHEN id % 4 = 0 THEN 'Abierto ahora' END", "0.9", None),
    "hours": ("CASE WHEN id % 4 = 1 THEN 'lunes 9:00 a.m. - 5:00 p.m.' END", "0.8", None), "amenities": (f"CASE WHEN {AMEN_OK} THEN x || '|' ELSE '' END || 'Free Wifi|Swimming pool'", "0.7", f"CASE WHEN {AMEN_OK} THEN x ELSE 'Free Wifi' END"),
}
V3_ROWS = " UNION ALL ".join(f"SELECT id, '{k}' AS field, {v} AS value, CAST({n} AS DOUBLE) AS confidence, {e or v} AS evidence FROM n" for k, (v, n, e) in V3.items())
V3_TEXT = "business_name || chr(10) || CASE WHEN id % 4 <> 3 THEN '4.' || id % 10 || chr(10) ELSE '' END || CASE id % 4 WHEN 0 THEN '+506 2750 1234' || chr(10) || '12 calle Uno' || chr(10) || 'Abierto ahora' WHEN 1 THEN '27501234' || chr(10) || 'casa.example.com' || chr(10) || '12 calle Uno' || chr(10) || 'lunes 9:00 a.m. - 5:00 p.m.' WHEN 2 THEN 'M742+8M Town' || chr(10) || 'Hora de entrada: 3:00 p.m.' ELSE '12 calle Uno' END || chr(10) || 'Free Wifi' || chr(10) || 'Reviews' || chr(10) || 'Swimming pool' || chr(10) || 'Beach hotel'"
V3_POINTS = ", ".join(f"{{'n': len(list_filter({_list(w)}, lambda y: contains(low, y))), 'k': {-i}, 'name': '{k}'}}" for i, (k, w) in enumerate(E.CATEGORY_WORDS))


@query("ex_maps_v3", f"WITH n AS (SELECT id, business_name, trim(business_name) AS x FROM master ), f AS ({V3_ROWS}), p AS (SELECT id, list_sort([{V3_POINTS}])[-1] AS b FROM (SELECT id, lower(business_name || '  ' || {V3_TEXT}) AS low FROM n)) SELECT f.*, CASE WHEN b.n > 0 THEN b.name ELSE 'unknown' END AS inferred_category FROM f JOIN p USING (id) WHERE value IS NOT NULL")
def _v3(q: Data):
    """Every field of every capture, with its confidence and the line it is from; no category is given, so it is inferred."""
    r = pinned(_capture(q), r=E.scored_record(c("name"), F.lit(""), c("t")))
    return r.select("id", c("r.inferred_category").alias("inferred_category"), F.explode("r.fields").alias("field", "x")).select("id", "field", "x.value", "x.confidence", "x.evidence", "inferred_category")
