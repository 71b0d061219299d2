"""Joins, blocking, matching and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from curio.functions import text as T
from curio.operators import matching as X
from curio.operators import ratio as R
from curio.operators.extract import SHOWN, SHOWN_PHONE, SHOWN_RATING, visible_signals
from curio.operators.summaries import placed
from curio.plans.basics import DIG, FOLD, HOST, M, NORM, WA
from curio.plans.places import km_sql
from curio.plans.registry import Data, query

c = F.col
S_NAME = NORM.format(c="name")
M_NAME = NORM.format(c=M)


@query("jn_lookup_left", "SELECT o_orderkey AS id, c_name, coalesce(c_mktsegment, '') AS segment FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0")
def _left(q: Data):
    d = q.customer.where("c_acctbal > 0")
    return q.orders.join(d, c("o_custkey") == c("c_custkey"), "left").select(c("o_orderkey").alias("id"), "c_name", F.coalesce("c_mktsegment", F.lit("")).alias("segment"))


@query("jn_lookup_compute", "SELECT m.id, coalesce(s.ref, CAST(length(m.area) AS STRING)) AS v FROM master m LEFT JOIN second s ON m.id = s.id")
def _compute(q: Data):
    return q.master.join(q.second.select("id", "ref"), "id", "left").select("id", F.coalesce("ref", F.length("area").cast("string")).alias("v"))


@query("jn_composite", "SELECT l_orderkey AS a, l_linenumber AS b, s_name FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey AND l_linenumber = s_suppkey % 7")
def _composite(q: Data):
    s = q.supplier.withColumn("l_linenumber", (c("s_suppkey") % 7).cast("int")).withColumnRenamed("s_suppkey", "l_suppkey")
    return q.lineitem.join(s, ["l_suppkey", "l_linenumber"], "left").select(c("l_orderkey").alias("a"), c("l_linenumber").alias("b"), "s_name")


@query("jn_normkey", f"WITH b AS (SELECT k, max(id) AS other FROM (SELECT {S_NAME} AS k, id FROM second ) GROUP BY k) SELECT m.id, b.other FROM (SELECT id, {M_NAME} AS k FROM master ) m JOIN b ON m.k = b.k")
def _normkey(q: Data):
    b = q.second.select(T.norm_name(c("name")).alias("k"), c("id").alias("other")).groupBy("k").agg(F.max("other").alias("other"))
    return q.master.select("id", T.norm_name(c(M)).alias("k")).join(b, "k").select("id", "other")


@query("jn_hash_id", "SELECT a.id, b.id AS other FROM (SELECT id, substr(sha256(area || '|' || CAST(id % 97 AS STRING)), 1, 16) AS h FROM master ) a JOIN (SELECT id, substr(sha256(area || '|' || ref), 1, 16) AS h FROM second ) b ON a.h = b.h")
def _hash(q: Data):
    a = q.master.select("id", T.id_sha(c("area"), (c("id") % 97).cast("string")).alias("h"))
    return a.join(q.second.select(c("id").alias("other"), T.id_sha(c("area"), c("ref")).alias("h")), "h").select("id", "other")


@query("jn_inner_pair", "SELECT a.c_custkey AS id, a.c_acctbal AS before, b.total AS after FROM customer a JOIN (SELECT o_custkey, sum(CAST(floor(o_totalprice) AS BIGINT)) AS total FROM orders GROUP BY o_custkey) b ON a.c_custkey = b.o_custkey")
def _inner(q: Data):
    b = q.orders.groupBy(c("o_custkey").alias("c_custkey")).agg(F.sum(c("o_totalprice").cast("bigint")).alias("after"))
    return q.customer.join(b, "c_custkey").select(c("c_custkey").alias("id"), c("c_acctbal").alias("before"), "after")


@query("jn_semi", "SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def _semi(q: Data):
    return q.documents.select("doc_id").join(q.labels.where("quality = 1"), "doc_id", "left_semi")


@query("jn_anti_left", "SELECT id, 'left' AS side FROM master WHERE id NOT IN (SELECT id FROM second ) UNION ALL SELECT id, 'both' FROM master WHERE id IN (SELECT id FROM second )")
def _anti_left(q: Data):
    from curio.operators.relations import three_way

    return three_way(q.master.select("id"), q.second.select("id"), "id").where("side <> 'right'")


@query("jn_anti_right", "SELECT page_id AS id, CASE WHEN doc_id IS NULL THEN 'left' WHEN page_id IS NULL THEN 'right' ELSE 'both' END AS side FROM (SELECT page_id FROM pages WHERE length(html) > 2000) FULL JOIN (SELECT doc_id FROM labels) ON page_id = doc_id WHERE page_id IS NOT NULL UNION ALL SELECT doc_id, 'right' FROM labels WHERE doc_id NOT IN (SELECT page_id FROM pages WHERE length(html) > 2000)")
def _anti_right(q: Data):
    from curio.operators.relations import three_way

    return three_way(q.pages.where("length(html) > 2000").select(c("page_id").alias("id")), q.labels.select(c("doc_id").alias("id")), "id")


@query("jn_anti_sql", "SELECT c_custkey AS id FROM customer LEFT JOIN orders ON c_custkey = o_custkey WHERE o_custkey IS NULL")
def _anti_sql(q: Data):
    return q.customer.join(q.orders, c("c_custkey") == c("o_custkey"), "left_anti").select(c("c_custkey").alias("id"))


@query("jn_anti_null_aware", "SELECT c_custkey AS id FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def _anti_null(q: Data):
    from curio.operators.relations import not_recovered

    done = q.orders.select(c("o_custkey").alias("id"), F.when(c("o_orderstatus") == "F", 1).otherwise(0).alias("n"))
    return not_recovered(q.customer.select(c("c_custkey").alias("id")), done, "id", "n")


TOK = "list_filter(list_distinct(string_split({n}, ' ')), lambda t: length(t) > 2)"
BEST = f"""
WITH a AS (SELECT id AS l, {M_NAME} AS ln FROM master ), b AS (SELECT id AS r, {S_NAME} AS rn FROM second ),
ta AS (SELECT l, ln, unnest({TOK.format(n='ln')}) AS t FROM a), hb AS (SELECT r, rn, unnest(list_filter(string_split(rn, ' '), lambda t: length(t) > 2)[1:2]) AS t FROM b),
p AS (SELECT DISTINCT l, ln, r, rn FROM ta JOIN hb USING (t)),
s AS (SELECT *, list_distinct(string_split(ln, ' ')) AS x, list_distinct(string_split(rn, ' ')) AS y FROM p),
u AS (SELECT *, len(list_intersect(x, y)) AS i, len(list_distinct(list_concat(x, y))) AS n, least(len(x), len(y)) AS m FROM s),
v AS (SELECT *, greatest(i * 1.0 / n, CASE WHEN contains(ln, rn) OR contains(rn, ln) OR (CASE WHEN m <= 2 THEN i >= m ELSE i >= m - 1 END) THEN 0.7 ELSE 0.0 END) AS score FROM u)
"""
RANKED = BEST + ", z AS (SELECT l, r, CAST(round(score * 1000) AS BIGINT) AS score, row_number() OVER (PARTITION BY l ORDER BY score DESC, r) AS k FROM v WHERE score >= 0.5) SELECT l, r, score FROM z WHERE k = 1"


def _sides(q: Data):
    return q.master.select("id", T.norm_name(c(M)).alias("name")), q.second.select("id", T.norm_name(c("name")).alias("name"))


def _best(q: Data):
    return X.best_match(*_sides(q)).select("l", "r", F.round(c("score") * 1000).cast("bigint").alias("score"))


query("jn_blocked_fuzzy", RANKED)(_best)


NAMES = BEST.replace(f"SELECT id AS l, {M_NAME} AS ln FROM master ", f"SELECT DISTINCT {M_NAME} AS ln FROM master ").replace(f"SELECT id AS r, {S_NAME} AS rn FROM second ", f"SELECT min(id) AS r, {S_NAME} AS rn FROM second GROUP BY 2").replace("SELECT l, ln, unnest", "SELECT ln, unnest").replace("SELECT DISTINCT l, ln, r, rn", "SELECT DISTINCT ln, r, rn")
KNOWN = "ln = rn OR (length(ln) > 4 AND length(rn) > 4 AND (contains(ln, rn) OR contains(rn, ln))) OR i >= m * 0.6"


def _name_pairs(q: Data):
    """Distinct names that share a token with the first two of the other side, with the least id of the right one."""
    a, b = _sides(q)
    long = lambda n: F.filter(T.tokens(c(n)), lambda t: F.length(t) > 2)
    a, b = a.select(c("name").alias("ln")).distinct(), b.groupBy(c("name").alias("rn")).agg(F.min("id").alias("r"))
    return a.withColumn("t", F.explode(long("ln"))).join(b.withColumn("t", F.explode(F.slice(long("rn"), 1, 2))), "t").drop("t").distinct()


@query("er_jaccard", NAMES + "SELECT ln, rn, CAST(floor(1000.0 * i / n + 0.0001) AS BIGINT) AS v FROM v")
def _jaccard(q: Data):
    return _name_pairs(q).select("ln", "rn", F.floor(X.jaccard(T.tokens(c("ln")), T.tokens(c("rn"))) * 1000 + 0.0001).alias("v"))


@query("er_contains", NAMES + "SELECT ln, rn, contains(ln, rn) OR contains(rn, ln) OR (CASE WHEN m <= 2 THEN i >= m ELSE i >= m - 1 END) AS v FROM v")
def _contains(q: Data):
    return _name_pairs(q).select("ln", "rn", X.contains(c("ln"), c("rn")).alias("v"))


@query("er_boost", NAMES + "SELECT ln, rn, CAST(floor(1000 * score + 0.0001) AS BIGINT) AS v FROM v")
def _boost(q: Data):
    return _name_pairs(q).select("ln", "rn", F.floor(X.boosted(c("ln"), c("rn")) * 1000 + 0.0001).alias("v"))


PLAINED = "translate({c}, '" + T.ACCENTED + "', '" + T.PLAIN + "')"
PLAIN_NAME = "trim(regexp_replace(lower(" + PLAINED + "), '[^a-z0-9]+', ' ', 'g'))"
TELLING = "list_filter(list_distinct(string_split({n}, ' ')), lambda w: length(w) > 2 AND w NOT IN ('" + "','".join(R.COMMON) + "'))"


def _captures(q: Data):
    """Names as they are expected and as they were seen, by record."""
    return q.master.select("id", M).join(q.second.select("id", "name"), "id")


EXPECTED_PAIRS = NAMES + f", c AS (SELECT ln, rn FROM v UNION SELECT {M_NAME} AS ln, {S_NAME} AS rn FROM (SELECT m.id, {M}, name FROM master m JOIN second s ON m.id = s.id)), e AS (SELECT ln, rn, {PLAIN_NAME.format(c='ln')} AS a, {PLAIN_NAME.format(c='rn')} AS b FROM c), "


@query(
    "er_compare_names",
    EXPECTED_PAIRS + f"t AS (SELECT ln, rn, length(b) >= 4 AND (contains(a, b) OR contains(b, a)) AS inside, {TELLING.format(n='a')} AS x, {TELLING.format(n='b')} AS y FROM e), "
    "g AS (SELECT *, len(list_intersect(x, y)) AS i, len(list_distinct(list_concat(x, y))) AS n FROM t) SELECT ln, rn, CASE WHEN inside THEN 'match' WHEN n > 0 AND 2 * i >= n THEN 'probable_match' ELSE 'mismatch' END AS label, CAST(CASE WHEN inside THEN 0.95 WHEN n > 0 AND 2 * i >= n THEN 0.75 ELSE 0.8 END AS DOUBLE) AS confidence FROM g",
)
def _compare(q: Data):
    """All pairs of names that share a token, and those of records that were seen under both, whether they share one or not."""
    seen = _captures(q).select(T.norm_name(c(M)).alias("ln"), T.norm_name(c("name")).alias("rn"))
    pairs = _name_pairs(q).select("ln", "rn").unionByName(seen).distinct()
    told = R.compared(R.plain(c("ln")), R.plain(c("rn")))
    return pairs.select("ln", "rn", told["label"].alias("label"), told["confidence"].alias("confidence"))


@query("er_known", NAMES + f"SELECT ln, rn, {KNOWN} AS v FROM v")
def _known(q: Data):
    return _name_pairs(q).select("ln", "rn", X.known(c("ln"), c("rn")).alias("v"))


@query("er_best_match", NAMES + ", z AS (SELECT ln, rn, r, CAST(round(score * 1000) AS BIGINT) AS score, row_number() OVER (PARTITION BY ln ORDER BY score DESC, r) AS k FROM v WHERE i * 1.0 / n >= 0.5) SELECT ln, rn, r, score FROM z WHERE k = 1")
def _best_names(q: Data):
    """The best match of each name by token overlap alone, containment left out."""
    a, b = _sides(q)
    names = a.select("name").distinct().withColumn("id", c("name"))
    by = X.best_match(names, b, score=lambda x, y: X.jaccard(T.tokens(x), T.tokens(y)))
    scored = by.select(c("l").alias("ln"), c("r_name").alias("rn"), "r")
    return scored.select("ln", "rn", "r", F.round(X.boosted(c("ln"), c("rn")) * 1000).cast("bigint").alias("score"))


@query("jn_nested_loop", BEST + f"SELECT l, min(r) AS first FROM v WHERE {KNOWN} GROUP BY l")
def _nested(q: Data):
    """The first known name (by id) of each new one: names are compared once, whatever the number of rows that share them."""
    a, b = _sides(q)
    pairs = X.sharing(a, b).where(X.known(c("l_name"), c("r_name"))).join(b.groupBy(c("name").alias("r_name")).agg(F.min("id").alias("r")), "r_name")
    first = pairs.groupBy(c("l_name").alias("ln")).agg(F.min("r").alias("first"))
    return _sides(q)[0].select(c("id").alias("l"), c("name").alias("ln")).join(first, "ln").select("l", "first")


TOLD = "lower(CASE WHEN regexp_matches(" + PLAINED + r", '(?i)[-–—].*,\s*costa rica\s*$') THEN regexp_extract(" + PLAINED + r", '^(.*?)\s*[-–—]', 1) ELSE regexp_replace(" + PLAINED + r", '\s*[-–—]\s*', ' ') END)"
RUNS = "regexp_extract_all(replace(replace(" + TOLD + ", chr(39), ''), '’', ''), '[a-z0-9]+')"
INN = "regexp_matches(" + TOLD + r", '\bb(?:\s|&|\band\b)+b\b')"
SIG = "list_filter(list_transform(CASE WHEN " + INN + " THEN list_concat(list_filter(" + RUNS + ", lambda w: w <> 'b'), ['bed', 'breakfast']) ELSE " + RUNS + " END, lambda w: CASE WHEN regexp_matches(w, '..[^suio]s$') THEN w[:-2] ELSE w END), lambda w: w NOT IN ('" + "','".join(X.STOP) + "'))"
LEFT_SIG = SIG.format(c=M)


@query("er_names_match", f"WITH a AS (SELECT DISTINCT area, {M} AS ln, {LEFT_SIG} AS x FROM master ), b AS (SELECT DISTINCT area, name AS rn, {SIG.format(c='name')} AS y FROM second ), p AS (SELECT * FROM a JOIN b USING (area)), u AS (SELECT area, ln, rn, len(list_distinct(list_intersect(x, y))) AS i, len(list_distinct(list_concat(x, y))) AS n, least(len(x), len(y)) AS m FROM p) SELECT area, ln, rn, m <= 1 OR (i >= 1 AND i * 1.0 / greatest(n, 1) >= 0.4) OR i * 1.0 / greatest(m, 1) >= 0.66 AS v FROM u")
def _names_match(q: Data):
    """Whether each two names of an area mean one place: distinct names, whose words are taken once."""
    a = q.master.select("area", c(M).alias("ln")).distinct().withColumn("x", X.significant(c("ln")))
    b = q.second.select("area", c("name").alias("rn")).distinct().withColumn("y", X.significant(c("rn")))
    return a.join(b, "area").select("area", "ln", "rn", X.words_match(c("x"), c("y")).alias("v"))


PAIR_SQL = f"""
WITH f AS (SELECT id, {FOLD.format(c=M)} AS name, CASE WHEN length({DIG.format(c='phone')}) >= 8 THEN right({DIG.format(c='phone')}, 8) ELSE '' END AS phone8,
  CASE WHEN {WA} <> '' THEN right({WA}, 8) ELSE '' END AS wa8, lower(regexp_extract(instagram_url, 'instagram\\.com/([A-Za-z0-9._]+)', 1)) AS ig,
  CASE WHEN {HOST} IN ('facebook.com','instagram.com','wa.me','booking.com','tripadvisor.com','google.com','linktr.ee') THEN '' ELSE {HOST} END AS host, google_maps_cid AS cid, TRY_CAST(latitude AS DOUBLE) AS lat, TRY_CAST(longitude AS DOUBLE) AS lon FROM master ),
k AS (SELECT DISTINCT id, unnest(list_concat(list_filter([CASE WHEN phone8 <> '' THEN 'phone8:' || phone8 END, CASE WHEN wa8 <> '' THEN 'wa8:' || wa8 END, CASE WHEN ig <> '' THEN 'ig:' || ig END, CASE WHEN host <> '' THEN 'host:' || host END, CASE WHEN cid <> '' THEN 'cid:' || cid END], lambda x: x IS NOT NULL),
  list_transform(list_filter(string_split(name, ' '), lambda t: length(t) >= 5), lambda t: 'name:' || t))) AS key FROM f),
z AS (SELECT key FROM k GROUP BY key HAVING count(*) BETWEEN 2 AND 25), s AS (SELECT k.* FROM k JOIN z USING (key)),
p AS (SELECT DISTINCT a.id AS l, b.id AS r FROM s a JOIN s b ON a.key = b.key AND a.id < b.id),
j AS (SELECT l, r, x.name AS ln, y.name AS rn, x.cid AS lc, y.cid AS rc, 1.0 - levenshtein(x.name, y.name) * 1.0 / greatest(length(x.name), length(y.name), 1) AS sim,
  x.phone8 <> '' AND x.phone8 = y.phone8 AS sp, x.wa8 <> '' AND x.wa8 = y.wa8 AS sw, x.ig <> '' AND x.ig = y.ig AS si, x.host <> '' AND x.host = y.host AS sh,
  coalesce(6371000.0 * 2 * atan2(sqrt(pow(sin(radians(y.lat - x.lat) / 2), 2) + cos(radians(x.lat)) * cos(radians(y.lat)) * pow(sin(radians(y.lon - x.lon) / 2), 2)), sqrt(1 - (pow(sin(radians(y.lat - x.lat) / 2), 2) + cos(radians(x.lat)) * cos(radians(y.lat)) * pow(sin(radians(y.lon - x.lon) / 2), 2)))) <= 30, false) AS sd
  FROM p JOIN f x ON x.id = l JOIN f y ON y.id = r),
w AS (SELECT *, CASE WHEN ln = rn THEN 5 WHEN sim >= 0.92 THEN 3 WHEN sim >= 0.82 THEN 2 ELSE 0 END AS np FROM j),
t AS (SELECT *, np + CASE WHEN sp THEN 2 ELSE 0 END + CASE WHEN sw THEN 2 ELSE 0 END + CASE WHEN si THEN 4 ELSE 0 END + CASE WHEN sh THEN 3 ELSE 0 END + CASE WHEN sd THEN 2 ELSE 0 END AS score,
  CASE WHEN np > 0 THEN 1 ELSE 0 END + CASE WHEN sp THEN 1 ELSE 0 END + CASE WHEN sw THEN 1 ELSE 0 END + CASE WHEN si THEN 1 ELSE 0 END + CASE WHEN sh THEN 1 ELSE 0 END + CASE WHEN sd THEN 1 ELSE 0 END AS families FROM w),
q AS (SELECT *, CASE WHEN score >= 7 AND families >= 2 THEN 'strong' WHEN score >= 4 THEN 'review' ELSE 'shared_signal' END AS class FROM t)
"""


@query("er_block_tokens", PAIR_SQL + "SELECT id, key FROM s")
def _blocks(q: Data):
    f = X.features(q.master)
    keys = X.block_keys(f, {k: c(k) for k in ("phone8", "wa8", "ig", "host", "cid")}, c("name"))
    return keys.join(keys.groupBy("key").count().where("count BETWEEN 2 AND 25").select("key"), "key").select("id", "key")


query("jn_self_blocked", PAIR_SQL + "SELECT l, r FROM p")(lambda q: X.resolve(q.master).select("l", "r"))
query("er_pair_score", PAIR_SQL + "SELECT l, r, score, families FROM q")(lambda q: X.resolve(q.master).select("l", "r", "score", "families"))
query("er_pair_class", PAIR_SQL + "SELECT l, r, score, class FROM q")(lambda q: X.resolve(q.master).select("l", "r", "score", "class"))
query("geo_near_pair", PAIR_SQL + "SELECT l, r, sd AS near FROM q")(lambda q: X.resolve(q.master).select("l", "r", F.contains("signals", F.lit("distance")).alias("near")))
query("er_pair_rank", PAIR_SQL + "SELECT l, r, score, row_number() OVER (ORDER BY score DESC, l, r) AS place FROM q")(
    lambda q: placed(X.resolve(q.master).select("l", "r", "score"), [(c("score"), True), (c("l"), False), (c("r"), False)], "place")
)
query("er_disposition", PAIR_SQL + "SELECT l, r, CASE WHEN (l + r) % 50 = 0 THEN 'merge' WHEN lc <> '' AND rc <> '' AND lc <> rc THEN 'distinct_ids' WHEN score >= 4 THEN 'related' ELSE 'not_duplicate' END AS disposition FROM q")(
    lambda q: X.disposition(p := X.resolve(q.master), p.where("(l + r) % 50 = 0")).select("l", "r", "disposition")
)
query("er_edit_similarity", PAIR_SQL + "SELECT l, r, CAST(floor(sim * 1000 + 0.0001) AS BIGINT) AS v FROM q")(lambda q: X.resolve(q.master).select("l", "r", F.floor(c("similarity") * 1000 + 0.0001).alias("v")))
query("er_capture_class", PAIR_SQL + "SELECT l, r, CASE WHEN l % 17 = 0 THEN 'blocked' WHEN r % 19 = 0 THEN 'no_result' WHEN sim >= 0.72 THEN 'exact' WHEN sim >= 0.5 THEN 'probable' ELSE 'ambiguous' END AS v FROM q")(
    lambda q: X.resolve(q.master).select("l", "r", X.capture_class(c("similarity"), c("r") % 19 != 0, c("l") % 17 == 0).alias("v"))
)
query("er_seqratio")(lambda q: X.resolve(q.master, lambda a, b: R.ratio_from(0.82, a, b)).select("l", "r", "similarity", "class"))
query("er_similarity")(lambda q: _captures(q).select("id", R.plain(R.without_place(c("business_name"))).alias("a"), R.plain(c("name")).alias("b")).select("id", R.similarity(c("a"), c("b")).alias("v")))
query("er_unicode_fold")(lambda q: q.master.select("id", X.unicode_fold(M).alias("v")))
query("er_clusters")(lambda q: X.clusters(X.resolve(q.master).where("class = 'strong'")))


@query("er_handle_score", f"WITH x AS (SELECT id, list_filter(list_distinct(string_split({M_NAME}, ' ')), lambda w: length(w) > 2) AS w, lower(instagram_handle) AS h FROM master ) SELECT id, CAST(floor(1000.0 * len(list_filter(w, lambda t: contains(h, t))) / greatest(len(w), 1) + 0.0001) AS BIGINT) AS v FROM x")
def _handle(q: Data):
    return q.master.select("id", F.floor(X.handle_share(T.norm_name(c(M)), c("instagram_handle")) * 1000 + 0.0001).alias("v"))


SIGNAL = {k: " OR ".join(f"contains(low, '{w}')" for w in words) for k, words in SHOWN.items()}
SIGNALS = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS t, lower(coalesce(html, '')) AS low, coalesce(url, '') AS url, {PLAIN_NAME.format(c="coalesce(html, '')")} AS folded, list_filter(string_split({PLAIN_NAME.format(c="coalesce(business_name, '')")}, ' '), lambda w: length(w) >= 4)[1:3] AS words FROM pages LEFT JOIN master m ON m.id = page_id)
SELECT page_id, len(words) > 0 AND len(list_filter(words, lambda w: contains(folded, w))) >= least(2, len(words)) AS identity_visible, length(t) >= 1000 AS nontrivial_text, {SIGNAL["category"]} AS category_signal, {SIGNAL["address"]} AS address_signal, {SIGNAL["hours"]} AS hours_signal,
  regexp_matches(t, '{SHOWN_PHONE}') AS phone_signal, {SIGNAL["website"]} AS website_signal, regexp_matches(t, '{SHOWN_RATING}') OR {SIGNAL["rating"]} AS rating_signal, {SIGNAL["photo"]} AS photo_signal, NOT ({SIGNAL["wall"]}) AND NOT contains(url, 'consent.google') AS no_wall_or_error FROM p"""


@query("er_signals", SIGNALS)
def _signals(q: Data):
    """Pages against the record of the same number."""
    both = q.pages.join(q.master.select(c("id").alias("page_id"), "business_name"), "page_id", "left")
    return both.select("page_id", visible_signals(c("business_name"), c("html"), c("url")).alias("s")).select("page_id", "s.*")


CIRCLES = "SELECT s_suppkey AS zone, 9.5 + (s_suppkey % 977) / 1954.0 AS centre_lat, -82.9 + (s_suppkey % 691) / 987.0 AS centre_lon, 0.3 + (s_suppkey % 5) * 0.4 AS radius_km FROM supplier"


@query("jn_range", f"SELECT m.id, z.zone FROM (SELECT id, TRY_CAST(latitude AS DOUBLE) AS lat, TRY_CAST(longitude AS DOUBLE) AS lon FROM master ) m JOIN ({CIRCLES}) z ON m.lat BETWEEN -90 AND 90 AND {km_sql('m.lat', 'm.lon', 'z.centre_lat', 'z.centre_lon')} <= z.radius_km")
def _circles(q: Data):
    """Places in circles around suppliers: a table of zones of any number."""
    from curio.operators.zones import in_circles

    s = c("s_suppkey")
    circles = q.supplier.select(s.alias("zone"), (9.5 + s % 977 / 1954.0).alias("centre_lat"), (-82.9 + s % 691 / 987.0).alias("centre_lon"), (0.3 + s % 5 * 0.4).alias("radius_km"))
    points = q.master.select("id", c("latitude").try_cast("double").alias("lat"), c("longitude").try_cast("double").alias("lon"))
    return in_circles(points, circles).select("id", "zone")


@query("jn_range_number", "SELECT c_custkey AS id, z.n AS zone FROM customer JOIN (SELECT * FROM (VALUES (0, 0.0, 2000.0), (1, 1500.0, 5000.0), (2, 4000.0, 9000.0)) AS t(n, lo, hi)) z ON c_acctbal BETWEEN z.lo AND z.hi")
def _range(q: Data):
    from curio.operators.relations import in_ranges

    zones = q.spark.createDataFrame([(0, 0.0, 2000.0), (1, 1500.0, 5000.0), (2, 4000.0, 9000.0)], "zone int, lo double, hi double")
    return in_ranges(q.customer.select(c("c_custkey").alias("id"), "c_acctbal"), "c_acctbal", zones).select("id", "zone")


@query("jn_set_overlap", "SELECT count(*) AS n FROM (SELECT id FROM master INTERSECT SELECT id FROM second )")
def _overlap(q: Data):
    return q.master.select("id").intersect(q.second.select("id")).agg(F.count("*").alias("n"))


@query("jn_cross_rules", "SELECT id, tag FROM master JOIN (SELECT * FROM (VALUES ('stay', 'hotel|casa'), ('food', 'café|bar'), ('sun', 'sol')) AS t(tag, pat)) r ON regexp_matches(lower(business_name), pat)")
def _rules(q: Data):
    from curio.operators.classify import tag_matches

    return tag_matches(q.master.select("id", F.lower(M).alias("text")), [("stay", "hotel|casa"), ("food", "café|bar"), ("sun", "sol")])


@query("set_union_all", "SELECT id, 1 AS priority FROM second UNION ALL SELECT id, 2 FROM master WHERE category = 'building' UNION ALL SELECT id, 3 FROM master WHERE category = 'furniture'")
def _union_all(q: Data):
    from curio.operators.relations import prioritised_union

    m = q.master.select("id", "category")
    return prioritised_union([q.second.select("id"), m.where("category = 'building'").select("id"), m.where("category = 'furniture'").select("id")])


@query("set_union_distinct", "SELECT area FROM master UNION SELECT area FROM second ")
def _union(q: Data):
    return q.master.select("area").union(q.second.select("area")).distinct()


@query("set_minus", "SELECT area FROM master WHERE id % 2 = 0 EXCEPT ALL SELECT area FROM second ")
def _minus(q: Data):
    return q.master.where("id % 2 = 0").select("area").exceptAll(q.second.select("area"))


@query("set_minus_distinct", "SELECT id FROM master EXCEPT SELECT id FROM second ")
def _minus_distinct(q: Data):
    return q.master.select("id").subtract(q.second.select("id"))


@query("set_intersect", "SELECT id FROM master INTERSECT SELECT id FROM second ")
def _intersect(q: Data):
    return q.master.select("id").intersect(q.second.select("id"))


for _name, _sql in (
    ("set_equal", "NOT EXISTS (SELECT id FROM master EXCEPT SELECT id FROM second ) AND NOT EXISTS (SELECT id FROM second EXCEPT SELECT id FROM master )"),
    ("set_disjoint", "NOT EXISTS (SELECT id FROM master INTERSECT SELECT id FROM second )"),
    ("set_subset", "NOT EXISTS (SELECT id FROM second EXCEPT SELECT id FROM master )"),
):

    def _check(q: Data, kind=_name):
        from curio.operators import relations as R

        return getattr(R, kind)(q.second.select("id"), q.master.select("id"), "id")

    query(_name, f"SELECT {_sql} AS ok")(_check)
