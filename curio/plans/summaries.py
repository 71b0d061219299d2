"""Aggregations, window-like queries, ordering, limits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from curio.functions import text as T
from curio.functions.scores import rounded
from curio.operators import summaries as A
from curio.plans.basics import M, PHONE, SLUG
from curio.plans.registry import Data, query

c = F.col


@query("agg_count_by", "SELECT CASE WHEN trim(operating_status) <> '' THEN operating_status ELSE 'unknown' END AS key, count(*) AS n FROM master GROUP BY 1")
def _count(q: Data):
    return A.count_by(q.master, c("operating_status"))


PCT = "CAST(printf('%.1f', 100.0 * {a} / {b}) AS DOUBLE)"  # to one place, exact halves to even


@query("agg_cond_sum", "SELECT category, n, phone, website, coords, " + ", ".join(f"{PCT.format(a=k, b='n')} AS {k}_pct" for k in ("phone", "website", "coords")) + " FROM (SELECT category, count(*) AS n, count(*) FILTER (WHERE phone <> '') AS phone, count(*) FILTER (WHERE website <> '') AS website, count(*) FILTER (WHERE latitude <> '') AS coords FROM master GROUP BY category)")
def _cond(q: Data):
    g = A.coverage(q.master, "category", {"phone": T.present(c("phone")), "website": T.present(c("website")), "coords": T.present(c("latitude"))})
    return g.select("*", *[rounded(c(k) * 100 / c("n"), 1).alias(f"{k}_pct") for k in ("phone", "website", "coords")])


MISSING = ("phone", "website", "email", "latitude", "instagram_handle", "description_full")


@query("agg_missing", f"SELECT field, missing, total, {PCT.format(a='missing', b='total')} AS pct FROM (" + " UNION ALL ".join(f"SELECT '{f}' AS field, count(*) FILTER (WHERE {f} = '') AS missing, count(*) AS total FROM master " for f in MISSING) + ")")
def _missing(q: Data):
    return A.missing(q.master, list(MISSING)).withColumn("pct", rounded(c("missing") * 100 / c("total"), 1))


@query("agg_having_dup", "SELECT area, category, count(*) AS n FROM master GROUP BY area, category HAVING count(*) > 1")
def _having(q: Data):
    return q.master.groupBy("area", "category").agg(F.count("*").alias("n")).where("n > 1")


@query("agg_dup_key", "SELECT google_maps_cid AS key, count(*) AS n FROM master WHERE google_maps_cid <> '' GROUP BY 1 HAVING count(*) > 1")
def _dup(q: Data):
    from curio.operators.quality import duplicates

    return duplicates(q.master, c("google_maps_cid"))


@query("agg_metrics", f"SELECT count(*) AS n, count(*) FILTER (WHERE {PHONE} <> '') AS phones, count(*) FILTER (WHERE whatsapp <> '') AS whatsapps, count(*) FILTER (WHERE website <> '') AS websites, count(*) FILTER (WHERE google_maps_cid <> '') AS mapped, count(*) FILTER (WHERE latitude <> '') AS located, count(*) FILTER (WHERE email <> '') AS emails, count(*) FILTER (WHERE description_full <> '') AS described, count(*) FILTER (WHERE operating_status = 'closed') AS closed, count(DISTINCT area) AS areas FROM master ")
def _metrics(q: Data):
    has = lambda f: F.count_if(T.present(c(f)))
    return q.master.agg(
        F.count("*").alias("n"), F.count_if(T.phone_e164(c("phone")) != "").alias("phones"), has("whatsapp").alias("whatsapps"), has("website").alias("websites"), has("google_maps_cid").alias("mapped"),
        has("latitude").alias("located"), has("email").alias("emails"), has("description_full").alias("described"), F.count_if(c("operating_status") == "closed").alias("closed"), F.countDistinct("area").alias("areas"),
    )


@query("agg_facet_sorted", "SELECT category AS key, count(*) AS n FROM master GROUP BY category ORDER BY n DESC, key")
def _facet(q: Data):
    return A.count_by(q.master, c("category")).orderBy(F.desc("n"), "key")


@query("agg_facet_multi", "SELECT value, count(*) AS n FROM (SELECT DISTINCT id, unnest([category, lower(area), region]) AS value FROM master ) GROUP BY value")
def _multi(q: Data):
    return A.facet(q.master, F.array("category", F.lower("area"), "region"))


@query("agg_group_counts", "SELECT value, count(*) AS n FROM (SELECT DISTINCT id, unnest(string_split(lower(description_full), ' ')) AS value FROM master WHERE description_full <> '') GROUP BY value")
def _groups(q: Data):
    return A.facet(q.master.where("description_full <> ''"), F.split(F.lower("description_full"), " "))


GOOD = "wifi|pool|spa|gimnasio"
LISTED = "SELECT unnest(list_filter(list_transform(regexp_split_to_array(amenities, '[,;]'), lambda x: trim(x)), lambda x: x <> '')) AS value FROM places "


@query("agg_most_common", f"WITH l AS ({LISTED}), a AS (SELECT value, count(*) AS n FROM l GROUP BY value), b AS (SELECT value, count(*) AS n FROM l WHERE regexp_matches(lower(value), '{GOOD}') GROUP BY value) SELECT value, a.n AS before, coalesce(b.n, 0) AS after, a.n - coalesce(b.n, 0) AS removed FROM a LEFT JOIN b USING (value) ORDER BY before DESC, value LIMIT 15")
def _common(q: Data):
    """The 15 most common values before a cleaning, with how many it kept and removed."""
    items = q.places.select(F.explode(T.split_list(c("amenities"))).alias("value"))
    both = A.multiset_difference(items, items.where(F.lower("value").rlike(GOOD)), "value")
    return both.orderBy(F.desc("before"), "value").limit(15)


@query("agg_two_key", "SELECT state, version, count(*) AS n FROM ledger GROUP BY state, version")
def _two(q: Data):
    return q.ledger.groupBy("state", "version").agg(F.count("*").alias("n"))


@query("agg_avg", "SELECT area, CAST(printf('%.1f', CAST(sum(length(business_name)) AS DOUBLE) / count(*)) AS DOUBLE) AS mean, CAST(sum(CAST(round(TRY_CAST(latitude AS DOUBLE) * 2000) AS BIGINT)) // count(*) AS BIGINT) AS lat FROM master WHERE latitude <> '' GROUP BY area")
def _avg(q: Data):
    located = q.master.where("latitude <> ''")
    return located.groupBy("area").agg(rounded(F.avg(F.length(M)), 1).alias("mean"), F.floor(F.avg(F.round(c("latitude").try_cast("double") * 2000).cast("bigint"))).alias("lat"))


@query("rounding", "SELECT c_custkey AS id, CAST(printf('%.2f', c_custkey / 8.0) AS DOUBLE) AS eighths, CAST(printf('%.2f', CAST(1.005 AS DOUBLE) + c_custkey) AS DOUBLE) AS fives, CAST(printf('%.0f', c_custkey / 2.0) AS DOUBLE) AS halves FROM customer")
def _rounding(q: Data):
    k = c("c_custkey")
    return q.customer.select(k.alias("id"), rounded(k / 8, 2).alias("eighths"), rounded(F.lit(1.005) + k, 2).alias("fives"), rounded(k / 2, 0).alias("halves"))


@query("agg_pass_fail", "SELECT area, count(*) FILTER (WHERE latitude <> '') AS pass, count(*) FILTER (WHERE latitude = '') AS fail, count(*) AS total FROM master GROUP BY area")
def _pass(q: Data):
    return q.master.groupBy("area").agg(F.count_if(c("latitude") != "").alias("pass"), F.count_if(c("latitude") == "").alias("fail"), F.count("*").alias("total"))


@query("agg_coverage_pct", "SELECT area, count(*) AS total, count(s.id) AS matched, CAST(printf('%.1f', 100.0 * count(s.id) / count(*)) AS DOUBLE) AS pct FROM master m LEFT JOIN (SELECT id FROM second ) s ON s.id = m.id GROUP BY area")
def _pct(q: Data):
    j = q.master.select("id", "area").join(q.second.select("id", F.lit(1).alias("hit")), "id", "left")
    return j.groupBy("area").agg(F.count("*").alias("total"), F.count("hit").alias("matched")).withColumn("pct", rounded(c("matched") * 100 / c("total"), 1))


@query("agg_owners", f"SELECT value, count(*) AS n, string_agg(CAST(id AS STRING), ',' ORDER BY id) AS ids FROM (SELECT DISTINCT id, {PHONE} AS value FROM master ) WHERE value <> '' GROUP BY value HAVING count(*) > 1")
def _owners(q: Data):
    return A.owners(q.master, T.phone_e164(c("phone")))


@query("agg_field_coverage", "SELECT k AS field, count(*) AS n FROM (SELECT unnest(map_keys(map_from_entries(list_filter([struct_pack(k := 'phone', v := phone), struct_pack(k := 'email', v := email), struct_pack(k := 'website', v := website)], lambda e: e.v <> '')))) AS k FROM master ) GROUP BY k")
def _fields(q: Data):
    m = F.map_filter(F.create_map(*[x for f in ("phone", "email", "website") for x in (F.lit(f), c(f))]), lambda k, v: v != "")
    return q.master.select(F.explode(F.map_keys(m)).alias("field")).groupBy("field").agg(F.count("*").alias("n"))


@query("agg_exposure", "SELECT coalesce(a.tag, b.tag) AS tag, coalesce(a.n, 0) AS now, coalesce(b.n, 0) AS could, coalesce(b.n, 0) - coalesce(a.n, 0) AS delta FROM (SELECT category AS tag, count(*) AS n FROM master WHERE operating_status = 'active' GROUP BY 1) a FULL JOIN (SELECT category AS tag, count(*) AS n FROM master GROUP BY 1) b ON a.tag = b.tag")
def _exposure(q: Data):
    from curio.operators.classify import exposure

    rows = q.master.select("id", c("category").alias("tag"), "operating_status")
    return exposure(rows.where("operating_status = 'active'"), rows)


BUCKETS = {"click": "succeeded", "view": "no_data", "purchase": "succeeded", "error": "failed"}


@query("agg_status_buckets", "SELECT CASE state " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in BUCKETS.items()) + " ELSE 'not_applicable' END AS bucket, count(*) AS n FROM ledger GROUP BY 1")
def _buckets(q: Data):
    from curio.streaming.ledger import bucket

    return q.ledger.groupBy(bucket(c("state"), BUCKETS).alias("bucket")).agg(F.count("*").alias("n"))


@query("agg_rate", "SELECT count(*) AS done, count(*) FILTER (WHERE state = 'error') AS failed, CAST(floor(10000.0 * count(*) FILTER (WHERE state = 'error') / count(*)) AS BIGINT) AS rate, CAST(floor(sum(floor(value * 100)) / count(*)) AS BIGINT) AS mean FROM ledger ")
def _rate(q: Data):
    g = q.ledger.agg(F.count("*").alias("done"), F.count_if(c("state") == "error").alias("failed"), F.sum(F.floor(c("value") * 100)).alias("s"))
    return g.select("done", "failed", F.floor(c("failed") * 10000 / c("done")).alias("rate"), F.floor(c("s") / c("done")).alias("mean"))


@query("agg_revenue", "SELECT status, method, sum(amount_usd) AS usd, sum(amount_usd * 525) AS crc, count(*) AS n FROM invoices GROUP BY status, method")
def _revenue(q: Data):
    return q.invoices.groupBy("status", "method").agg(F.sum("amount_usd").alias("usd"), F.sum(c("amount_usd") * 525).alias("crc"), F.count("*").alias("n"))


@query("agg_totals", "SELECT count(*) FILTER (WHERE n > 1) AS with_data, CAST(sum(n) AS BIGINT) AS entries, count(DISTINCT role) AS groups FROM (SELECT conv_id, role, count(*) AS n FROM conversations GROUP BY conv_id, role)")
def _totals(q: Data):
    g = q.conversations.groupBy("conv_id", "role").agg(F.count("*").alias("n"))
    return g.agg(F.count_if(c("n") > 1).alias("with_data"), F.sum("n").alias("entries"), F.countDistinct("role").alias("groups"))


@query("agg_severity", "SELECT CASE WHEN phone = '' AND email = '' THEN 'high' WHEN website = '' THEN 'medium' ELSE 'low' END AS severity, count(*) AS n FROM master GROUP BY 1 ORDER BY CASE severity WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END")
def _severity(q: Data):
    s = F.when((c("phone") == "") & (c("email") == ""), "high").when(c("website") == "", "medium").otherwise("low")
    return q.master.groupBy(s.alias("severity")).agg(F.count("*").alias("n")).orderBy(F.array_position(F.lit(["high", "medium", "low"]), c("severity")))


@query("win_latest", "SELECT rid, seq, state FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY captured_at DESC, seq DESC) AS k FROM ledger ) WHERE k = 1")
def _latest(q: Data):
    return A.latest(q.ledger, ["rid"], [F.desc("captured_at"), F.desc("seq")]).select("rid", "seq", "state")


@query("win_last_in_file", "SELECT rid, seq FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY seq DESC) AS k FROM ledger WHERE value > 10) WHERE k = 1")
def _last(q: Data):
    return A.latest(q.ledger.where("value > 10"), ["rid"], [F.desc("seq")]).select("rid", "seq")


@query("win_first", "SELECT business_name, id FROM (SELECT *, row_number() OVER (PARTITION BY business_name ORDER BY id) AS k FROM master ) WHERE k = 1")
def _first(q: Data):
    return q.master.groupBy(M).agg(F.min("id").alias("id"))


@query("win_prefer", "SELECT rid, seq FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY CASE WHEN state = 'error' THEN 1 ELSE 0 END, seq) AS k FROM ledger ) WHERE k = 1")
def _prefer(q: Data):
    return A.latest(q.ledger, ["rid"], [F.when(c("state") == "error", 1).otherwise(0), c("seq")]).select("rid", "seq")


@query("win_slug_suffix", f"WITH s AS (SELECT id, {SLUG.format(n='category', a='area')} AS slug, lower(business_name) AS o FROM master ), k AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY o, id) - 1 AS k FROM s) SELECT id, CASE WHEN k > 0 THEN slug || '-' || k ELSE slug END AS slug FROM k")
def _slug(q: Data):
    s = q.master.select("id", T.slug(c("category"), c("area")).alias("slug"), F.lower(M).alias("o"))
    return A.slug_suffix(s, "slug", [c("o"), c("id")]).select("id", c("slug_unique").alias("slug"))


@query("win_unique_only", "SELECT id, phone FROM master WHERE phone IN (SELECT phone FROM master GROUP BY phone HAVING count(*) = 1)")
def _once(q: Data):
    return A.once_only(q.master.select("id", "phone"), "phone").select("id", "phone")


@query("win_nearest_target", "SELECT source, doc_id, distance FROM (SELECT source, doc_id, abs(n_chars - 4000) AS distance, row_number() OVER (PARTITION BY source ORDER BY abs(n_chars - 4000), doc_id) AS k FROM documents) WHERE k = 1")
def _nearest(q: Data):
    return A.nearest(q.documents, "source", c("n_chars"), 4000, "doc_id")


@query("win_cap_per_group", "WITH a AS (SELECT *, row_number() OVER (PARTITION BY rid, state ORDER BY value DESC, seq) AS r FROM ledger ), b AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY CASE WHEN r > 2 THEN 1 ELSE 0 END, value DESC, seq) AS place FROM a) SELECT rid, seq, place FROM b WHERE place <= 6")
def _cap(q: Data):
    return A.capped_fill(q.ledger, "rid", "state", [F.desc("value"), c("seq")], 2, 6).select("rid", "seq", "place")


SUMMARY_SQL = """WITH x AS (SELECT rid, state, seq, CASE state WHEN 'purchase' THEN 0 WHEN 'view' THEN 1 ELSE 2 END AS first, CASE WHEN seq % 7 = 0 THEN 40 ELSE 0 END - CASE WHEN seq % 5 = 0 THEN 30 ELSE 0 END AS extra FROM ledger ),
g AS (SELECT rid, state, row_number() OVER (PARTITION BY rid ORDER BY min(first), state) - 1 AS r, sum(count(*)) OVER (PARTITION BY rid) AS total FROM x GROUP BY rid, state),
s AS (SELECT x.rid, x.state, x.seq, 50 - 10 * r + extra AS score, total, row_number() OVER (PARTITION BY x.rid, x.state ORDER BY extra DESC, x.seq) AS k FROM x JOIN g ON x.rid = g.rid AND x.state = g.state),
p AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY CASE WHEN k > 2 THEN 1 ELSE 0 END, score DESC, state, seq) AS place FROM s)
SELECT rid, seq, score, place FROM p WHERE place <= CASE WHEN total <= 8 THEN 8 WHEN total <= 20 THEN 6 ELSE 8 END"""


@query("ar_attr_summary", SUMMARY_SQL)
def _attr_summary(q: Data):
    first = F.when(c("state") == "purchase", 0).when(c("state") == "view", 1).otherwise(2)
    return A.ranked_summary(q.ledger, "rid", "state", first, "seq", c("seq") % 7 == 0, c("seq") % 5 == 0).select("rid", "seq", "score", "place")


@query("win_next_id", "SELECT min(k) AS next_id FROM (SELECT o_orderkey + 1 AS k FROM orders UNION SELECT 1) WHERE k NOT IN (SELECT o_orderkey FROM orders) AND k > 0")
def _next(q: Data):
    return A.next_id(q.orders, "o_orderkey")


@query("win_lead_overlap", "SELECT user_id AS rid, event_id AS seq, coalesce(lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) < event_id + 40, false) AS overlaps FROM events")
def _overlap(q: Data):
    from curio.operators.schedules import overlaps

    rows = q.events.select(c("user_id").alias("rid"), c("event_id").alias("seq"), c("event_id").alias("a"), (c("event_id") + 40).alias("b"))
    return overlaps(rows, ["rid"], "a", "b").select("rid", "seq", "overlaps")


def _ordered(name: str, order_sql: str, order) -> None:
    """All of master in an order; the place of each row shows it."""

    @query(name, f"SELECT id, row_number() OVER (ORDER BY {order_sql}) AS place FROM master ")
    def _(q: Data):
        return A.placed(q.master, order(), "place", ["id"]).select("id", "place")


UP, DOWN = False, True
_ordered("srt_multi", "category, area, business_name, id", lambda: [(c("category"), UP), (c("area"), UP), (c(M), UP), (c("id"), UP)])
_ordered("srt_ci", "lower(business_name), id", lambda: [(F.lower(M), UP), (c("id"), UP)])
_ordered("srt_custom", "CASE category WHEN 'furniture' THEN 0 ELSE 1 END, CASE region WHEN 'ASIA' THEN 1 WHEN 'EUROPE' THEN 2 ELSE 0 END, business_name, id", lambda: [(F.when(c("category") == "furniture", 0).otherwise(1), UP), (F.array_position(F.lit(["ASIA", "EUROPE"]), c("region")), UP), (c(M), UP), (c("id"), UP)])
_ordered("srt_search", "CASE WHEN phone <> '' THEN 1 ELSE 0 END + CASE WHEN website <> '' THEN 1 ELSE 0 END DESC, lower(business_name), id", lambda: [(T.present(c("phone")).cast("int") + T.present(c("website")).cast("int"), DOWN), (F.lower(M), UP), (c("id"), UP)])
_ordered("srt_triage", "CASE WHEN category = 'building' THEN 1 ELSE 2 END, CASE WHEN operating_status = 'active' THEN 0 ELSE 1 END, coalesce(TRY_CAST(google_maps_cid AS BIGINT), 0) DESC, id", lambda: [(F.when(c("category") == "building", 1).otherwise(2), UP), (F.when(c("operating_status") == "active", 0).otherwise(1), UP), (F.coalesce(c("google_maps_cid").try_cast("bigint"), F.lit(0)), DOWN), (c("id"), UP)])


@query("lim_page", "SELECT id FROM master ORDER BY lower(business_name), id LIMIT 150")
def _page(q: Data):
    from curio.operators.search import page

    return page(q.master, [F.lower(M), c("id")], 3).select("id")


@query("lim_topk", "SELECT c_custkey AS id, c_acctbal AS v FROM customer ORDER BY c_acctbal, c_custkey LIMIT 10")
def _topk(q: Data):
    return q.customer.orderBy("c_acctbal", "c_custkey").limit(10).select(c("c_custkey").alias("id"), c("c_acctbal").alias("v"))


@query("lim_batch", "SELECT conv_id, turn FROM conversations ORDER BY conv_id, turn LIMIT 40")
def _batch(q: Data):
    return q.conversations.orderBy("conv_id", "turn").limit(40).select("conv_id", "turn")


@query("smp_pilot", "SELECT id, category FROM (SELECT id, category, row_number() OVER (PARTITION BY category ORDER BY md5(CAST(id AS STRING)), id) AS k FROM master ) WHERE k <= 3 UNION ALL SELECT -1, 'control'")
def _pilot(q: Data):
    control = q.spark.sql("SELECT CAST(-1 AS BIGINT) AS id, 'control' AS category")
    return A.stratified_pilot(q.master.select("id", "category"), "category", [F.md5(c("id").cast("string").cast("binary")), c("id")], 3, control)
