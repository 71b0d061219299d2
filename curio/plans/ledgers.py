"""Sources, sinks, and ledgers in batch and as streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curio.functions import geo as G
from curio.functions import text as T
from curio.plans.basics import M, SLUG
from curio.plans.places import CENTRE, GRID
from curio.plans.registry import Data, query
from curio.sources import readers as R
from curio.sources import writers as W
from curio.sources.shared import folder
from curio.streaming import ledger as L

c = F.col


def _folder(q: Data, name: str) -> str:
    """A new path in the folder that all machines share."""
    return folder(q.spark, name)


def _few(q: Data) -> DataFrame:
    return q.master.select("id", M, "area", "phone")


FEW = "SELECT CAST(id AS STRING) AS id, business_name, area, phone FROM master "


def _blank(df: DataFrame) -> DataFrame:
    return df.select(*[F.coalesce(x, F.lit("")).alias(x) for x in df.columns])


@query("src_csv", FEW)
def _csv(q: Data):
    p = _folder(q, "csv")
    W.csv(_few(q), p, ["id", M, "area", "phone"])
    return _blank(R.csv(q.spark, p))


CELL = "CASE WHEN {x} = '' THEN '\"\"' WHEN contains({x}, ',') THEN '\"' || {x} || '\"' ELSE {x} END"


@query("snk_csv", f"SELECT concat_ws(',', {CELL.format(x='area')}, CAST(id AS STRING), {CELL.format(x=M)}) AS line FROM master UNION ALL SELECT 'area,id,{M}'")
def _lines(q: Data):
    """The lines of a written file: fields in the given order, one header, quotes where they are needed."""
    p = _folder(q, "csv-lines")
    W.csv(_few(q), p, ["area", "id", M], single=True)
    return q.spark.read.text(p).select(c("value").alias("line"))


@query("src_csv_optional", "SELECT CAST(NULL AS STRING) AS id, CAST(NULL AS STRING) AS business_name WHERE false")
def _optional(q: Data):
    return R.csv_optional(q.spark, _folder(q, "none"), f"id string, {M} string")


@query("src_csv_multi", f"SELECT CAST(id AS STRING) AS id, CASE WHEN website <> '' THEN {M} ELSE 'second' END AS {M} FROM master ")
def _multi(q: Data):
    a, b = _folder(q, "a"), _folder(q, "b")
    W.csv(q.master.where("website <> ''"), a, ["id", M])
    W.csv(q.master.select("id", F.lit("second").alias(M)), b, ["id", M])  # ids of the first file keep its names
    return R.csv_multi(q.spark, [a, b], "id").select("id", M)


def _json(q: Data) -> str:
    p = _folder(q, "json")
    W.jsonl_append(q.master.select("id", M, "area"), p)
    return p


JSON = "SELECT id, business_name, area FROM master "
DDL = f"id bigint, {M} string, area string"
query("src_jsonl", JSON)(lambda q: R.json_lines(q.spark, _json(q), DDL))


@query("snk_jsonl_append", JSON + "UNION ALL SELECT id, business_name, 'again' FROM master WHERE operating_status = 'active'")
def _appended(q: Data):
    """Two appends to one folder."""
    p = _json(q)
    W.jsonl_append(q.master.where("operating_status = 'active'").select("id", M, F.lit("again").alias("area")), p)
    return R.json_lines(q.spark, p, DDL)


query("src_json_auto", JSON)(lambda q: R.json_auto(q.spark, _json(q), DDL))


@query("src_json_array", "SELECT n_nationkey AS id, n_name AS name FROM nation")
def _array(q: Data):
    p = _folder(q, "array")
    rows = q.nation.groupBy("n_regionkey").agg(F.to_json(F.collect_list(F.struct(c("n_nationkey").alias("id"), c("n_name").alias("name")))).alias("value")).select("value")
    rows.repartition(q.nation.select("n_regionkey").distinct().count(), "value").write.option("maxRecordsPerFile", 1).text(p)
    return R.json_array(q.spark, p, "id int, name string")


KEYED = "SELECT CAST(n_nationkey AS STRING) AS key, n_name AS name FROM nation"


@query("src_json_keyed", KEYED)
def _keyed(q: Data):
    p = _folder(q, "keyed")
    m = q.nation.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(c("n_nationkey").cast("string"), F.struct(c("n_name").alias("name")))))).alias("value"))
    m.coalesce(1).write.text(p)
    return R.json_keyed(q.spark, p, "struct<name:string>")


@query("src_json_versioned", "SELECT CAST(id AS STRING) AS cid, CASE WHEN id % 2 = 0 THEN 'M742+8M Town' ELSE area END AS address, CASE WHEN id % 2 = 0 THEN 'M742+8M' END AS plus_code FROM master ")
def _versioned(q: Data):
    p = _folder(q, "versioned")
    v3 = F.map_from_arrays(F.array(F.lit("address")), F.array(F.struct(F.lit("M742+8M Town").alias("value"), F.lit(0.5).alias("confidence"))))
    rows = q.master.select(c("id").cast("string").alias("cid"), F.when(c("id") % 2 == 0, v3).alias("fields"), F.when(c("id") % 2 == 1, F.create_map(F.lit("address"), c("area"))).alias("data"))
    rows.write.json(p)
    d = R.json_versioned(q.spark, p)
    return d.select("cid", F.try_element_at("fields", F.lit("address")).alias("address"), F.try_element_at("fields", F.lit("plus_code")).alias("plus_code"))


@query("src_osm", "SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation WHERE n_nationkey % 4 <> 0 AND n_nationkey % 3 <> 0")
def _osm(q: Data):
    p = _folder(q, "osm")
    e = F.struct(F.lit("node").alias("type"), c("n_nationkey").cast("bigint").alias("id"), F.when(c("n_nationkey") % 3 != 0, 9.5).alias("lat"), F.lit(-82.5).alias("lon"), F.create_map(F.lit("name"), F.when(c("n_nationkey") % 4 != 0, c("n_name")).otherwise(" ")).alias("tags"))
    q.nation.groupBy("n_regionkey").agg(F.collect_list(e).alias("elements")).select("elements").repartition(5).write.option("maxRecordsPerFile", 1).json(p)
    return R.osm(q.spark, p).select("id", "name")


@query("src_sqlite", "SELECT page_id, url FROM pages WHERE length(html) > 1000")
def _sqlite(q: Data):
    from curio.sources.sqlite import read_sqlite, write_sqlite

    p = _folder(q, "sqlite")
    write_sqlite(q.pages.select("page_id", "url", "html"), p, "cache")
    return read_sqlite(q.spark, p, "cache", 1000).where(F.length("html") > 1000).select("page_id", "url")


query("src_html_cache", "SELECT page_id, url FROM pages WHERE contains(url, '/fr/') ORDER BY url, page_id LIMIT 1")(lambda q: R.cached_page(q.pages, "/fr/").select("page_id", "url"))


@query("src_text_files", "SELECT n_name AS listing, CASE WHEN n_nationkey % 2 = 0 THEN 'clean' ELSE 'failed' END AS text FROM nation")
def _files(q: Data):
    base = _folder(q, "text")
    jvm = q.spark._jvm
    for r in q.nation.select("n_nationkey", "n_name").collect():  # a fixture of 25 small files
        for kind in ["failure", *(["clean"] if r.n_nationkey % 2 == 0 else [])]:
            path = jvm.org.apache.hadoop.fs.Path(f"{base}/{r.n_name}.{kind}.txt")
            out = path.getFileSystem(q.spark._jsc.hadoopConfiguration()).create(path)
            out.write(bytearray(b"clean" if kind == "clean" else b"failed"))
            out.close()
    return R.text_files(q.spark, base)


LEDGER = "rid bigint, seq bigint, state string, version string, value double"


def _written(q: Data) -> str:
    p = _folder(q, "ledger")
    W.jsonl_append(q.ledger.select("rid", "seq", "state", "version", "value"), p)
    return p


query("src_ledger", "SELECT rid, seq, state FROM ledger ")(lambda q: R.ledger(q.spark, _written(q), LEDGER).select("rid", "seq", "state"))


@query("src_grid", "SELECT r.range AS row, count(*) AS cells FROM range(-13, 14) r, (" + GRID + ") g WHERE g.row = r.range GROUP BY r.range")
def _cells(q: Data):
    """Cells of each row of the generated grid."""
    cells = G.grid(q.spark, 0.5, CENTRE, 6.0, [(9.6, -82.85, 9.7, -82.6)], [(9.65, -82.75, 1.0)])
    return cells.groupBy(c("row").cast("bigint").alias("row")).agg(F.count("*").alias("cells"))


@query("src_org", "SELECT CAST(n_nationkey AS STRING) AS slug, n_name AS name, 'community' AS kind FROM nation")
def _orgs(q: Data):
    p = _folder(q, "orgs")
    m = q.nation.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(c("n_nationkey").cast("string"), F.struct(c("n_name").alias("name")))))).alias("value"))
    m.coalesce(1).write.text(p)
    return R.organisations(q.spark, p, {"name": "", "kind": "community"})


@query("snk_atomic", "SELECT id, area FROM master WHERE operating_status <> 'closed'")
def _swap(q: Data):
    p = _folder(q, "table")
    W.publish(q.master.select("id", "area", "operating_status"), p)
    W.publish(W.published(q.spark, p).where("operating_status <> 'closed'").select("id", "area"), p)
    return W.published(q.spark, p)


query("snk_json_keyed", "SELECT CAST(id AS STRING) AS key, '{\"area\":\"' || area || '\",\"category\":\"' || category || '\"}' AS value FROM master ")(lambda q: W.keyed(q.master.withColumn("id", c("id").cast("string")), "id", ["area", "category"]))
query("snk_export_sorted", "SELECT category, area, business_name, id FROM master ORDER BY category, area, business_name, id")(lambda q: W.export_sorted(q.master, ["category", "area", M, "id"], ["category", "area", M, "id"]))
LATLON = "TRY_CAST(latitude AS DOUBLE) BETWEEN -90 AND 90 AND TRY_CAST(longitude AS DOUBLE) BETWEEN -180 AND 180"
query("snk_geojson", f"SELECT id, '{{\"type\":\"Feature\",\"geometry\":{{\"type\":\"Point\",\"coordinates\":[' || round(CAST(longitude AS DOUBLE), 6) || ',' || round(CAST(latitude AS DOUBLE), 6) || ']}},\"properties\":{{\"name\":\"' || substr(business_name, 1, 60) || '\"}}}}' AS v FROM master WHERE {LATLON}")(
    lambda q: q.master.where(G.valid(c("latitude"), c("longitude"))).select("id", W.geojson(c(M), F.round(c("latitude").cast("double"), 6), F.round(c("longitude").cast("double"), 6)).alias("v"))
)
query("snk_js_payload", "SELECT category AS key, '{\"n\":' || count(*) || '}' AS value FROM master GROUP BY category")(lambda q: W.keyed(q.master.groupBy("category").agg(F.count("*").alias("n")), "category", ["n"]))
query("snk_sitemap", f"SELECT '<url><loc>https://x.example.com/' || {SLUG.format(n=M, a='area')} || '/</loc></url>' AS v FROM master ")(lambda q: q.master.select(W.sitemap("https://x.example.com", T.slug(c(M), c("area"))).alias("v")))
query("snk_markdown", "SELECT '| ' || id || ' | ' || replace(business_name || '|', '|', '\\|') || ' |' AS v FROM master ")(lambda q: q.master.select(W.markdown_row([c("id"), F.concat(M, F.lit("|"))]).alias("v")))
query("snk_sheet", "SELECT id, CASE WHEN website <> '' THEN '=HYPERLINK(\"' || website || '\",\"' || area || '\")' ELSE '' END AS v FROM master ")(lambda q: q.master.select("id", W.sheet_link(c("website"), c("area")).alias("v")))
query("snk_archive", "SELECT id, '{\"id\":' || id || ',\"area\":\"' || area || '\"}' AS before, CASE WHEN operating_status <> 'closed' THEN '{\"id\":' || id || ',\"area\":\"x\"}' END AS after FROM master WHERE operating_status = 'closed' OR category = 'building'")(
    lambda q: W.archive(q.master.select("id", "area"), q.master.where("operating_status <> 'closed'").select("id", F.when(c("category") == "building", "x").otherwise(c("area")).alias("area")), "id")
)

query("st_checkpoint", "SELECT c_custkey AS rid FROM customer WHERE c_custkey NOT IN (SELECT rid FROM ledger WHERE version = 'v1')")(lambda q: L.pending(q.customer.select(c("c_custkey").alias("rid")), q.ledger, "rid", "v1"))
RETRY = "SELECT rid, attempts FROM (SELECT rid, count(*) FILTER (WHERE state IN ('error', 'view')) AS attempts, arg_max(state, seq) AS last FROM ledger GROUP BY rid) WHERE last IN ('error', 'view') AND attempts < 6"
query("st_retry", RETRY)(lambda q: L.retries(q.ledger, "rid", ["error", "view"], 6))
query("st_retry_queue", "SELECT rid FROM ledger GROUP BY rid HAVING count(*) FILTER (WHERE state = 'purchase') = 0")(lambda q: L.retry_queue(q.ledger, "rid", ["purchase"]))


def _stream(q: Data, make, mode: str) -> DataFrame:
    """All of the ledger as a stream, through `make`, until it is done; what it wrote in the end."""
    src, name = _written(q), f"curio_{uuid.uuid4().hex}"
    s = make(R.ledger(q.spark, src, LEDGER, stream=True))
    run = s.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", _folder(q, "checkpoint")).trigger(availableNow=True).start()
    run.awaitTermination()
    return q.spark.table(name)


@query("st_retry_stream", RETRY)
def _retry_stream(q: Data):
    """Retries as a stream: of each rid the row of its last batch, where another attempt is due."""
    s = L.retry_state(R.ledger(q.spark, _written(q), LEDGER, stream=True, files=64), "rid", ["error", "view"], 6)
    news = L.run_updates(s, _folder(q, "retries"), _folder(q, "checkpoint"))
    last = news.groupBy("rid").agg(F.max_by(F.struct("attempts", "retry"), "batch").alias("n"))
    return last.where("n.retry").select("rid", "n.attempts")


query("st_progress", "SELECT state, count(*) AS entries, max(seq) AS last_seq FROM ledger GROUP BY state")(lambda q: _stream(q, L.progress, "complete"))


@query("st_append", "SELECT rid, seq, state FROM ledger ")
def _append(q: Data):
    src, out = _written(q), _folder(q, "appended")
    s = R.ledger(q.spark, src, LEDGER, stream=True).select("rid", "seq", "state")
    s.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", _folder(q, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return q.spark.read.parquet(out)


query("st_compact", "SELECT rid, seq, state FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY seq DESC) AS k FROM ledger ) WHERE k = 1")(lambda q: L.compact(q.ledger, "rid").select("rid", "seq", "state"))
query("st_windows", "SELECT CAST(date_trunc('hour', ts) AS STRING) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")(lambda q: L.windows(q.events))
SESSIONS = """WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
SELECT CAST(min(ts) AS STRING) AS start, user_id, count(*) AS n FROM s GROUP BY user_id, k"""
query("st_sessions", SESSIONS)(lambda q: L.sessions(q.events))
