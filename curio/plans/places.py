"""Geographic queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from curio.functions import geo as G
from curio.operators.summaries import placed
from curio.plans.registry import Data, query

c = F.col
CENTRE = (9.65, -82.75)
KM = "(6371.0 * 2 * atan2(sqrt({a}), sqrt(1 - {a})))"


def km_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = f"(pow(sin(radians({lat2} - ({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - ({lon1})) / 2), 2))"
    return KM.format(a=a)


LAT, LON = "TRY_CAST(latitude AS DOUBLE)", "TRY_CAST(longitude AS DOUBLE)"
HERE = km_sql(LAT, LON, "9.65", "-82.75")


def _latlon(q: Data):
    return q.master.select("id", "area", G.to_double(c("latitude")).alias("lat"), G.to_double(c("longitude")).alias("lon"))


@query("geo_haversine_km", f"SELECT id, CAST(floor({HERE} * 1000) AS BIGINT) AS metres FROM master WHERE latitude <> ''")
def _km(q: Data):
    km = G.haversine_km(c("lat"), c("lon"), F.lit(CENTRE[0]), F.lit(CENTRE[1]))
    return _latlon(q).where("lat IS NOT NULL").select("id", F.floor(km * 1000).alias("metres"))


@query("geo_haversine_m", f"SELECT id, CAST(floor({HERE} * 1000) AS BIGINT) AS metres FROM master ")
def _m(q: Data):
    return q.master.select("id", F.floor(G.haversine_m(c("latitude"), c("longitude"), F.lit(CENTRE[0]), F.lit(CENTRE[1]))).alias("metres"))


@query("geo_filter", f"SELECT id, CASE WHEN area IN ('NATION_1','NATION_2') THEN false WHEN area IN ('NATION_3') THEN true WHEN {HERE} <= 5 THEN true ELSE false END AS passes, CASE WHEN area IN ('NATION_1','NATION_2') THEN 'excluded_area' WHEN area IN ('NATION_3') THEN 'included_area' WHEN {HERE} <= 5 THEN 'distance_ok' WHEN latitude = '' THEN 'no_coordinates' ELSE 'too_far' END AS rule FROM master ")
def _filter(q: Data):
    passes, rule = G.geo_filter(c("area"), c("lat"), c("lon"), ["NATION_3"], ["NATION_1", "NATION_2"], CENTRE)
    return _latlon(q).select("id", passes.alias("passes"), rule.alias("rule"))


@query("geo_coord_fallback", f"SELECT m.id, coalesce({LAT}, ref / 100.0 + 9, avg_lat, 9.65) IS NOT NULL AS has, CASE WHEN latitude <> '' THEN 'own' WHEN ref IS NOT NULL THEN 'second' WHEN avg_lat IS NOT NULL THEN 'area' ELSE 'default' END AS source FROM master m LEFT JOIN (SELECT id, CAST(ref AS INT) AS ref FROM second ) s ON m.id = s.id LEFT JOIN (SELECT area AS a, avg({LAT}) AS avg_lat FROM master GROUP BY area) x ON x.a = m.area")
def _fallback(q: Data):
    from curio.operators.places import coordinate_source

    second = q.second.select("id", (c("ref").cast("int") / 100.0 + 9).alias("other"))
    return coordinate_source(_latlon(q), second).select("id", c("lat").isNotNull().alias("has"), "source")


@query("geo_positional_pair", "SELECT a.id, b.seq FROM (SELECT id, area, row_number() OVER (PARTITION BY area ORDER BY id) AS k FROM master ) a JOIN (SELECT id AS seq, area, row_number() OVER (PARTITION BY area ORDER BY id) AS k FROM second ) b ON a.area = b.area AND a.k = b.k")
def _pair(q: Data):
    from curio.operators.places import pair_by_position

    return pair_by_position(q.master.select("id", "area"), q.second.select(c("id").alias("seq"), "area"), "area", "id", "seq").select("id", "seq")


@query("geo_area_backfill", f"SELECT id, round(coalesce({LAT}, avg({LAT}) OVER (PARTITION BY area), 9.65), 6) AS lat FROM master ")
def _backfill(q: Data):
    from curio.operators.places import backfill

    return backfill(_latlon(q), CENTRE).select("id", F.round("lat", 6).alias("lat"))


STEP_LAT, STEP_LON = 0.5 / 111.32, 0.5 / (111.32 * math.cos(math.radians(CENTRE[0])))
GRID = f"""WITH p AS (SELECT r.range AS r, k.range AS k, {CENTRE[0]} + r.range * {STEP_LAT!r}::DOUBLE AS lat, {CENTRE[1]} + (k.range + CASE WHEN abs(r.range) % 2 = 1 THEN 0.5 ELSE 0.0 END) * {STEP_LON!r}::DOUBLE AS lon FROM range(-13, 14) r, range(-13, 14) k)
SELECT CAST(r AS INT) AS row, CAST(k AS INT) AS col, round(lat, 6) AS lat, round(lon, 6) AS lon, {km_sql('lat', 'lon', '9.65', '-82.75')} <= 1.0 AS dense FROM p WHERE {km_sql('lat', 'lon', '9.65', '-82.75')} <= 6.0 AND lat BETWEEN 9.6 AND 9.7 AND lon BETWEEN -82.85 AND -82.6"""


@query("geo_grid", GRID)
def _grid(q: Data):
    return G.grid(q.spark, 0.5, CENTRE, 6.0, [(9.6, -82.85, 9.7, -82.6)], [(9.65, -82.75, 1.0)])


@query("geo_dense_zone", f"SELECT id, coalesce({HERE} <= 3 OR {km_sql(LAT, LON, '9.7', '-82.7')} <= 2, false) AS dense FROM master ")
def _dense(q: Data):
    return _latlon(q).select("id", F.coalesce(G.in_zones(c("lat"), c("lon"), [(9.65, -82.75, 3.0), (9.7, -82.7, 2.0)]), F.lit(False)).alias("dense"))


# The view's coordinates are decimals of six places; an engine that adds them as binary fractions would move points off a box's border.
EXACT = "TRY_CAST({} AS DECIMAL(9, 6))"
LAT6, LON6 = EXACT.format("latitude"), EXACT.format("longitude")


@query("flt_bbox", f"SELECT id FROM master WHERE ({LAT6} BETWEEN 9.6 AND 9.7 AND {LON6} BETWEEN -82.8 AND -82.6) OR ({LAT6} BETWEEN 9.8 AND 9.85 AND {LON6} BETWEEN -82.5 AND -82.4)")
def _bbox(q: Data):
    return _latlon(q).where(G.in_boxes(c("lat"), c("lon"), [(9.6, -82.8, 9.7, -82.6), (9.8, -82.5, 9.85, -82.4)])).select("id")


@query("geo_priority", f"SELECT id, rank FROM (SELECT id, row_number() OVER (ORDER BY CASE WHEN coalesce({HERE} <= 3, false) THEN 0 ELSE 1 END, {LAT}, id) AS rank FROM master WHERE latitude <> '')")
def _priority(q: Data):
    dense = F.coalesce(G.in_zones(c("lat"), c("lon"), [(9.65, -82.75, 3.0)]), F.lit(False))
    return placed(_latlon(q).where("lat IS NOT NULL"), [(F.when(dense, 0).otherwise(1), False), (c("lat"), False), (c("id"), False)], "rank", ["id"]).select("id", "rank")


@query("geo_valid", f"SELECT id, coalesce({LAT} BETWEEN -90 AND 90 AND {LON} BETWEEN -180 AND 180, false) AS ok FROM master ")
def _valid(q: Data):
    return q.master.select("id", G.valid(c("latitude"), c("longitude")).alias("ok"))


@query("geo_from_url", "SELECT id, CAST(9.5 + (id % 100) / 200.0 AS DOUBLE) AS lat, CAST(-82.5 AS DOUBLE) AS lon, CAST(id * 16 + 10 AS STRING) AS cid FROM master ")
def _from_url(q: Data):
    url = F.concat(F.lit("https://maps.example.com/place/x/@1.5,2.5,17z/data=!4m2!1s0x8fa:0x"), F.lower(F.hex("id")), F.lit("a!3d"), (F.lit(9.5) + F.pmod(c("id"), F.lit(100)) / 200.0).cast("string"), F.lit("!4d-82.5"))
    u = G.from_url(url)
    return q.master.select("id", u["lat"].alias("lat"), u["lon"].alias("lon"), u["cid"].alias("cid"))
