"""Geographic column functions and the search grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RADIUS_KM = 6371.0


def to_double(c: Column) -> Column:
    return F.expr("try_cast(NULL AS double)") if c is None else c.try_cast("double")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = RADIUS_KM) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2))
    return F.lit(radius) * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres; null for coordinates that are no numbers."""
    return haversine_km(*[to_double(c) for c in (lat1, lon1, lat2, lon2)], radius=RADIUS_KM * 1000)


def valid(lat: Column, lon: Column) -> Column:
    a, b = to_double(lat), to_double(lon)
    return F.coalesce(a.between(-90, 90) & b.between(-180, 180) & ~F.isnan(a) & ~F.isnan(b), F.lit(False))


def in_boxes(lat: Column, lon: Column, boxes: list[tuple[float, float, float, float]]) -> Column:
    """boxes: (least latitude, least longitude, most latitude, most longitude)."""
    out = F.lit(False)
    for s, w, n, e in boxes:
        out = out | (lat.between(s, n) & lon.between(w, e))
    return out


def in_zones(lat: Column, lon: Column, zones: list[tuple[float, float, float]]) -> Column:
    """zones: (latitude, longitude, kilometres)."""
    out = F.lit(False)
    for a, b, r in zones:
        out = out | (haversine_km(lat, lon, F.lit(a), F.lit(b)) <= r)
    return out


def geo_filter(area: Column, lat: Column, lon: Column, included: list[str], excluded: list[str], centre: tuple[float, float], most_km: float = 5.0) -> tuple[Column, Column]:
    """(passes, rule): excluded area, included area, within most_km, else not."""
    km = haversine_km(lat, lon, F.lit(centre[0]), F.lit(centre[1]))
    near = km <= most_km
    passes = F.when(area.isin(excluded), False).when(area.isin(included), True).when(near, True).otherwise(False)
    rule = F.when(area.isin(excluded), "excluded_area").when(area.isin(included), "included_area").when(near, "distance_ok").when(km.isNull(), "no_coordinates").otherwise("too_far")
    return passes, rule


def from_url(url: Column) -> Column:
    """struct(lat, lon, cid): the pin of a map link, else its view; the hex feature id as a decimal number."""
    pin_lat, pin_lon = F.regexp_extract(url, r"!3d(-?[0-9.]+)!4d(-?[0-9.]+)", 1), F.regexp_extract(url, r"!3d(-?[0-9.]+)!4d(-?[0-9.]+)", 2)
    at_lat, at_lon = F.regexp_extract(url, r"@(-?[0-9.]+),(-?[0-9.]+)", 1), F.regexp_extract(url, r"@(-?[0-9.]+),(-?[0-9.]+)", 2)
    feature = F.regexp_extract(url, r"0x[0-9a-fA-F]+:0x([0-9a-fA-F]+)", 1)
    return F.struct(
        F.when(pin_lat != "", pin_lat).otherwise(at_lat).try_cast("double").alias("lat"),
        F.when(pin_lon != "", pin_lon).otherwise(at_lon).try_cast("double").alias("lon"),
        F.when(feature != "", F.conv(feature, 16, 10)).alias("cid"),
    )


def grid(spark: SparkSession, step_km: float, centre: tuple[float, float], radius_km: float, land: list[tuple[float, float, float, float]], dense: list[tuple[float, float, float]]) -> DataFrame:
    """Staggered grid within a radius and on land: row, col, lat, lon, dense, rounded to 6 places."""
    import math

    dlat = step_km / 111.32
    dlon = step_km / (111.32 * math.cos(math.radians(centre[0])))
    n = int(radius_km / step_km) + 1
    rows = spark.range(-n, n + 1).select(F.col("id").cast("int").alias("row"))
    cells = rows.select("row", F.explode(F.sequence(F.lit(-n), F.lit(n))).alias("col"))
    lat = F.lit(centre[0]) + F.col("row") * F.lit(dlat)
    lon = F.lit(centre[1]) + (F.col("col") + F.when(F.pmod("row", F.lit(2)) == 1, 0.5).otherwise(0.0)) * F.lit(dlon)
    pts = cells.select("row", "col", lat.alias("lat"), lon.alias("lon"))
    pts = pts.where((haversine_km(F.col("lat"), F.col("lon"), F.lit(centre[0]), F.lit(centre[1])) <= radius_km) & in_boxes(F.col("lat"), F.col("lon"), land))
    return pts.select("row", "col", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), in_zones(F.col("lat"), F.col("lon"), dense).alias("dense"))
