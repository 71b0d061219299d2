"""Registered queries, their SQL counterparts, and the tables and derived views that they read."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}
_MODULES = ("basics", "places", "joins", "summaries", "texts", "records", "pages", "rules", "ledgers")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark", "labels", "conversations")



def choose(number: str, values: list[str]) -> str:
    """SQL for the value whose place is the number modulo their count."""
    return f"CASE ({number}) % {len(values)} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


KINDS = [
    "Hotel", "Hostel", "Villas", "Bed & Breakfast", "Eco Lodge", "Cabinas", "Café", "Panadería", "Heladería", "Bar", "Supermercado", "Tienda de comestibles", "Escuela de surf", "Buceo",
    "Snorkel", "Kayak", "Pesca", "Rescate animal", "Yoga", "Masajes", "Spa", "Gimnasio", "Tienda de ropa", "Farmacia", "Bienes Raíces", "Lavandería", "Clínica veterinaria", "Mascotas",
    "Clínica", "Taller doctor", "Dentista", "Salón", "Banco", "Música en vivo", "Shuttle", "Taxi", "Rent a car", "Soda", "tienda", "Albergue", "Posada", "B & B", "Odontología", "Barbería",
]
SORTS = ["restaurant", "hotel", "hostel", "vacation_rental", "tour_company", "Shopping", "services", "wellness", "real estate", "", "nightlife"]

# Stand-ins for directory data, derived from the keys of the given tables; valid in both dialects.
VIEWS = {
    "master": """
SELECT c_custkey AS id,
  CASE c_custkey % 6 WHEN 0 THEN 'Casa' WHEN 1 THEN 'Café' WHEN 2 THEN 'Hotel' WHEN 3 THEN 'Tienda' WHEN 4 THEN 'Bar & Grill' ELSE 'Clínica' END
  || ' ' || CASE c_custkey % 7 WHEN 0 THEN 'Azul' WHEN 1 THEN 'Verde' WHEN 2 THEN 'Luna' WHEN 3 THEN 'del Sol' WHEN 4 THEN 'Mariposa' WHEN 5 THEN 'Palmeras' ELSE 'Pacifica' END
  || CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN ' - ' || n_name || ', Limón, Costa Rica' WHEN 2 THEN ', ' || n_name WHEN 3 THEN ' ' || CAST(c_custkey % 37 AS STRING) ELSE ' ' || CAST(c_custkey % 11 AS STRING) END AS business_name,
  n_name AS area, lower(c_mktsegment) AS category, r_name AS region,
  CASE WHEN c_custkey % 13 = 0 THEN '' WHEN c_custkey % 101 = 0 THEN '123.5' ELSE CAST(9.5 + (c_custkey % 1000) / 2000.0 AS STRING) END AS latitude,
  CASE WHEN c_custkey % 13 = 0 THEN '' ELSE CAST(-82.9 + (c_custkey % 700) / 1000.0 AS STRING) END AS longitude,
  CASE c_custkey % 8 WHEN 0 THEN '' WHEN 1 THEN '8' || lpad(CAST(c_custkey % 10000000 AS STRING), 7, '0') WHEN 2 THEN '+506 2750-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')
    WHEN 3 THEN 'Tel: 0050627' || lpad(CAST(c_custkey % 1000000 AS STRING), 6, '0') WHEN 4 THEN '123' WHEN 5 THEN '1 (555) 010-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')
    WHEN 6 THEN '2750' || lpad(CAST(c_custkey % 40 AS STRING), 4, '0') ELSE '50688' || lpad(CAST(c_custkey % 1000000 AS STRING), 6, '0') END AS phone,
  CASE c_custkey % 6 WHEN 0 THEN 'https://wa.me/5068' || lpad(CAST(c_custkey % 10000000 AS STRING), 7, '0') WHEN 1 THEN '8' || lpad(CAST(c_custkey % 90 AS STRING), 7, '0') WHEN 2 THEN 'phone=49170' || lpad(CAST(c_custkey % 10000000 AS STRING), 7, '0') WHEN 3 THEN '77' ELSE '' END AS whatsapp,
  CASE c_custkey % 5 WHEN 0 THEN '@casa_' || CAST(c_custkey % 400 AS STRING) WHEN 1 THEN 'bad handle!' WHEN 2 THEN 'luna.' || CAST(c_custkey AS STRING) ELSE '' END AS instagram_handle,
  CASE c_custkey % 5 WHEN 0 THEN 'https://www.instagram.com/casa_' || CAST(c_custkey % 400 AS STRING) || '/' ELSE '' END AS instagram_url,
  CASE c_custkey % 7 WHEN 0 THEN 'https://www.example' || CAST(c_custkey % 50 AS STRING) || '.com/a/' WHEN 1 THEN 'http://plain.example.com' WHEN 2 THEN 'https:///nohost' WHEN 3 THEN 'example.org/Path' WHEN 4 THEN 'https://facebook.com/x' || CAST(c_custkey AS STRING) ELSE '' END AS website,
  CASE WHEN c_custkey % 9 = 0 THEN 'https://facebook.com/p' || CAST(c_custkey AS STRING) ELSE '' END AS facebook_url,
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE CAST(1000003 * (c_custkey % 1200) + 77 AS STRING) END AS google_maps_cid,
  CASE WHEN c_custkey % 10 = 0 THEN 'https://www.booking.com/h' || CAST(c_custkey AS STRING) ELSE '' END AS booking_url,
  CASE WHEN c_custkey % 14 = 0 THEN 'https://www.tripadvisor.com/t' || CAST(c_custkey AS STRING) ELSE '' END AS tripadvisor_url,
  CASE WHEN c_custkey % 4 = 0 THEN 'a' || CAST(c_custkey AS STRING) || '@example.com' ELSE '' END AS email,
  CASE WHEN c_custkey % 3 = 1 THEN 'A ' || lower(c_mktsegment) || ' place with a long story about the beach, the people and what there is to do in the area all year round.' WHEN c_custkey % 3 = 2 THEN 'Short text.' ELSE '' END AS description_full,
  CASE c_custkey % 11 WHEN 0 THEN 'closed' WHEN 1 THEN 'Permanently_Closed' WHEN 2 THEN '' ELSE 'active' END AS operating_status,
  CASE WHEN c_custkey % 4 = 1 THEN '' ELSE '2026-0' || CAST(1 + c_custkey % 9 AS STRING) || '-15' END AS verified_date,
  CASE c_custkey % 3 WHEN 0 THEN 'verified' WHEN 1 THEN 'guess' ELSE '' END AS instagram_confidence
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
""",
    "places": f"""
SELECT c_custkey AS id, {choose("c_custkey * 7 + CAST(floor(c_custkey / 44) AS BIGINT)", KINDS)} || CASE c_custkey % 6 WHEN 0 THEN '' WHEN 1 THEN ' Luna' WHEN 2 THEN '  Azul, Limón' WHEN 3 THEN ' del camino de las palmeras de la playa grande y del mar azul' ELSE ' Sol' END AS business_name,
  {choose("c_custkey", SORTS)} AS category, CASE WHEN c_custkey % 13 = 0 THEN '' ELSE n_name END AS area,
  CASE c_custkey % 5 WHEN 0 THEN 'We have a ' || lower({choose("c_custkey * 5 + 3", KINDS)}) || ' and a garden, open daily.' WHEN 1 THEN 'Closed sundays' WHEN 2 THEN 'Gives travelers a place near ' || {choose("c_custkey * 3 + 1", KINDS)} WHEN 3 THEN 'Open from Monday, except tuesday, for repair and more.' ELSE '' END AS description_full,
  CASE c_custkey % 4 WHEN 1 THEN {choose("c_custkey * 11 + 1", KINDS)} WHEN 2 THEN 'Cocktail bar' ELSE '' END AS subcategory,
  CASE WHEN c_custkey % 5 = 2 THEN 'Cafetería' ELSE '' END AS cuisine, CASE WHEN c_custkey % 6 = 3 THEN 'Spa; Gimnasio, Free wifi' WHEN c_custkey % 6 = 4 THEN 'Ocean view, Pool,Luna.com,Limón' ELSE '' END AS amenities,
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE CAST(1000003 * (c_custkey % 1200) + 77 AS STRING) END AS google_maps_cid, CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN '8' || lpad(CAST(c_custkey % 10000000 AS STRING), 7, '0') ELSE '123' END AS phone,
  CASE c_custkey % 7 WHEN 0 THEN '8' || lpad(CAST(c_custkey % 90 AS STRING), 7, '0') ELSE '' END AS whatsapp, CASE c_custkey % 3 WHEN 0 THEN 'http://plain.example.com' WHEN 1 THEN 'https://x.example.com' ELSE '' END AS website,
  CASE c_custkey % 8 WHEN 0 THEN '95.5' WHEN 1 THEN '' ELSE '9.6' END AS latitude, CASE c_custkey % 8 WHEN 2 THEN '' ELSE '-82.7' END AS longitude, CASE c_custkey % 11 WHEN 0 THEN 'closed' ELSE 'active' END AS operating_status
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey
""",
    "second": """
SELECT s_suppkey AS id,
  CASE s_suppkey % 6 WHEN 0 THEN 'Casa' WHEN 1 THEN 'Café' WHEN 2 THEN 'Hotel' WHEN 3 THEN 'Tienda' WHEN 4 THEN 'Bar' ELSE 'Clínica' END
  || ' ' || CASE s_suppkey % 7 WHEN 0 THEN 'Azul' WHEN 1 THEN 'Verde' WHEN 2 THEN 'Luna' WHEN 3 THEN 'Sol' WHEN 4 THEN 'Mariposa' WHEN 5 THEN 'Palmeras' ELSE 'Pacifica' END || ' ' || CAST(s_suppkey % 37 AS STRING) AS name,
  n_name AS area, CAST(s_suppkey % 97 AS STRING) AS ref
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
""",
    "ledger": """
SELECT user_id AS rid, event_id AS seq, CAST(ts AS STRING) AS captured_at, substr(CAST(ts AS STRING), 1, 7) AS month, event_type AS state, 'v' || CAST(event_id % 3 AS STRING) AS version, value
FROM {events}
""",
    "hours": """
SELECT c_custkey AS id,
  CASE c_custkey % 7 WHEN 0 THEN 'Monday' WHEN 1 THEN 'Tuesday' WHEN 2 THEN 'Wednesday' WHEN 3 THEN 'Thursday' WHEN 4 THEN 'Friday' WHEN 5 THEN 'Saturday' ELSE 'Sunday (Feast)' END || ' ' ||
  CASE c_custkey % 10 WHEN 0 THEN 'Closed' WHEN 1 THEN 'Open 24 hours' WHEN 2 THEN '9 AM to 5 PM' WHEN 3 THEN '12 to 10 PM' WHEN 4 THEN '4 PM to 2:30 AM' WHEN 5 THEN '8 AM to 12 PM, 1:30 PM to 6 PM'
    WHEN 6 THEN '10 AM–10:30 PM, Hours might differ' WHEN 7 THEN '7 to 11 AM 7 to 11 AM Copy open hours' WHEN 8 THEN 'by appointment' ELSE '13 AM to 5 PM' END AS row_text
FROM {customer}
""",
    "invoices": """
SELECT o_orderkey AS invoice_no, o_custkey AS customer, CAST(floor(o_totalprice) AS BIGINT) AS amount_usd, o_orderstatus AS status, CAST(o_orderdate AS DATE) AS issued,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'transfer' WHEN '2-HIGH' THEN 'card' ELSE 'cash' END AS method
FROM {orders}
""",
}


class Data:
    """Tables and views by name; queries may end with q.table names of a query's SQL."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            used = {t: getattr(self, t) for t in TABLES if "{" + t + "}" in VIEWS[name]}
            return self.spark.sql(VIEWS[name], **used)
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        raise AttributeError(name)


def _with_views(sql: str) -> str:
    """The views that a text names, as common table expressions before it."""
    used = [v for v in VIEWS if f"{v} " in f"{sql} ".replace("\n", " ").replace(")", " ").replace(",", " ")]
    ctes = [f"{v} AS ({VIEWS[v].format(**{t: t for t in TABLES})})" for v in used]
    if not ctes:
        return sql
    body = sql.strip()
    return "WITH " + ", ".join(ctes) + (", " + body[5:] if body.upper().startswith("WITH ") else " " + body)


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a function of Data, with the SQL that gives the same rows."""

    def add(f: Callable[[Data], DataFrame]) -> Callable[[Data], DataFrame]:
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = lambda spark, sf_dir: f(Data(spark, sf_dir))
        if sql:
            _ORACLES[name] = _with_views(sql)
        return f

    return add


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(f"curio.plans.{m}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["er_pair_class"](spark, sf_dir)
