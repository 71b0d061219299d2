"""Opening hours, dates, arrays, maps and nested records."""

from __future__ import annotations

from pyspark.sql import functions as F

from curio.functions import arrays as R
from curio.functions import hours as H
from curio.operators import schedules as Z
from curio.operators.relations import pinned, spread
from curio.plans.registry import Data, query

c = F.col

# What the ten row texts of the hours view parse to: closed, open24, periods "opens-closes[+]".
DAY = "CASE id % 7 WHEN 0 THEN 'monday' WHEN 1 THEN 'tuesday' WHEN 2 THEN 'wednesday' WHEN 3 THEN 'thursday' WHEN 4 THEN 'friday' WHEN 5 THEN 'saturday' ELSE 'sunday' END"
PERIODS = "CASE id % 10 WHEN 0 THEN '' WHEN 1 THEN '00:00-24:00' WHEN 2 THEN '09:00-17:00' WHEN 3 THEN '12:00-22:00' WHEN 4 THEN '16:00-02:30+' WHEN 5 THEN '08:00-12:00,13:30-18:00' WHEN 6 THEN '10:00-22:30' WHEN 7 THEN '07:00-11:00' WHEN 8 THEN '' ELSE '' END"


def _shown(periods):
    return F.array_join(F.transform(periods, lambda p: F.concat(p["opens"], F.lit("-"), p["closes"], F.when(p["closes_next_day"], "+").otherwise(""))), ",")


def _days(q: Data):
    """Row texts, parsed once, not in each place that looks at the day."""
    return pinned(spread(q.hours), day=H.day_row(c("row_text")))


@query("dt_day_row", f"SELECT id, {DAY} AS day, id % 10 = 0 AS closed, id % 10 = 1 AS open24, {PERIODS} AS periods FROM hours ")
def _day_row(q: Data):
    return _days(q).select("id", c("day.day").alias("day"), c("day.closed").alias("closed"), c("day.open24").alias("open24"), _shown(c("day.periods")).alias("periods"))


query("ex_aria_hours", f"SELECT id, {DAY} AS day, {PERIODS} AS periods FROM hours ")(lambda q: _days(q).select("id", c("day.day").alias("day"), _shown(c("day.periods")).alias("periods")))


@query("dt_parse_time", "SELECT id, CASE WHEN id % 14 = 0 THEN NULL WHEN id % 14 > 12 THEN NULL ELSE lpad(CAST(CASE WHEN id % 3 = 0 THEN CASE WHEN id % 14 = 12 THEN 0 ELSE id % 14 END ELSE CASE WHEN id % 14 = 12 THEN 12 ELSE id % 14 + 12 END END AS STRING), 2, '0') || CASE WHEN id % 2 = 0 THEN ':30' ELSE ':00' END END AS v FROM hours ")
def _time(q: Data):
    t = F.concat((c("id") % 14).cast("string"), F.when(c("id") % 2 == 0, ":30").otherwise(""), F.when(c("id") % 3 == 0, " AM").when(c("id") % 3 == 1, " pm").otherwise(""))
    return q.hours.select("id", H.parse_time(t, F.lit(None).cast("string")).alias("v"))


@query("dt_interval", "SELECT id, CASE WHEN id % 5 = 4 THEN NULL ELSE lpad(CAST(CASE WHEN id % 5 = 3 THEN 10 ELSE 9 END AS STRING), 2, '0') || ':00-' || CASE id % 5 WHEN 0 THEN '17:00' WHEN 1 THEN '02:30+' WHEN 2 THEN '21:15' ELSE '12:00' END END AS v FROM hours ")
def _interval(q: Data):
    t = F.when(c("id") % 5 == 0, "9 AM to 5 PM").when(c("id") % 5 == 1, "9 AM – 2:30 AM").when(c("id") % 5 == 2, "9 AM-9:15 PM").when(c("id") % 5 == 3, "10  AM  to 12 pm").otherwise("soon")
    p = H.parse_interval(t)
    return q.hours.select("id", F.concat(p["opens"], F.lit("-"), p["closes"], F.when(p["closes_next_day"], "+").otherwise("")).alias("v"))


query("dt_weekday_label", f"SELECT id, {DAY} AS v FROM hours ")(lambda q: q.hours.select("id", H.weekday(c("row_text")).alias("v")))
query("dt_holiday", "SELECT id, CASE WHEN id % 7 = 6 THEN 'Feast' END AS v FROM hours ")(lambda q: q.hours.select("id", H.holiday(H.display_day(c("row_text"))).alias("v")))
query("dt_display_day", f"SELECT id, CASE WHEN id % 7 = 6 THEN 'Sunday (Feast)' ELSE upper(({DAY})[1]) || substr({DAY}, 2) END AS v FROM hours ")(lambda q: q.hours.select("id", H.display_day(c("row_text")).alias("v")))


@query("dt_week", f"WITH d AS (SELECT DISTINCT id // 7 AS biz, {DAY} AS day FROM hours ) SELECT biz, count(*) AS days, CASE WHEN count(*) = 7 THEN 'complete' ELSE 'partial' END AS completeness FROM d GROUP BY biz")
def _week(q: Data):
    w = Z.weekly(q.hours.withColumn("biz", F.floor(c("id") / 7)), "biz", "row_text")
    return w.select("biz", F.size("week").cast("bigint").alias("days"), "completeness")


query("dq_partial", f"WITH d AS (SELECT DISTINCT id // 7 AS biz, {DAY} AS day FROM hours ) SELECT biz, 7 - count(*) AS missing FROM d GROUP BY biz HAVING count(*) < 7")(
    lambda q: Z.weekly(q.hours.withColumn("biz", F.floor(c("id") / 7)), "biz", "row_text").where("size(missing) > 0").select("biz", F.size("missing").cast("bigint").alias("missing"))
)


@query("dt_fmt_period", "SELECT id, lpad(CAST(id % 24 AS STRING), 2, '0') AS h, CASE WHEN id % 24 % 12 = 0 THEN '12' ELSE CAST(id % 24 % 12 AS STRING) END || ':05 ' || CASE WHEN id % 24 < 12 THEN 'AM' ELSE 'PM' END AS v FROM hours ")
def _period(q: Data):
    h = F.lpad((c("id") % 24).cast("string"), 2, "0")
    return q.hours.select("id", h.alias("h"), H.clock(F.concat(h, F.lit(":05"))).alias("v"))


@query("dt_fmt_month", "SELECT month, strftime(CAST(month || '-01' AS DATE), '%B %Y') AS v FROM (SELECT DISTINCT month FROM ledger )")
def _month(q: Data):
    return q.ledger.select("month").distinct().select("month", F.date_format(F.concat("month", F.lit("-01")).cast("date"), "MMMM yyyy").alias("v"))


@query("dt_now_tz", "SELECT event_id, isodow(ts - INTERVAL 6 HOUR) - 1 AS day, hour(ts - INTERVAL 6 HOUR) * 60 + minute(ts - INTERVAL 6 HOUR) AS minute FROM events")
def _now(q: Data):
    t = F.from_utc_timestamp(c("ts").cast("timestamp"), "America/Costa_Rica")
    return q.events.select("event_id", F.weekday(t).cast("bigint").alias("day"), (F.hour(t) * 60 + F.minute(t)).cast("bigint").alias("minute"))


OPENS = "CASE id % 10 WHEN 1 THEN true WHEN 2 THEN m >= 540 AND m < 1020 WHEN 3 THEN m >= 720 AND m < 1320 WHEN 4 THEN m >= 960 WHEN 5 THEN (m >= 480 AND m < 720) OR (m >= 810 AND m < 1080) WHEN 6 THEN m >= 600 AND m < 1350 WHEN 7 THEN m >= 420 AND m < 660 ELSE false END"


def _at(q: Data, form=lambda day: day):
    """A day's row, that of the id before it as yesterday, and a minute."""
    rows = pinned(_days(q), form=form(c("day"))).select("id", c("form").alias("day"))
    today = rows.select("id", c("day").alias("today"), ((c("id") * 37) % 1440).cast("int").alias("m"))
    before = rows.select((c("id") + 1).alias("id"), c("day").alias("yesterday"))
    return today.join(before, "id", "left")


OPEN_SQL = f"WITH x AS (SELECT id, (id * 37) % 1440 AS m, (SELECT min(id) FROM hours ) AS lo FROM hours ) SELECT id, {OPENS} OR (id > lo AND ((id + 9) % 10 = 1 OR ((id + 9) % 10 = 4 AND m < 150))) AS open FROM x"
query("dt_open_at", OPEN_SQL)(lambda q: _at(q).select("id", H.open_at(c("today"), c("yesterday"), c("m")).alias("open")))
TICKS = (0, 149, 150, 539, 540, 719, 720, 1319, 1349)  # minutes at which a clock looks again


@query("st_open_now", "WITH x AS (SELECT id, m, (SELECT min(id) FROM hours ) AS lo FROM hours CROSS JOIN (VALUES " + ", ".join(f"({t})" for t in TICKS) + f") t(m)), o AS (SELECT m, {OPENS} OR (id > lo AND ((id + 9) % 10 = 1 OR ((id + 9) % 10 = 4 AND m < 150))) AS open FROM x) SELECT m AS minute, count(*) FILTER (WHERE open) AS open, count(*) AS places FROM o GROUP BY m")
def _now_open(q: Data):
    """How many are open at each tick of a clock."""
    seen = _at(q, H.in_minutes).drop("m").withColumn("m", F.explode(F.lit(list(TICKS))))
    return seen.groupBy(c("m").alias("minute")).agg(F.count_if(H.open_in(c("today"), c("yesterday"), c("m"))).alias("open"), F.count("*").alias("places"))


def _spoken(m: int) -> str:
    return f"{(m // 60 - 1) % 12 + 1}:{m % 60:02d} {'AM' if m % 1440 < 720 else 'PM'}"


def _states() -> str:
    """The arms of dt_status for each row text of the hours view: periods in minutes, and whether one ends on the next day."""
    kinds = {2: [(540, 1020)], 3: [(720, 1320)], 4: [(960, 150)], 5: [(480, 720), (810, 1080)], 6: [(600, 1350)], 7: [(420, 660)]}
    arms = []
    for k, periods in kinds.items():
        for a, b in periods:
            inside = f"m >= {a}" if b < a else f"m >= {a} AND m < {b}"
            arms.append(f"WHEN id % 10 = {k} AND {inside} THEN 'Open · Closes {'tomorrow ' if b < a else ''}at {_spoken(b)}'")
        arms += [f"WHEN id % 10 = {k} AND m < {a} THEN 'Closed · Opens at {_spoken(a)}'" for a, _ in periods]
    return " ".join(arms)


@query("dt_status", f"WITH x AS (SELECT id, (id * 37) % 1440 AS m, (SELECT min(id) FROM hours ) AS lo FROM hours ) SELECT id, CASE WHEN id % 10 = 0 THEN 'Closed today' WHEN id % 10 = 1 THEN 'Open 24 hours' WHEN id > lo AND id % 10 = 5 AND m < 150 THEN 'Open · Closes today at 2:30 AM' {_states()} ELSE 'Closed' END AS v FROM x")
def _status(q: Data):
    return _at(q).select("id", H.status(c("today"), c("yesterday"), c("m")).alias("v"))


@query("dt_stale", "SELECT user_id AS rid, date_diff('day', CAST(max(ts) AS DATE), DATE '2026-01-01') > 21 AS stale FROM events GROUP BY user_id")
def _stale(q: Data):
    return q.events.groupBy(c("user_id").alias("rid")).agg((F.datediff(F.lit("2026-01-01").cast("date"), F.max("ts").cast("date")) > 21).alias("stale"))


@query("dt_valid_until", "SELECT invoice_no, CAST(issued + INTERVAL 1 YEAR AS DATE) AS v FROM invoices ")
def _until(q: Data):
    return q.invoices.select("invoice_no", F.add_months("issued", 12).alias("v"))


@query("dq_schedule", "SELECT id, rule FROM (SELECT id, unnest(list_filter([CASE WHEN id % 5 = 0 THEN 'closed_with_periods' END, CASE WHEN id % 15 = 0 THEN 'closed_and_open24' END, CASE WHEN id % 7 = 0 THEN 'bad_time' END, CASE WHEN id % 7 <> 0 AND id % 4 = 1 THEN 'overnight_without_flag' END, CASE WHEN id % 7 <> 0 AND id % 4 = 2 THEN 'flag_without_overnight' END], lambda x: x IS NOT NULL)) AS rule FROM hours )")
def _violations(q: Data):
    p = q.hours.select(
        "id", F.lit("monday").alias("day"), (c("id") % 5 == 0).alias("closed"), (c("id") % 3 == 0).alias("open24"), F.when(c("id") % 7 == 0, "xx").otherwise("09:00").alias("opens"),
        F.when(c("id") % 4 == 1, "02:00").otherwise("18:00").alias("closes"), (c("id") % 4 == 2).alias("next_day"),
    )
    return Z.violations(p).select("id", "rule")


query("dq_schedule_ts", "SELECT id FROM hours WHERE id % 4 = 1")(
    lambda q: Z.violations(q.hours.select("id", F.lit("monday").alias("day"), F.lit(False).alias("closed"), F.lit(False).alias("open24"), F.lit("09:00").alias("opens"), F.when(c("id") % 4 == 1, "02:00").otherwise("18:00").alias("closes"), F.lit(False).alias("next_day"))).select("id").distinct()
)

LIST = "string_split(CASE id % 3 WHEN 0 THEN 'Wifi; Pool,Pool' WHEN 1 THEN ' parking ,Photos' ELSE 'Pool, wifi,Garden view,Pool' END, '~')"


def _lists(q: Data):
    t = F.when(c("id") % 3 == 0, "Wifi; Pool,Pool").when(c("id") % 3 == 1, " parking ,Photos").otherwise("Pool, wifi,Garden view,Pool")
    return q.master.select("id", t.alias("t"))


def _arr(name: str, column, zero: str, one: str, two: str) -> None:
    @query(name, f"SELECT id, CASE id % 3 WHEN 0 THEN '{zero}' WHEN 1 THEN '{one}' ELSE '{two}' END AS v FROM master ")
    def _(q: Data):
        from curio.functions.text import split_list

        return _lists(q).withColumn("a", split_list(c("t"))).select("id", F.array_join(column(c("a")), "|").alias("v"))


_arr("ar_split_list", lambda a: a, "Wifi|Pool|Pool", "parking|Photos", "Pool|wifi|Garden view|Pool")
_arr("ar_amenities", lambda a: R.ordered_distinct(a, "wifi|pool|parking|garden", "photos"), "Wifi|Pool", "parking", "Pool|wifi|Garden view")
_arr("ar_valid_amenity", lambda a: F.filter(a, lambda v: R.valid_element(v, "wifi|pool|park", "garden")), "Wifi|Pool|Pool", "parking", "Pool|wifi|Pool")
_arr("ar_add_unique", lambda a: R.add_unique(a, F.lit("WIFI/")), "Wifi|Pool|Pool", "parking|Photos|WIFI/", "Pool|wifi|Garden view|Pool")
_arr("ar_attr_clean", lambda a: R.clean_group(a, {"garden view": "pool"}), "Wifi|Pool", "parking|Photos", "Pool|wifi")
_arr("ar_attr_order", lambda a: R.order_by_table(F.array_distinct(F.transform(a, lambda v: F.lower(v))), ["pool", "wifi"]), "pool|wifi", "parking|photos", "pool|wifi|garden view")
_arr("ar_facets", lambda a: R.facets(a, F.array(F.lit("spa")), F.array(F.lit("Pool")), 2), "Wifi|spa", "parking|Photos", "wifi|Garden view")


@query("js_flatten", "SELECT id, CASE WHEN phone <> '' THEN 'phone=' || phone || ';' ELSE '' END || 'area=' || area AS v FROM master ")
def _flatten(q: Data):
    f = F.map_from_arrays(F.array(F.lit("area"), F.lit("phone")), F.array(*[F.struct(c(k).alias("value"), F.lit(0.9).alias("confidence")) for k in ("area", "phone")]))
    m = R.values_of(f)
    return q.master.select("id", F.concat(F.when(m["phone"] != "", F.concat(F.lit("phone="), m["phone"], F.lit(";"))).otherwise(""), F.lit("area="), m["area"]).alias("v"))


@query("js_tags", "SELECT id, CASE WHEN id % 4 = 0 THEN 'hotel' WHEN id % 4 = 1 THEN 'restaurant' WHEN id % 4 = 2 THEN 'shopping' ELSE 'other' END AS v FROM master ")
def _tags(q: Data):
    t = F.when(c("id") % 4 == 0, F.create_map(F.lit("tourism"), F.lit("hotel"), F.lit("shop"), F.lit("x"))).when(c("id") % 4 == 1, F.create_map(F.lit("amenity"), F.lit("cafe"))).when(c("id") % 4 == 2, F.create_map(F.lit("shop"), F.lit("gift"))).otherwise(F.create_map(F.lit("name"), F.lit("n")))
    return q.master.select("id", R.tag_category(t, [("tourism", "hotel", "hotel"), ("amenity", "cafe", "restaurant"), ("shop", None, "shopping")]).alias("v"))
