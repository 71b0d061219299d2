"""Opening hours: parsing of row texts, schedule algebra. Times are HH:MM text or minutes since midnight, 24:00 being 1440."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curio.functions.arrays import let

WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
CLOCK = r"[0-9]{1,2}(?::[0-9]{2})?"
HALF = r"\s?[ap]m"
BETWEEN = r"(?:\s+to\s+|\s?[-–—]\s?)"
PERIOD = rf"(?i)(?<![0-9:]){CLOCK}(?:{HALF})?{BETWEEN}{CLOCK}{HALF}(?![a-z])"
DAY_LABEL = r"^((?i:Sunday|Monday|Tuesday|Wednesday|Thursday|Friday|Saturday)(?: ?\([^)]*\))?)"


def parse_time(c: Column, hint: Column) -> Column:
    """24-hour HH:MM, or null. A time without meridian takes the hint; without a hint it is PM, and 12 is noon."""

    def of(s: Column, shown: Column) -> Column:
        half = F.when(s.endswith("m"), F.right(s, F.lit(2))).when(F.lower(hint) == "am", "am").otherwise("pm")
        hour = F.split_part(shown, F.lit(":"), F.lit(1)).try_cast("int")
        of_day = F.pmod(hour, F.lit(12)) + F.when(half == "pm", 12).otherwise(0)
        minute = F.when(F.contains(shown, F.lit(":")), F.split_part(shown, F.lit(":"), F.lit(2))).otherwise("00")
        fits = shown.rlike(r"^(?:0?[1-9]|1[0-2])(?::[0-5][0-9])?$")
        return F.when(fits, F.concat(F.lpad(of_day.cast("string"), 2, "0"), F.lit(":"), minute))

    return let(F.lower(F.trim(c)), lambda s: let(F.regexp_replace(s, rf"{HALF}$", ""), lambda shown: of(s, shown)))


def parse_interval(c: Column) -> Column:
    """struct(opens, closes, closes_next_day), or null."""

    def of(ends: Column) -> Column:
        hint = F.regexp_extract(F.lower(F.get(ends, 1)), "[ap]m", 0)
        return let(F.array(*[parse_time(F.get(ends, i), hint) for i in (0, 1)]), lambda t: span(F.get(t, 0), F.get(t, 1)))

    span = lambda o, e: F.when(o.isNotNull() & e.isNotNull(), F.struct(o.alias("opens"), e.alias("closes"), (e < o).alias("closes_next_day")))
    return let(F.split(F.regexp_replace(F.trim(c), r"\s+", " "), rf"(?i){BETWEEN}", 2), of)


def weekday(label: Column) -> Column:
    def of(low: Column) -> Column:
        out = F.lit(None).cast("string")
        for d in WEEKDAYS:
            out = F.when(low.startswith(d), d).otherwise(out)
        return out

    return let(F.lower(F.trim(label)), of)


def holiday(label: Column) -> Column:
    h = F.trim(F.regexp_extract(label, r"\(([^)]+)\)", 1))
    return F.when(h != "", h)


def display_day(label: Column) -> Column:
    return F.trim(F.regexp_extract(F.trim(label), DAY_LABEL, 1))


def day_row(row: Column) -> Column:
    """struct(day, closed, open24, periods, holiday, might_differ) of a row text; day is null where it names none."""
    spans = F.transform(F.regexp_extract_all(row, F.lit(PERIOD), F.lit(0)), parse_interval)
    span = lambda *x: F.struct(*[F.lit(v).alias(n) for v, n in zip(x, ("opens", "closes", "closes_next_day"), strict=True)])
    always = F.array(span("00:00", "24:00", False))

    def of(low: Column, shown: Column) -> Column:
        shut, whole = F.array_contains(F.split(low, r"\s+"), "closed"), F.contains(low, F.lit("open 24 hours"))
        return F.struct(
            weekday(shown).alias("day"), shut.alias("closed"), (whole & ~shut).alias("open24"),
            F.when(shut, F.slice(always, 1, 0)).when(whole, always).otherwise(F.array_distinct(F.array_compact(spans))).alias("periods"),
            holiday(shown).alias("holiday"), F.contains(low, F.lit("hours might differ")).alias("might_differ"),
        )

    return let(F.lower(row), lambda low: let(display_day(F.regexp_replace(F.trim(row), r"\s{2,}", " ")), lambda shown: of(low, shown)))


def minutes(t: Column) -> Column:
    return F.split_part(t, F.lit(":"), F.lit(1)).try_cast("int") * 60 + F.split_part(t, F.lit(":"), F.lit(2)).try_cast("int")


def clock(t: Column) -> Column:
    """'9:30 AM' of '09:30'; 24:00 is 12:00 AM."""
    h = F.pmod(F.split_part(t, F.lit(":"), F.lit(1)).try_cast("int"), F.lit(24))
    shown = F.when(F.pmod(h, F.lit(12)) == 0, 12).otherwise(F.pmod(h, F.lit(12)))
    return F.concat(shown.cast("string"), F.lit(":"), F.split_part(t, F.lit(":"), F.lit(2)), F.when(h < 12, " AM").otherwise(" PM"))


def in_minutes(day: Column) -> Column:
    """struct(periods, open24) of a day as day_row gives it, with numbers for times."""
    spans = F.transform(day["periods"], lambda p: F.struct(minutes(p["opens"]).alias("opens"), minutes(p["closes"]).alias("closes"), p["closes_next_day"].alias("closes_next_day")))
    return F.struct(spans.alias("periods"), day["open24"].alias("open24"))


def open_in(today: Column, yesterday: Column, minute: Column, all_day_spills: bool = True) -> Column:
    """open_at for days as in_minutes gives them, for many minutes of one day."""
    spill = F.coalesce(F.exists(yesterday["periods"], lambda p: p["closes_next_day"] & (minute < p["closes"])), F.lit(False))
    own = F.coalesce(F.exists(today["periods"], lambda p: (minute >= p["opens"]) & (p["closes_next_day"] | (minute < p["closes"]))), F.lit(False))
    return spill | own | (F.coalesce(yesterday["open24"], F.lit(False)) if all_day_spills else F.lit(False))


def open_at(today: Column, yesterday: Column, minute: Column, all_day_spills: bool = True) -> Column:
    """Whether open at a minute of today: own periods, or yesterday's that close today. Arguments as day_row gives them, or null.

    With all_day_spills a yesterday that was open for 24 hours counts for the whole of today, too.
    """
    return open_in(in_minutes(today), in_minutes(yesterday), minute, all_day_spills)


def status(today: Column, yesterday: Column, minute: Column) -> Column:
    """What to show at a minute of today."""
    spill = F.get(F.filter(yesterday["periods"], lambda p: p["closes_next_day"] & (minute < minutes(p["closes"]))), 0)
    now = F.get(F.filter(today["periods"], lambda p: (minute >= minutes(p["opens"])) & (p["closes_next_day"] | (minute < minutes(p["closes"])))), 0)
    later = F.get(F.filter(today["periods"], lambda p: minute < minutes(p["opens"])), 0)
    said = lambda text, p, k: F.concat(F.lit(text), clock(p[k]))
    open_now = lambda p: F.when(p["closes_next_day"], said("Open · Closes tomorrow at ", p, "closes")).when(p.isNotNull(), said("Open · Closes at ", p, "closes"))
    return (
        F.when(today.isNull(), "Hours unavailable today").when(today["closed"], "Closed today").when(today["open24"], "Open 24 hours")
        .otherwise(F.coalesce(let(spill, lambda p: said("Open · Closes today at ", p, "closes")), let(now, open_now), let(later, lambda p: said("Closed · Opens at ", p, "opens")), F.lit("Closed")))
    )
