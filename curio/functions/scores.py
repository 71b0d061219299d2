"""Scores, badges and contact choices of a directory record. Each takes a function from field name to column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from curio.functions import text as T

Field = Callable[[str], Column]

# Points of the three scores.
COMPLETE = (("business_name", 10), ("category", 10), ("area", 10), ("latitude", 15), ("phone", 10), ("website", 10), ("instagram_handle|facebook_url", 10), ("description_full", 10), ("operating_status", 5), ("verified_date", 10))
VISIBLE = (("google_maps_cid", 35), ("latitude", 25), ("booking_url", 15), ("tripadvisor_url", 10), ("email", 5))
INTENTS = {"hotel": "stay", "vacation_rental": "stay", "hostel": "stay", "restaurant": "eat", "tour_company": "tour", "shopping": "shopping", "services": "services", "real_estate": "services", "wellness": "wellness", "nightlife": "nightlife", "transport": "transport"}


def rounded(x: Column, places: int) -> Column:
    """x to some decimal places by its exact binary value, exact halves to even."""
    return F.replace(F.format_number(x.cast("double"), places), F.lit(","), F.lit("")).cast("double")


def _points(parts: list[tuple[Column, int]]) -> Column:
    out = F.lit(0)
    for has, n in parts:
        out = out + F.when(has, n).otherwise(0)
    return F.least(out, F.lit(100))


def contact(f: Field) -> Column:
    return _points([(T.whatsapp(f("whatsapp")) != "", 40), (T.present(f("phone")), 30), (T.handle(f("instagram_handle")) != "", 15), (T.present(f("website")), 10), (T.present(f("facebook_url")), 5)])


def visibility(f: Field) -> Column:
    return _points([*((T.present(f(k)), n) for k, n in VISIBLE), (T.clean(f("instagram_confidence")) == "verified", 10)])


def completeness(f: Field) -> Column:
    def any_of(names: str) -> Column:
        out = F.lit(False)
        for n in names.split("|"):
            out = out | T.present(f(n))
        return out

    return _points([(any_of(k), n) for k, n in COMPLETE])


def closed(f: Field) -> Column:
    return F.lower(T.clean(f("operating_status"))).isin("closed", "permanently_closed")


def badges(f: Field) -> Column:
    return F.when(closed(f), F.array().cast("array<string>")).otherwise(F.array_compact(F.array(
        F.when(T.whatsapp(f("whatsapp")) != "", "WhatsApp"),
        F.when((T.handle(f("instagram_handle")) != "") & (T.clean(f("instagram_confidence")) == "verified"), "Instagram"),
        F.when(T.present(f("booking_url")), "Booking"), F.when(T.https_url(f("website")) != "", "Website"),
    )))


def primary(f: Field) -> Column:
    """struct(type, url) of the first contact route there is."""
    wa, phone, ig, web = T.whatsapp(f("whatsapp")), T.phone_e164(f("phone")), T.handle(f("instagram_handle")), T.https_url(f("website"))
    cid, lat, lon = (T.clean(f(k)) for k in ("google_maps_cid", "latitude", "longitude"))
    one = lambda kind, url: F.struct(F.lit(kind).alias("type"), url.alias("url"))
    return (
        F.when(closed(f), one("None", F.lit(""))).when(wa != "", one("WhatsApp", T.route(wa))).when(phone != "", one("Call", F.concat(F.lit("tel:"), phone)))
        .when(ig != "", one("Instagram", F.concat(F.lit("https://instagram.com/"), ig))).when(web != "", one("Website", web))
        .when(cid != "", one("Map", F.concat(F.lit("https://www.google.com/maps?cid="), cid)))
        .when((lat != "") & (lon != ""), one("Map", F.concat(F.lit("https://www.google.com/maps/search/"), lat, F.lit(","), lon))).otherwise(one("None", F.lit("#")))
    )


def secondary(f: Field) -> Column:
    """Labels of all further links there are, in order."""
    return F.when(closed(f), F.array().cast("array<string>")).otherwise(F.array_compact(F.array(
        F.when(T.phone_e164(f("phone")) != "", "Call"), F.when(T.handle(f("instagram_handle")) != "", "Instagram"), F.when(T.https_url(f("facebook_url")) != "", "Facebook"),
        F.when(T.https_url(f("website")) != "", "Website"), F.when(T.https_url(f("booking_url")) != "", "Booking.com"), F.when(T.https_url(f("tripadvisor_url")) != "", "TripAdvisor"),
        F.when(T.present(f("google_maps_cid")) | (T.present(f("latitude")) & T.present(f("longitude"))), "Google Maps"),
    )))


def intents(category: Column) -> Column:
    out = F.lit("other")
    for k, v in INTENTS.items():
        out = F.when(F.lower(T.clean(category)) == k, v).otherwise(out)
    return F.array(out)


def entry_score(issues: Column, has_contact: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(100), F.lit(100) - issues * 15 - F.when(has_contact, 0).otherwise(10)))


def stars(rating: Column) -> Column:
    """struct(full, half): whole stars and whether a half follows."""
    return F.struct(F.floor(rating).cast("int").alias("full"), ((rating - F.floor(rating)) >= 0.3).alias("half"))


def confidence(has_cid: Column, has_coords: Column, in_zone: Column) -> Column:
    return F.when(has_cid & has_coords & in_zone, "high").when(has_cid | (has_coords & in_zone), "medium").otherwise("low")
