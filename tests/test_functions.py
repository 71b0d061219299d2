"""Literal rows for the rules that tables of the test data do not reach."""

import pytest
from pyspark.sql import functions as F

from curio.functions import arrays, geo, hours, text
from curio.operators import extract, matching, merge, summaries
from curio.sources import readers, writers
from curio.streaming import ledger


def values(spark, rows, fn, ddl="v string"):
    df = spark.createDataFrame([(i, *r) if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)], "i int, " + ddl)
    return [r[0] for r in df.select("i", fn.alias("x")).orderBy("i").select("x").collect()]


def test_phones(spark):
    rows = ["8888 1234", "+1 (555) 010-9999", "123", None, "", "50688881234", "1" * 16]
    assert values(spark, rows, text.phone_e164(F.col("v"))) == ["+50688881234", "+15550109999", "", "", "", "+50688881234", ""]
    assert values(spark, ["Tel: 88881234", "0050627501234", "088881234", "4930123456"], text.phone_local(F.col("v"))) == ["+50688881234", "+50627501234", "+50688881234", "+5064930123456"]
    assert values(spark, ["https://wa.me/4917012345678", "88881234", "77", None], text.whatsapp(F.col("v"))) == ["+4917012345678", "+50688881234", "", ""]


def test_links(spark):
    rows = ["https://a.example/x", "http://a.example", "https:///x", " https://b.example ", None]
    assert values(spark, rows, text.https_url(F.col("v"))) == ["https://a.example/x", "", "", "https://b.example", ""]
    assert values(spark, ["@ok.name", "bad name", "x" * 31], text.handle(F.col("v"))) == ["ok.name", "", ""]


def test_normalisers_are_idempotent(spark):
    rows = ["  Café  del-Sol! ", "ÑANDÚ & co", "", None, "a - b - c"]
    for fn in (text.norm_text, text.norm_name, text.fold, text.amenity_key, text.url_norm):
        once = values(spark, rows, fn(F.col("v")))
        assert values(spark, once, fn(F.col("v"))) == once


def test_display_names(spark):
    rows = [("Casa Luna - Cahuita, Limón", "Cahuita"), ("Bar Azul, Cahuita", "Cahuita"), ("Rock - Roll", "Cahuita"), (" - ", "x")]
    assert values(spark, rows, text.display_name(F.col("v"), F.col("a"), "limón"), "v string, a string") == ["Casa Luna", "Bar Azul", "Rock - Roll", "-"]


def test_mojibake(spark):
    assert values(spark, ["CafÃ©", "café", "Ã 漢", None, "Â"], text.repair_mojibake(F.col("v"))) == ["Café", "café", "Ã 漢", None, "Â"]


def test_hours(spark):
    rows = ["Friday 4 PM to 2:30 AM", "Tuesday Closed", "Sunday (Feast day) 12 to 10 PM, Hours might differ", "Someday 9 AM to 5 PM", "Monday 13 AM to 5 PM"]
    got = values(spark, rows, hours.day_row(F.col("v")))
    assert [g.day for g in got] == ["friday", "tuesday", "sunday", None, "monday"]
    assert [[(p.opens, p.closes, p.closes_next_day) for p in g.periods] for g in got] == [[("16:00", "02:30", True)], [], [("12:00", "22:00", False)], [("09:00", "17:00", False)], []]
    assert got[2].holiday == "Feast day" and got[2].might_differ and got[1].closed


def test_names_match(spark):
    rows = [("Casa Verde Hotel", "Hotel Casa Verde"), ("Luna B&B Playa", "Luna Bed and Breakfast Playa"), ("Bar", "Zzz Yyy"), ("Casa Azul Norte", "Tienda Roja Sur")]
    assert values(spark, rows, matching.names_match(F.col("a"), F.col("b")), "a string, b string") == [True, True, True, False]


def test_udfs(spark):
    assert values(spark, [("abcd", "bcde"), ("", None)], matching.seq_ratio("a", "b"), "a string, b string") == [0.75, 1.0]
    assert values(spark, ["ÁＢﬁ", None], matching.unicode_fold("v")) == ["abfi", None]


def test_pairs_are_ordered_and_blocks_bounded(spark):
    keys = spark.createDataFrame([(i, "big") for i in range(40)] + [(1, "k"), (2, "k"), (2, "j"), (1, "j")], "id int, key string")
    assert [tuple(r) for r in matching.candidate_pairs(keys).collect()] == [(1, 2)]


def test_clusters(spark):
    pairs = spark.createDataFrame([(1, 2), (2, 3), (5, 6)], "l int, r int")
    assert sorted(map(tuple, matching.clusters(pairs).collect())) == [(1, 1), (2, 1), (3, 1), (5, 5), (6, 5)]


def test_guarded_changes(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    m = spark.createDataFrame([(1, "a", "x"), (2, "zz", "y"), (3, "b", "c"), (9, "a", "b")], "id int, expected string, new string")
    table, audit = merge.expect(t, m, "id", "v")
    assert sorted(map(tuple, audit.collect())) == [(1, "applied"), (2, "stale"), (3, "noop"), (9, "no_such_row")]
    again, audit2 = merge.expect(table, m, "id", "v")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, table.collect())) == [(1, "x"), (2, "b"), (3, "c")]
    assert ("1" not in str(audit2.where("outcome = 'applied'").collect()))
    with pytest.raises(Exception, match="stale change"):
        merge.expect(t, m, "id", "v", strict=True)[0].collect()


def test_urls_and_arrays(spark):
    assert values(spark, ["a|B/", ""], F.array_join(arrays.add_unique(F.filter(F.split("v", r"\|"), lambda x: x != ""), F.lit("b")), "|")) == ["a|B/", "b"]
    u = values(spark, ["https://m.example/@1.5,-2.5,17z", "x!3d9.1!4d-82.2!1s0x1:0xff"], geo.from_url(F.col("v")))
    assert [(r.lat, r.lon, r.cid) for r in u] == [(1.5, -2.5, None), (9.1, -82.2, "255")]


def test_page_status(spark):
    rows = ['<img src="caution.png" alt="Temporarily closed">', "<b> Closed </b>", '<img src="a-warning.gif">', "<p>Closed on Mondays</p>"]
    assert values(spark, rows, extract.status(F.col("v"))) == ["temporarily_closed", "closed", "needs_verification", "active"]


def test_next_id_fills_the_gap(spark):
    assert summaries.next_id(spark.createDataFrame([(1,), (2,), (4,)], "k int"), "k").first().next_id == 3
    assert summaries.next_id(spark.createDataFrame([], "k int"), "k").first().next_id == 1


def test_readers(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": "1"}, {"id": "2"}]')
    (tmp_path / "b.json").write_text('{"id": "1"}\n\n{"id": "2"}\n')
    (tmp_path / "c.json").write_text("")
    (tmp_path / "d.csv").write_text("﻿name,x\nA,1\n", encoding="utf-8")
    assert readers.json_auto(spark, str(tmp_path / "a.json"), "id string").count() == 2 == readers.json_auto(spark, str(tmp_path / "b.json"), "id string").where("id IS NOT NULL").count()
    with pytest.raises(ValueError):
        readers.json_auto(spark, str(tmp_path / "c.json"))
    assert readers.csv(spark, str(tmp_path / "d.csv")).columns == ["name", "x"]


def test_published_versions(spark, tmp_path):
    p = f"file://{tmp_path}/t"
    with pytest.raises(Exception):
        writers.published(spark, p)
    first = writers.publish(spark.range(10), p)
    spark.range(99).write.parquet(f"{p}/v-99999999999999999999-unfinished")  # no pointer: not seen
    writers.publish(writers.published(spark, p).where("id < 4"), p)
    assert writers.published(spark, p).count() == 4 and spark.read.parquet(first).count() == 10


def test_rounding_and_nfkc(spark):
    from curio.functions.scores import rounded

    assert values(spark, [1.005, 0.125, 0.135, 2.5, -0.125, 12345.675], rounded(F.col("v"), 2), "v double") == [round(x, 2) for x in (1.005, 0.125, 0.135, 2.5, -0.125, 12345.675)]
    assert values(spark, ["ﬁn  Ａ", "Å"], text.norm_text(F.col("v"))) == ["fin a", "å"] and values(spark, ["Wi-Fi ＆ ﬂat"], text.amenity_key(F.col("v"))) == ["wifi_and_flat"]


def test_places_in_order(spark):
    rows = [(i, (i * 7) % 5, f"n{i % 3}") for i in range(60)]
    got = summaries.placed(spark.createDataFrame(rows, "id int, a int, b string").repartition(7), [(F.col("a"), True), (F.col("b"), False), (F.col("id"), False)], "place").collect()
    assert [r.id for r in sorted(got, key=lambda r: r.place)] == [r[0] for r in sorted(rows, key=lambda r: (-r[1], r[2], r[0]))] and sorted(r.place for r in got) == list(range(1, 61))
    assert summaries.placed(spark.createDataFrame([], "id int"), [(F.col("id"), False)], "place").count() == 0


def test_compaction_keeps_one_row(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, 1, None)], "rid int, seq int, state string")
    assert sorted(map(tuple, ledger.compact(rows, "rid").collect())) == [(1, 2, "c"), (2, 1, None)] and ledger.compact(rows, "rid").columns == rows.columns


def test_taxonomy(spark):
    from curio.operators import taxonomy

    cols = "id int, business_name string, category string, description_full string, subcategory string, cuisine string, amenities string"
    rows = [
        (1, "Casa Luna B & B", "Restaurant", "Yoga and massage", None, None, ""), (2, "Clínica Veterinaria Sol", "services", "", "", "", ""), (3, "Clínica  Dental", "", None, "", "", "Spa"),
        (4, "Surf Shop", "shopping", "surfing", "", "", ""), (5, "Shuttle y Tours", "tour_company", "", "", "", ""), (6, None, None, None, None, None, None),
    ]
    got = {r.id: r for r in taxonomy.records(spark.createDataFrame(rows, cols)).collect()}
    assert got[1].tags == ["bed-and-breakfast", "restaurant"] and got[1].attributes == ["massage", "yoga"] and got[1].conflicts == ["restaurant_with_lodging_evidence"]
    assert got[1].groups == ["eat", "stay"] and {a.tag: (a.confidence, a.source, a.rule, a.evidence) for a in got[1].assertions}["bed-and-breakfast"] == (0.96, "master.name", "explicit:bed-and-breakfast", "b & b")
    assert got[2].tags == ["local-service", "veterinary"] and got[3].tags == ["dental", "medical"] and got[3].attributes == ["spa"] and "missing_primary_category" in got[3].conflicts
    assert got[4].tags == ["shop"] and got[5].conflicts == ["tour_company_with_transport_identity"] and got[6].tags == [] and got[6].review_state == "review"
    assert "bed & breakfast" in got[1].synonyms and "hospedaje" in got[1].synonyms


def test_entry_audit(spark):
    from curio.operators import audits

    cols = "id int, business_name string, category string, area string, subcategory string, description_full string, phone string, whatsapp string, google_maps_cid string, website string"
    rows = [(1, "Hotel Sol", "hotel", "A", "", "A fine place with rooms and a garden by the sea.", "1", "", "5", "x"), (2, "bar", "hotel", "", "Cocktail bar", "", "", "", "", ""), (3, None, None, None, None, None, None, None, None, None)]
    got = {r.id: r for r in audits.entry(spark.createDataFrame(rows, cols)).collect()}
    assert (got[1].issues, got[1].fixes, got[1].score) == ([], [], 100)
    assert got[2].issues == ["category_mismatch", "unreachable", "no_map_id", "no_website", "no_area", "short_name", "generic_name", "no_description", "subcategory_nightlife"] and got[2].score == 0
    assert "no_category" in got[3].issues and got[3].score == 0


def test_ranges_by_both_ways(spark):
    from curio.operators import relations

    rows, zones = spark.range(200).withColumn("x", F.col("id") * 1.5), spark.createDataFrame([(0, 10.0, 40.0), (1, 30.0, 90.0), (2, 500.0, 600.0)], "zone int, lo double, hi double")
    few = sorted(map(tuple, relations.in_ranges(rows, "x", zones).select("id", "zone").collect()))
    assert few == sorted(map(tuple, relations.in_ranges(rows, "x", zones, most=1).select("id", "zone").collect())) and len(few) > 50
