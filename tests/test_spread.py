"""Costly work on rows is dealt to many tasks, though their table is one small file, and done once."""

import pytest

from curio.plans import registry

QUERIES = registry.queries()


def plan(spark, sf, name):
    return QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["st_open_now", "dt_status", "dt_open_at", "dq_partial", "dt_week", "ex_aria_hours", "dt_day_row"])
def test_hours_are_spread_and_parsed_once(spark, sf, name):
    shown = plan(spark, sf, name)
    sides = 2 if name in ("st_open_now", "dt_status", "dt_open_at") else 1  # today and yesterday
    assert "Repartition" in shown and shown.count("regexp_extract_all") == sides


@pytest.mark.parametrize("name", ["ex_maps_v1", "ex_maps_v3"])
def test_captures_are_spread_and_cut_into_lines_once(spark, sf, name):
    shown = plan(spark, sf, name)
    assert "Repartition" in shown and shown.count("split(") <= 2


@pytest.mark.parametrize("name", ["cl_first_evidence", "cl_rules", "cl_record", "cl_recommend", "cl_resolution", "cl_conflicts", "cl_group_expand", "cl_exposure", "cl_identity_split", "dq_source"])
def test_records_are_spread_and_classified_once(spark, sf, name):
    shown = plan(spark, sf, name)
    assert "Repartition" in shown and shown.count("nfkc(") <= shown.count("ArrowEvalPython") * 2 and shown.count("ArrowEvalPython") == 1


def test_listing_pages_are_spread(spark, sf):
    assert "Repartition" in plan(spark, sf, "ex_listing")
