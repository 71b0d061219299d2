"""Names compared in all their pairs, boxes whose borders hold points, and zones that meet points without a further exchange."""

import duckdb
import pytest

from curio.operators import zones
from curio.plans import registry

QUERIES, ORACLES = registry.queries(), registry.oracles()


@pytest.fixture(scope="module")
def borders(spark, sf, tmp_path_factory):
    """Customers whose places lie on the borders of boxes, beside the given tables."""
    d = str(tmp_path_factory.mktemp("borders"))
    spark.range(15_000).selectExpr("id AS c_custkey", "CAST(id % 25 AS INT) AS c_nationkey", "'BUILDING' AS c_mktsegment").coalesce(1).write.parquet(f"{d}/customer.parquet")
    for t in ("nation", "region"):
        spark.read.parquet(f"{sf}/{t}.parquet").write.parquet(f"{d}/{t}.parquet")
    return d


def test_points_on_borders_of_boxes(spark, borders):
    con = duckdb.connect()
    for t in ("customer", "nation", "region"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{borders}/{t}.parquet/*.parquet')")
    got, want = {r.id for r in QUERIES["flt_bbox"](spark, borders).collect()}, {r[0] for r in con.sql(ORACLES["flt_bbox"]).fetchall()}
    assert got == want and {2200, 4300, 6400} <= got


def test_names_are_compared_in_all_pairs(spark, sf):
    got = {(r.ln, r.rn) for r in QUERIES["er_compare_names"](spark, sf).select("ln", "rn").collect()}
    sharing = {(r.ln, r.rn) for r in QUERIES["er_jaccard"](spark, sf).select("ln", "rn").collect()}
    assert sharing and sharing <= got


def test_rows_of_points_stay_apart(spark):
    """Points need no key: equal rows each come once, and nothing is collected by pairs."""
    points = spark.createDataFrame([(9.5, -82.5), (9.5, -82.5)], "lat double, lon double")
    circles = spark.createDataFrame([(1, 9.5, -82.5, 1.0), (1, 9.5, -82.5, 1.0)], "zone int, centre_lat double, centre_lon double, radius_km double")
    assert zones.in_circles(points, circles).count() == 2
    plan = zones.in_circles(points, circles)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") > plan.index("Join")  # of zones alone, below the join
