"""Catalogue registry, parameter bounds, bounded records and the report."""

import pytest
from pyspark.sql import functions as F

from basket.plans import catalog
from basket.plans.report import REPORT_KEYS, run_report, to_records
from basket.sources.star import from_star
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def t(spark):
    return from_star(spark, SF_SMALL)


def test_eighteen_queries_in_six_groups():
    assert len(catalog.CATALOG) == 18
    assert {e.group for e in catalog.CATALOG.values()} == set(catalog.GROUPS)
    assert {k for k, e in catalog.CATALOG.items() if e.needs_n} == {"top_products", "top_reordered_products", "top_users_by_orders"}
    assert [k for k, e in catalog.CATALOG.items() if e.needs_min_count] == ["top_reordered_products"]
    assert len(REPORT_KEYS) == 16


@pytest.mark.parametrize(
    "key,params",
    [
        ("top_products", {"n": 0}),
        ("top_products", {"n": 101}),
        ("top_reordered_products", {"min_count": 0}),
        ("top_reordered_products", {"min_count": 1_000_001}),
        ("kmeans_user_clusters", {"k": 1}),
        ("kmeans_user_clusters", {"k": 21}),
        ("kpi", {"n": 5}),
        ("kmeans_user_clusters", {"assign": "some"}),
        ("kmeans_user_clusters", {"user_fraction": 1.5}),
        ("kmeans_user_cluster_profile", {"min_orders": 0}),
        ("nope", {}),
    ],
)
def test_bounds(t, key, params):
    with pytest.raises(ValueError):
        catalog.run(t, key, **params)


def test_records_are_bounded_ordered_and_flagged(t):
    found = to_records(catalog.run(t, "orders_by_hour"), limit=5)
    assert len(found.rows) == 5 and set(found.rows[0]) == {"order_hour_of_day", "num_orders"}
    assert found.truncated and found.total == 24
    assert not to_records(catalog.run(t, "orders_by_hour"), limit=24).truncated
    with pytest.raises(ValueError):
        to_records(catalog.run(t, "orders_by_hour"), limit=50_001)


def test_records_do_not_depend_on_the_layout(spark):
    df = spark.range(5000).withColumnRenamed("id", "user_id").selectExpr("user_id", "CAST(user_id % 7 AS INT) AS cluster")
    a, b = (to_records(x, limit=300) for x in (df.repartition(3), df.repartition(11, "cluster")))
    assert a == b and a.truncated and a.total == 5000


def test_report_shows_every_row(t, capfd):
    run_report(t, show=True, n=30)
    shown = capfd.readouterr().out
    hours = shown.split("== Orders by hour ==")[1].split("==")[0]
    assert sum(line.startswith("|") for line in hours.splitlines()) == 24 + 1
    top = shown.split("== Top users by orders ==")[1].split("==")[0]
    assert sum(line.startswith("|") for line in top.splitlines()) == 30 + 1


def test_report_writes_every_query(t, tmp_path, spark):
    out = tmp_path / "report"
    run_report(t, str(out), n=5)
    for key in REPORT_KEYS:
        assert spark.read.parquet(str(out / key)).count() >= 1
    assert spark.read.parquet(str(out / "top_products")).count() == 5


def test_query_records_caps(t):
    from basket.plans.report import query_records

    assert [r["order_hour_of_day"] for r in query_records(t, "orders_by_hour", limit=3).rows] == [0, 1, 2]
    assert len(query_records(t, "top_products", n=7).rows) == 7
    departments = query_records(t, "sales_by_department")
    assert len(departments.rows) == departments.total == 8
    sold = [r["items_sold"] for r in departments.rows]
    assert sold == sorted(sold, reverse=True)


def test_string_parameters_are_converted(t):
    assert catalog.N.check("7") == 7 and catalog.CLUSTER.check("1") == 1 and catalog.CLUSTER.check(None) is None
    with pytest.raises(ValueError):
        catalog.CLUSTER.check("x")
    with pytest.raises(ValueError):
        catalog.CLUSTER.check("25")
    assert len(catalog.run(t, "top_products", n="4").collect()) == 4


def test_segmentation_parameters_are_on_the_surface(t):
    from basket.plans import segments as G

    rows = catalog.run(t, "kmeans_user_clusters", k="3", user_fraction="0.6", max_users=60, assign="all", min_orders=2).collect()
    assert {r.user_id for r in rows} == {r.user_id for r in G.sample_users(t.orders, 0.6, 42, 60).collect()}


def test_records_run_the_query_once(spark):
    from basket.plans.report import to_records

    sc = spark.sparkContext
    sc.setJobGroup("records", "one run")
    try:
        found = to_records(spark.range(5000, numPartitions=3).withColumn("x", -F.col("id")), limit=4, order=("x",))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert [r["id"] for r in found.rows] == [4999, 4998, 4997, 4996] and found.total == 5000 and found.truncated
    assert len(sc.statusTracker().getJobIdsForGroup("records")) == 1
    assert to_records(spark.range(0), limit=4).total == 0


def test_kpi_by_bitmaps_equals_counts_per_order(spark):
    from basket.plans.overview import kpi_overview, kpi_overview_bitmaps

    orders = spark.range(10).withColumnRenamed("id", "order_id")
    ids = [1, 1, 32767, 32768, 32769, 32769, 10**12, -5, 0, None, None]
    for rows in (ids, ids[:1], [None], []):
        items = spark.createDataFrame([(i,) for i in rows], "order_id long").repartition(3)
        bitmaps = kpi_overview_bitmaps(orders, items)
        assert bitmaps.collect() == kpi_overview(orders, items).collect()
        assert "hashpartitioning(order_id" not in bitmaps._jdf.queryExecution().executedPlan().toString()
