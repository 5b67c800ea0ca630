"""Cross-query invariants and layout independence on the driver's sf0.001 tables."""

import pytest
from pyspark.sql import functions as F

from basket.plans import catalog
from basket.sources.star import from_star
from basket.sources.tables import Tables
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def t(spark):
    return from_star(spark, SF_SMALL)


def val(t, key, **kw):
    return [tuple(r) for r in catalog.run(t, key, **kw).collect()]


def test_counts_add_up(t):
    (num_orders, num_items, _), = val(t, "kpi")
    assert sum(n for _, n in val(t, "orders_count_by_eval_set")) == num_orders
    assert sum(n for _, n in val(t, "items_sold_by_eval_set")) == num_items
    baskets = t.order_items.select("eval_set", "order_id").distinct().count()
    assert sum(n for _, n in val(t, "basket_size_buckets")) == baskets
    assert sum(n for _, n in val(t, "orders_by_dow")) == num_orders
    assert sum(n for _, n in val(t, "orders_by_hour")) == num_orders


def test_percent_sums_to_100(t):
    assert sum(r[3] for r in val(t, "sales_by_department")) == pytest.approx(100.0)


def test_ranges(t):
    assert all(0 <= r[0] <= 6 for r in val(t, "orders_by_dow"))
    assert all(0 <= r[0] <= 23 for r in val(t, "orders_by_hour"))
    (rate,), = val(t, "reorder_rate_global")
    assert 0.0 <= rate <= 1.0
    top = val(t, "top_products", n=5)
    assert 1 <= len(top) <= 5 and [r[2] for r in top] == sorted((r[2] for r in top), reverse=True)


def _relayout(t: Tables, n: int) -> Tables:
    return Tables(*(getattr(t, f).repartition(n) for f in ("orders", "order_items", "products", "aisles", "departments")))


@pytest.mark.parametrize("key", [k for k in catalog.CATALOG if not k.startswith("kmeans")])
def test_layout_independent(t, key):
    base = sorted(val(t, key))
    for n in (1, 13):
        assert sorted(val(_relayout(t, n), key)) == base
