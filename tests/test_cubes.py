"""The batch report from stored aggregates gives what the single queries give, from two scans of the fact."""

import pytest
from pyspark.sql import functions as F

from basket.plans import catalog, cubes
from basket.sources.star import build_star_tables, from_star
from basket.sources.tables import Tables
from tests import mini
from tests.conftest import SF_SMALL
from tests.test_plans import _final_plan

PARAMS = {"top_products": {"n": 25}, "top_reordered_products": {"n": 30, "min_count": 3}, "top_users_by_orders": {"n": 40}}


def rows(df):
    return [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()]


@pytest.fixture(scope="module")
def star(spark):
    t = from_star(spark, SF_SMALL)
    return t, cubes.build_cubes(spark, t)


@pytest.fixture(scope="module")
def odd(spark):
    """Items without an order, an order's split, a product or a flag; orders in both splits; an order without a weekday."""
    orders = [
        mini.orders_row(1, 7, dow=1, hour=9),
        mini.orders_row(2, 7, number=2, dow=None, hour=None, days=3.0),
        mini.orders_row(3, 8, eval_set="train", dow=4, hour=23),
        mini.orders_row(4, None, eval_set="test", dow=6, hour=0),
    ]
    prior = [mini.item(1, 10, 0), mini.item(1, 20, 1, 2), mini.item(1, 99, 1, 3), mini.item(2, 10, None), mini.item(None, 30, 1), mini.item(50, 30, 0)]
    prior += [mini.item(3, 20, 1, i) for i in range(1, 13)]
    train = [mini.item(3, 10, 1), mini.item(3, 30, 0, 2), mini.item(None, 10, None), mini.item(1, None, 1)]
    t = mini.make(spark, orders, prior, train)
    return t, cubes.build_cubes(spark, t)


def test_covers_every_report_query():
    assert set(cubes.KEYS) == {k for k in catalog.CATALOG if not k.startswith("kmeans")}


@pytest.mark.parametrize("key", cubes.KEYS)
def test_equals_the_single_query(star, odd, key):
    for t, c in (star, odd):
        single, own = catalog.run(t, key, **PARAMS.get(key, {})), cubes.answer(c, key, **PARAMS.get(key, {}))
        assert own.columns == single.columns
        assert [f.dataType for f in own.schema] == [f.dataType for f in single.schema]
        assert rows(own) == rows(single)


@pytest.fixture(scope="module")
def empty(spark):
    t = mini.make(spark, [], [], [])
    return t, cubes.build_cubes(spark, t)


@pytest.mark.parametrize("key", cubes.KEYS)
def test_empty_tables(empty, key):
    t, c = empty
    assert rows(cubes.answer(c, key)) == rows(catalog.run(t, key))


@pytest.mark.parametrize("n", [1, 13])
def test_does_not_depend_on_the_layout(spark, star, n):
    t, c = star
    own = [getattr(t, f).repartition(n) for f in ("orders", "order_items", "products", "aisles", "departments")]
    again = cubes.build_cubes(spark, Tables(*own))
    for key in cubes.KEYS:
        assert rows(cubes.answer(again, key)) == rows(cubes.answer(c, key))


def test_parameters_are_checked(star):
    with pytest.raises(ValueError):
        cubes.answer(star[1], "top_products", n=0)
    with pytest.raises(ValueError):
        cubes.answer(star[1], "kpi", n=5)


def test_two_scans_of_the_fact(spark, tmp_path):
    """The two aggregates scan the fact once each, the one by order without a shuffle of orders; no query scans it."""
    t = build_star_tables(spark, SF_SMALL, str(tmp_path / "stored"), buckets=4)
    by_order = _final_plan(cubes.basket_cube(t))
    # On the buckets order ids don't move before the baskets are counted by size.
    assert "Bucketed: true" in by_order and "hashpartitioning(order_id" not in by_order
    by_product = _final_plan(cubes.product_cube(t.order_items))
    scans = [sum("FileScan" in line and "reordered" in line for line in by_product.splitlines())]
    scans.append(sum("FileScan" in line and "eval_set" in line and "order_dow" not in line for line in by_order.splitlines()))
    assert scans == [1, 1], scans
    c = cubes.build_cubes(spark, t)
    for key in cubes.KEYS:
        plan = cubes.answer(c, key)._jdf.queryExecution().executedPlan().toString()
        assert "order_items" not in plan and "add_to_cart_order" not in plan and "eval_set=" not in plan
    assert c.by_basket.agg(F.sum("orders")).head()[0] == t.order_items.select("order_id").distinct().count()
