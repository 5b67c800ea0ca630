"""Physical-plan checks: top-k operator, pushdown and pruning, no Python in the plan."""

import pytest

from basket.plans import catalog
from basket.sources.star import from_star
from basket.sources.tables import load_tables, save_tables
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored"))
    save_tables(from_star(spark, SF_SMALL), path)
    return load_tables(spark, path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["top_products", "top_reordered_products", "top_users_by_orders"])
def test_top_k_is_take_ordered(stored, key):
    assert "TakeOrderedAndProject" in plan(catalog.run(stored, key))


@pytest.mark.parametrize("key", [k for k in catalog.CATALOG if not k.startswith("kmeans")])
def test_no_python_udf(stored, key):
    p = plan(catalog.run(stored, key))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


def test_split_filter_prunes_partitions(stored):
    p = plan(stored.op_train.groupBy("order_id").count())
    assert "PartitionFilters: [isnotnull(eval_set" in p and "= train)" in p


def test_columns_pruned_at_scan(stored):
    p = plan(catalog.run(stored, "reorder_rate_global"))
    assert "ReadSchema: struct<reordered:int>" in p


def _indent(line: str) -> int:
    return len(line) - len(line.lstrip(" :|+-"))


def _final_plan(df) -> str:
    """The executed (final) plan, without the initial plans printed inside subqueries."""
    df.collect()  # AQE settles the final plan on execution
    text = df._jdf.queryExecution().executedPlan().executedPlan().toString()
    kept, skip_deeper_than = [], None
    for line in text.splitlines():
        if skip_deeper_than is not None:
            if _indent(line) >= skip_deeper_than:
                continue
            skip_deeper_than = None
        if "== Initial Plan ==" in line:
            skip_deeper_than = _indent(line)
            continue
        kept.append(line)
    return "\n".join(kept)


@pytest.mark.parametrize(
    "key", ["kpi", "top_products", "sales_by_department", "reorder_rate_by_department", "avg_items_by_dow"]
)
def test_fact_scanned_once(stored, key):
    p = _final_plan(catalog.run(stored, key))
    assert p.count("order_items]") == 1, p


def test_features_scan_fact_once(stored):
    from basket.plans import segments as G

    p = _final_plan(G.user_features(stored.orders, stored.order_items, stored.products))
    assert p.count("order_items]") == 1, p


@pytest.mark.parametrize("key", [k for k in catalog.CATALOG if not k.startswith("kmeans")])
def test_hash_aggregates_only(stored, key):
    """Aggregation buffers stay fixed-width: no sort-based or object aggregate."""
    p = _final_plan(catalog.run(stored, key))
    assert "SortAggregate" not in p and "ObjectHashAggregate" not in p


def test_features_use_hash_aggregates_only(stored):
    from basket.plans import segments as G

    p = _final_plan(G.user_features(stored.orders, stored.item_parts, stored.products))
    assert "SortAggregate" not in p and "ObjectHashAggregate" not in p


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    from basket.sources.star import build_star_tables

    return build_star_tables(spark, SF_SMALL, str(tmp_path_factory.mktemp("bucketed")), buckets=4)


@pytest.mark.parametrize(
    "key", ["kpi", "avg_items_by_dow", "basket_size_buckets", "avg_items_per_order_by_eval_set", "features"]
)
def test_per_order_work_is_shuffle_free_on_buckets(bucketed, key):
    from basket.plans import segments as G

    if key == "features":
        df = G.user_features(bucketed.orders, bucketed.item_parts, bucketed.products)
    else:
        df = catalog.run(bucketed, key)
    p = _final_plan(df)
    assert "Bucketed: true" in p
    assert "hashpartitioning(order_id" not in p and "hashpartitioning(eval_set#" not in p, p
