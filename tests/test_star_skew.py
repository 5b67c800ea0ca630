"""The star derivation on a skewed fixture equals the DuckDB derivation (brute force).

One customer holds 40 % of the orders (and some same-day orders), one order holds a
large share of the line items, one part name dominates: the range-partitioned order
history must still give exactly the window answer.
"""

import datetime as dt
import random

import pandas as pd
import pytest

import __spark_entry__ as E
from basket.sources.star import from_star
from tests.oracle import compare, duck


@pytest.fixture(scope="module")
def skew_dir(tmp_path_factory):
    rnd = random.Random(11)
    d = tmp_path_factory.mktemp("skewstar")
    adjectives = ["red", "old", "hot", "big"]
    nouns = ["rod", "cup", "box"]
    part = pd.DataFrame(
        {
            "p_partkey": list(range(1, 41)),
            "p_name": [f"{rnd.choice(adjectives)} {rnd.choice(nouns)}" for _ in range(40)],
        }
    )
    base = dt.datetime(1995, 1, 1)
    orders = []
    for k in range(1, 801):
        cust = 3 if rnd.random() < 0.4 else rnd.randint(4, 90)
        orders.append((k, cust, base + dt.timedelta(days=rnd.randint(0, 60))))
    o = pd.DataFrame(orders, columns=["o_orderkey", "o_custkey", "o_orderdate"])
    lines = []
    for i in range(4000):
        order = 17 if rnd.random() < 0.3 else rnd.randint(1, 800)
        partkey = 5 if rnd.random() < 0.3 else rnd.randint(1, 40)
        lines.append((order, partkey, i % 7 + 1))
    li = pd.DataFrame(lines, columns=["l_orderkey", "l_partkey", "l_linenumber"]).astype(
        {"l_orderkey": "int64", "l_partkey": "int64", "l_linenumber": "int32"}
    )
    part.to_parquet(d / "part.parquet")
    o["o_orderdate"] = o["o_orderdate"].astype("datetime64[us]")
    o.to_parquet(d / "orders.parquet")
    li.to_parquet(d / "lineitem.parquet")
    return str(d)


@pytest.fixture(scope="module")
def skew_tables(spark, skew_dir):
    return from_star(spark, skew_dir)


@pytest.mark.parametrize("name", ["orders_table", "order_items_table", "products_table", "departments_table"])
def test_skewed_star_matches_duckdb(skew_tables, skew_dir, name):
    t = skew_tables
    df = {
        "orders_table": t.orders,
        "order_items_table": t.order_items,
        "products_table": t.products,
        "departments_table": t.departments,
    }[name]
    assert compare(df, duck(skew_dir), E.oracle_sql()[name]) is None


def test_hot_customer_spans_partitions(spark, skew_dir):
    from pyspark.sql import functions as F

    o = spark.read.parquet(skew_dir + "/orders.parquet")
    ranged = o.repartitionByRange(8, "o_custkey", "o_orderdate", "o_orderkey").withColumn("p", F.spark_partition_id())
    assert ranged.filter("o_custkey = 3").select("p").distinct().count() >= 2


def test_hot_pairs_take_the_broadcast_path(spark, skew_dir):
    """With a tiny threshold most pairs are "hot": same items as the join path."""
    from basket.sources import star as ST

    part = ST.read_star(spark, skew_dir, "part")
    orders = ST.star_orders(ST.read_star(spark, skew_dir, "orders"))
    products = ST.star_products(part)
    lines = ST.star_lines(ST.read_star(spark, skew_dir, "lineitem"), part, orders, products)
    normal = ST.mark_reorders(lines)
    split = ST.mark_reorders(lines, hot_pair_rows=2)
    assert lines.groupBy("user_id", "product_id").count().filter("count > 2").count() > 0
    assert normal.count() == split.count() == lines.count()
    assert normal.exceptAll(split).count() == 0 and split.exceptAll(normal).count() == 0


def test_hot_orders_stay_out_of_the_buckets(spark, tmp_path):
    """One order holds half of the items: no bucket file is far above the others, and answers stay."""
    import glob

    import pyarrow.parquet as pq

    from basket.plans import catalog
    from basket.plans import segments as G
    from basket.sources.tables import load_tables, save_tables
    from tests.mini import item, make, orders_row

    prior = [item(1, 10 + 10 * (i % 3), i % 2, i) for i in range(4000)] + [item(o, 10 + 10 * (o % 3), o % 2, p) for o in range(2, 802) for p in range(5)]
    t = make(spark, [orders_row(o, o % 50, "prior", 1, o % 7) for o in range(1, 802)], prior, [item(1, 20, 1), item(9, 20, 1)])
    save_tables(t, str(tmp_path / "b"), buckets=4, hot_order_rows=100)
    files = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{tmp_path}/b/order_items/eval_set=prior/*.parquet")]
    assert len(files) == 4 and max(files) <= 2 * sorted(files)[len(files) // 2]
    back = load_tables(spark, str(tmp_path / "b"))
    assert len(back.item_parts) == 2 and back.order_items.count() == t.order_items.count()
    for key in ("kpi", "avg_items_by_dow", "basket_size_buckets", "avg_items_per_order_by_eval_set", "top_products"):
        assert catalog.run(back, key).collect() == catalog.run(t, key).collect()
    a, b = (G.user_features(x.orders, x.item_parts, x.products) for x in (t, back))
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_lines_move_once_to_their_pairs(spark, skew_dir, tmp_path):
    """The first order number needs one shuffle of the lines and no join with a table of pairs."""
    from basket.sources import star as ST

    part = ST.read_star(spark, skew_dir, "part")
    orders = ST.star_orders(ST.read_star(spark, skew_dir, "orders"))
    lines = ST.star_lines(ST.read_star(spark, skew_dir, "lineitem"), part, orders, ST.star_products(part))
    lines.write.parquet(str(tmp_path / "lines"))
    lines = spark.read.parquet(str(tmp_path / "lines"))
    ST.busy_pair_facts(lines).write.parquet(str(tmp_path / "pairs"))
    items = ST.mark_reorders(lines, stats=spark.read.parquet(str(tmp_path / "pairs")), partitions=5)
    items.collect()
    plan = items._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning(") == 1 and "SortMergeJoin" not in plan and "HashAggregate" not in plan


def test_only_busy_users_are_counted_by_pair(spark):
    """Hot pairs are those of users with more lines than the threshold; lines without a user belong to no pair."""
    from basket.sources import star as ST

    rows = [(o, 1, 7, o, 1, "prior") for o in range(1, 9)] + [(o, 1, 8, o, 2, "prior") for o in range(2, 4)]
    rows += [(20 + o, 2, 7, o, 1, "train") for o in range(1, 4)] + [(30, None, 7, 1, 1, "prior")]
    lines = spark.createDataFrame(
        rows, "order_id long, user_id long, product_id long, order_number int, add_to_cart_order int, eval_set string"
    )
    assert sorted(map(tuple, ST.busy_pair_facts(lines.dropna(), 5).collect())) == [(1, 7, 1, 8), (1, 8, 2, 2)]
    # A tie in the first number, and an order that is there twice.
    lines = lines.union(lines.filter("order_id in (1, 22)"))
    want = sorted([(o, 7, int(o > 1)) for o in [1, *range(1, 9)]] + [(2, 8, 0), (3, 8, 1)] + [(21, 7, 0), (22, 7, 1), (22, 7, 1), (23, 7, 1)])
    for hot in (1, 5, 100):
        for n in (None, 3):
            got = ST.mark_reorders(lines, hot_pair_rows=hot, partitions=n).select("order_id", "product_id", "reordered")
            assert sorted(map(tuple, got.collect())) == want


def test_items_are_computed_for_the_write_alone(spark, tmp_path):
    """With the orders of the items at hand, saving computes each item once (twice before), and hot orders stay apart."""
    from pyspark.sql import functions as F

    from basket.sources.tables import Tables, load_tables, save_tables
    from tests.mini import item, make, orders_row

    made = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def seen(_):
        made.add(1)
        return True

    t = make(spark, [orders_row(o, 1, "prior", o, 1) for o in (1, 2)], [item(1, 10, 0, i) for i in range(30)] + [item(2, 20, 0, 1)], [])
    watched = Tables(t.orders, t.order_items.filter(seen("order_id")), t.products, t.aisles, t.departments)
    save_tables(watched, str(tmp_path / "b"), buckets=2, item_orders=t.order_items.select("order_id"))
    assert made.value == 31
    save_tables(watched, str(tmp_path / "h"), buckets=2, hot_order_rows=10, item_orders=t.order_items.select("order_id"))
    back = load_tables(spark, str(tmp_path / "h"))
    assert [p.count() for p in back.item_parts] == [1, 30]
