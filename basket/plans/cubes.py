"""The batch report from four stored aggregates: two scans of the fact and two of the orders for all sixteen queries.

Run one by one, the report queries scan the fact eleven times.  Here it is reduced twice: by (split, product), and,
order by order (no shuffle on the bucketed layout), to the number of orders for each weekday and pair of basket sizes.  One scan with
grouping sets for both would double every row and shuffle one row an order, which the bucketed layout spares.
Every query is then an aggregate of these tables, which are of the size of the products or of the users, or smaller.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basket.functions.columns import basket_bucket, bucket_rank, ratio
from basket.operators.facts import over_parts
from basket.plans import catalog
from basket.plans import departments as D
from basket.plans import products as P
from basket.session import run_concurrently, scratch_folder
from basket.sources.schema import SPLITS
from basket.sources.tables import Tables


def _rows() -> Column:
    return F.count(F.lit(1))


def product_cube(items: DataFrame) -> DataFrame:
    """Per split and product: items, sum of ``reordered`` and number of its non-NULL values."""
    return items.groupBy("eval_set", "product_id").agg(
        _rows().alias("n"), F.sum("reordered").alias("again"), F.count("reordered").alias("known")
    )


def basket_cube(tables: Tables) -> DataFrame:
    """Orders by weekday, whether ``orders`` has them, whether they have an id, and items in each split.

    An order id stands once in ``orders`` (its key), so the join adds no rows.
    """
    sizes = [F.count_if(F.col("eval_set") == s).alias(s) for s in SPLITS]
    dated = tables.orders.filter("order_id IS NOT NULL").select("order_id", "order_dow", F.lit(True).alias("dated"))

    def per_order(part: DataFrame) -> DataFrame:
        return part.groupBy("order_id").agg(*sizes).join(dated, "order_id", "left")

    by = [F.col("order_dow"), F.col("dated").isNotNull().alias("dated"), F.col("order_id").isNotNull().alias("named"), *SPLITS]
    return over_parts(tables.item_parts, per_order).groupBy(*by).agg(_rows().alias("orders"))


def order_cube(orders: DataFrame) -> DataFrame:
    return orders.groupBy("eval_set", "order_dow", "order_hour_of_day").agg(_rows().alias("orders"))


def user_counts(orders: DataFrame) -> DataFrame:
    return orders.groupBy("user_id").agg(_rows().alias("num_orders"))


@dataclass(frozen=True)
class Cubes:
    """The stored aggregates, and the two dimensions that name their products."""

    by_product: DataFrame
    by_basket: DataFrame
    by_order: DataFrame
    by_user: DataFrame
    products: DataFrame
    departments: DataFrame

    @property
    def product_facts(self) -> DataFrame:
        sums = [F.sum(c).alias(c) for c in ("n", "again", "known")]
        return self.by_product.groupBy("product_id").agg(*sums)


def build_cubes(spark: SparkSession, tables: Tables, out: str | None = None) -> Cubes:
    """Compute the aggregates and store them below ``out`` (default: the shared scratch folder); the jobs run side by side."""
    folder = out or scratch_folder(spark, "basket-cubes")
    made = {
        "by_product": product_cube(tables.order_items),
        "by_basket": basket_cube(tables),
        "by_order": order_cube(tables.orders),
        "by_user": user_counts(tables.orders),
    }
    run_concurrently(*[lambda df=df, name=name: df.write.mode("overwrite").parquet(f"{folder}/{name}") for name, df in made.items()])
    stored = {name: spark.read.parquet(f"{folder}/{name}") for name in made}
    return Cubes(**stored, products=tables.products, departments=tables.departments)


def _items() -> Column:
    """Items of a row of ``by_basket``."""
    return sum([F.col(s) for s in SPLITS[1:]], F.col(SPLITS[0])) * F.col("orders")


def _baskets() -> Column:
    """Its baskets: an order is one for each split that it has items in."""
    return sum([(F.col(s) > 0).cast("int") for s in SPLITS[1:]], (F.col(SPLITS[0]) > 0).cast("int")) * F.col("orders")


def _kpi(c: Cubes) -> DataFrame:
    num_orders = c.by_order.agg(F.coalesce(F.sum("orders"), F.lit(0))).scalar()
    named = F.coalesce(F.sum(F.when(F.col("named"), F.col("orders"))), F.lit(0))
    return c.by_basket.agg(F.coalesce(F.sum(_items()), F.lit(0)).alias("num_items"), named.alias("named")).select(
        num_orders.alias("num_orders"), "num_items", ratio(F.col("num_items"), F.col("named")).alias("avg_items_per_order")
    )


def _orders_by(c: Cubes, column: str) -> DataFrame:
    return c.by_order.groupBy(column).agg(F.sum("orders").alias("num_orders")).orderBy(F.col(column).asc_nulls_first())


def _avg_items_by_dow(c: Cubes) -> DataFrame:
    means = ratio(F.sum(_items()), F.sum(_baskets())).alias("avg_items")
    return c.by_basket.filter("dated").groupBy("order_dow").agg(means).orderBy(F.col("order_dow").asc_nulls_first())


def _basket_size_buckets(c: Cubes) -> DataFrame:
    sizes = c.by_basket.select("orders", F.explode(F.array(*SPLITS)).alias("size")).filter("size > 0")
    counted = sizes.groupBy(basket_bucket(F.col("size")).alias("bucket")).agg(F.sum("orders").alias("num_orders"))
    return counted.orderBy(bucket_rank(F.col("bucket")))


def _by_split(df: DataFrame, num: dict, den: dict, out: str) -> DataFrame:
    """One row per split label; NULL where a split has no rows."""
    wide = df.agg(*[ratio(F.sum(num[s]), F.sum(den[s])).alias(s) for s in SPLITS])
    return wide.unpivot([], list(SPLITS), "eval_set", out).orderBy("eval_set")


def _avg_items_by_split(c: Cubes) -> DataFrame:
    held = {s: F.when(F.col(s) > 0, F.col("orders")) for s in SPLITS}
    return _by_split(c.by_basket, {s: F.col(s) * held[s] for s in SPLITS}, held, "avg_items")


def _reorder_rate_by_split(c: Cubes) -> DataFrame:
    own = [{s: F.when(F.col("eval_set") == s, F.col(x)) for s in SPLITS} for x in ("again", "known")]
    return _by_split(c.by_product, *own, "reorder_rate")


def _ranked(df: DataFrame, measure: str) -> DataFrame:
    return df.orderBy(F.col(measure).desc(), F.col("eval_set").asc())


_ANSWERS = {
    "kpi": _kpi,
    "top_products": lambda c, n: P.most_bought(c.product_facts, c.products, n),
    "reorder_rate_global": lambda c: c.by_product.agg(ratio(F.sum("again"), F.sum("known")).alias("reorder_rate")),
    "top_reordered_products": lambda c, n, min_count: P.most_reordered(c.product_facts, c.products, n, min_count),
    "sales_by_department": lambda c: D.department_sales(c.product_facts, c.products, c.departments),
    "reorder_rate_by_department": lambda c: D.department_reorders(c.product_facts, c.products, c.departments),
    "orders_by_dow": lambda c: _orders_by(c, "order_dow"),
    "orders_by_hour": lambda c: _orders_by(c, "order_hour_of_day"),
    "avg_items_by_dow": _avg_items_by_dow,
    "basket_size_buckets": _basket_size_buckets,
    "avg_orders_per_user": lambda c: c.by_user.agg(F.avg("num_orders").alias("avg_orders_per_user")),
    "top_users_by_orders": lambda c, n: c.by_user.orderBy(F.col("num_orders").desc(), F.col("user_id").asc()).limit(n),
    "orders_count_by_eval_set": lambda c: _ranked(c.by_order.groupBy("eval_set").agg(F.sum("orders").alias("num_orders")), "num_orders"),
    "items_sold_by_eval_set": lambda c: _ranked(c.by_product.groupBy("eval_set").agg(F.sum("n").alias("num_items")), "num_items"),
    "avg_items_per_order_by_eval_set": _avg_items_by_split,
    "reorder_rate_by_eval_set": _reorder_rate_by_split,
}

KEYS = tuple(_ANSWERS)


def answer(cubes: Cubes, key: str, **params: Any) -> DataFrame:
    """The catalogue query ``key`` from the stored aggregates: the rows that :func:`catalog.run` gives from the tables."""
    return _ANSWERS[key](cubes, **catalog.arguments(key, **params))
