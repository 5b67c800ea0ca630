"""Order timing, basket sizes, user activity and per-split views (Q7-Q16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basket.functions.columns import as_double, basket_bucket, bucket_rank, ratio
from basket.operators.facts import Items, basket_sizes, over_parts
from basket.sources.schema import SPLITS


# --- time of order (Q7, Q8, Q9) ---------------------------------------------


def orders_by_dow(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("order_dow")
        .agg(F.count(F.lit(1)).alias("num_orders"))
        .orderBy(F.col("order_dow").asc_nulls_first())
    )


def orders_by_hour(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("order_hour_of_day")
        .agg(F.count(F.lit(1)).alias("num_orders"))
        .orderBy(F.col("order_hour_of_day").asc_nulls_first())
    )


def avg_items_by_dow(orders: DataFrame, items: Items) -> DataFrame:
    """Mean basket size per weekday; orders without items do not count.

    A basket is (split, order).  Items are counted per order with one count per
    split (partial aggregation and one shuffle on order_id; no shuffle at all on
    the bucketed layout); the result is partitioned on order_id, so joining
    orders moves at most the orders side.  The
    mean is sum(items) / number of baskets, the same integers the per-basket
    average divides.
    """
    # The fact holds the two split tables: an order is one basket per split it
    # appears in.  Numeric flags keep the aggregate a (codegen) hash aggregate.
    in_split = [F.max((F.col("eval_set") == s).cast("int")) for s in SPLITS]
    dated = orders.select("order_id", "order_dow")

    def per_order(part: DataFrame) -> DataFrame:
        counted = part.groupBy("order_id").agg(
            F.count(F.lit(1)).alias("n"), sum(in_split[1:], in_split[0]).alias("baskets")
        )
        return counted.join(dated, "order_id")

    return (
        over_parts(items, per_order)
        .groupBy("order_dow")
        .agg(ratio(F.sum("n"), F.sum("baskets")).alias("avg_items"))
        .orderBy(F.col("order_dow").asc_nulls_first())
    )


# --- basket sizes (Q10) -------------------------------------------------------


def basket_size_buckets(items: Items) -> DataFrame:
    """Baskets per size bucket, in bucket order; empty buckets give no row."""
    return (
        basket_sizes(items)
        .select(basket_bucket(F.col("num_items")).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("num_orders"))
        .orderBy(bucket_rank(F.col("bucket")))
    )


# --- users (Q11, Q12) ---------------------------------------------------------


def avg_orders_per_user(orders: DataFrame) -> DataFrame:
    per_user = orders.groupBy("user_id").agg(F.count(F.lit(1)).alias("num_orders"))
    return per_user.agg(F.avg("num_orders").alias("avg_orders_per_user"))


def top_users_by_orders(orders: DataFrame, n: int = 10) -> DataFrame:
    return (
        orders.groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("num_orders"))
        .orderBy(F.col("num_orders").desc(), F.col("user_id").asc())
        .limit(int(n))
    )


# --- splits (Q13-Q16) ---------------------------------------------------------


def orders_by_eval_set(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("eval_set")
        .agg(F.count(F.lit(1)).alias("num_orders"))
        .orderBy(F.col("num_orders").desc(), F.col("eval_set").asc())
    )


def items_by_eval_set(items: DataFrame) -> DataFrame:
    """Item rows per split table; a split without rows has no row."""
    return (
        items.groupBy("eval_set")
        .agg(F.count(F.lit(1)).alias("num_items"))
        .orderBy(F.col("num_items").desc(), F.col("eval_set").asc())
    )


def _per_split(df: DataFrame, value: str, out: str) -> DataFrame:
    """One row per split label (prior, train), NULL where a split has no rows.

    Conditional averages in a single global aggregate, then unpivoted: one pass,
    no join, and the empty split still gets its row.
    """
    aggs = [F.avg(F.when(F.col("eval_set") == s, as_double(value))).alias(s) for s in SPLITS]
    wide = df.agg(*aggs)
    return wide.unpivot([], list(SPLITS), "eval_set", out).orderBy("eval_set")


def avg_items_by_eval_set(items: Items) -> DataFrame:
    return _per_split(basket_sizes(items), "num_items", "avg_items")


def reorder_rate_by_eval_set(items: DataFrame) -> DataFrame:
    return _per_split(items, "reordered", "reorder_rate")
