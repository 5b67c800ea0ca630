"""Dataset-wide KPIs (Q1) and the global reorder rate (Q3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basket.functions.columns import as_double, ratio
from basket.operators.facts import Items, over_parts


def kpi_overview(orders: DataFrame, items: Items) -> DataFrame:
    """num_orders (all orders), num_items (all item rows) and items per order, where
    the divisor is the number of distinct orders that have items (an order in both
    splits counts once here).

    One scan of the fact: items are counted per order (a hot order is one row per
    task after the partial aggregate), then summed; the order count is a scalar
    subquery (no join at all).
    """
    num_orders = orders.agg(F.count(F.lit(1))).scalar()
    per_order = over_parts(items, lambda p: p.groupBy("order_id").agg(F.count(F.lit(1)).alias("n")))
    return per_order.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("num_items"), F.count("order_id").alias("orders_with_items")
    ).select(
        num_orders.alias("num_orders"),
        "num_items",
        ratio(F.col("num_items"), F.col("orders_with_items")).alias("avg_items_per_order"),
    )


def kpi_overview_bitmaps(orders: DataFrame, items: DataFrame) -> DataFrame:
    """:func:`kpi_overview` for a fact whose layout says nothing of its orders (the csv layout).

    There a count per order would move a row for each order and task.  Here the distinct orders are counted with
    bitmaps: ids fall into buckets of 32,768, each task sends one bitmap of 4 KB and a count for each of its buckets, and
    they are united by bucket; no order id is ever shuffled.
    """
    num_orders = orders.agg(F.count(F.lit(1))).scalar()
    bucket = F.bitmap_bucket_number("order_id").alias("bucket")
    per_bucket = items.groupBy(bucket).agg(
        F.count(F.lit(1)).alias("n"), F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("order_id"))).alias("distinct")
    )
    return per_bucket.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("num_items"), F.sum(F.when(F.col("bucket").isNotNull(), F.col("distinct"))).alias("own")
    ).select(
        num_orders.alias("num_orders"), "num_items", ratio(F.col("num_items"), F.coalesce("own", F.lit(0))).alias("avg_items_per_order")
    )


def reorder_rate_global(items: DataFrame) -> DataFrame:
    """Mean of ``reordered`` over all items (NULLs skipped); one row, NULL when empty."""
    return items.agg(F.avg(as_double("reordered")).alias("reorder_rate"))
