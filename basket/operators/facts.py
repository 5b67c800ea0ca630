"""Fact-level building blocks.

The stored fact may come in parts whose orders are disjoint (the bucketed table
and the items of very large orders beside it), so per-order aggregates are taken
part by part and put together: each part keeps its own partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Items = DataFrame | Sequence[DataFrame]


def over_parts(items: Items, function: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``function`` of each part, all rows together; for functions that work order by order."""
    parts = [items] if isinstance(items, DataFrame) else list(items)
    return reduce(DataFrame.unionByName, [function(p) for p in parts])


def whole(items: Items) -> DataFrame:
    """All items, for aggregates that do not group by order."""
    return over_parts(items, lambda p: p)


def basket_sizes(items: Items) -> DataFrame:
    """Items per basket, a basket being (split, order): an order present in both
    splits is two baskets, as when each split table is grouped on its own."""
    return over_parts(items, lambda p: p.groupBy("eval_set", "order_id").agg(F.count(F.lit(1)).alias("num_items")))


def product_facts(items: DataFrame) -> DataFrame:
    """Per product: items, sum of ``reordered`` and number of its non-NULL values.

    A partial-then-final hash aggregate: a best-seller never moves as raw rows.
    The product and department queries all start from it.
    """
    return items.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("reordered").alias("again"), F.count("reordered").alias("known")
    )
