"""Column expressions shared by the queries (all built-in, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Basket-size buckets, (label, upper bound inclusive), in rank order;
# the last bucket has no upper bound.
BUCKETS = (("1-5", 5), ("6-10", 10), ("11-20", 20), ("21+", None))


def basket_bucket(size: Column) -> Column:
    expr = None
    for label, upper in BUCKETS:
        if upper is None:
            return expr.otherwise(F.lit(label))
        cond = size <= upper
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def bucket_rank(bucket: Column) -> Column:
    expr = None
    for rank, (label, _) in enumerate(BUCKETS, start=1):
        expr = F.when(bucket == label, F.lit(rank)) if expr is None else expr.when(bucket == label, F.lit(rank))
    return expr


def ratio(num: Column, den: Column) -> Column:
    """num / den as double; NULL (not an error) when den is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def as_double(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")
