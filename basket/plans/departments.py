"""Department views (Q5, Q6).

Both aggregate the fact per product first (one partially aggregated shuffle of
product ids), join the two dimensions to that product-sized result and
aggregate again per department.  Items whose product or department is unknown
drop out (inner joins); the percent base is the joined total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basket.functions.columns import ratio
from basket.operators.facts import product_facts
from basket.operators.shares import with_share


def _with_departments(per_product: DataFrame, products: DataFrame, departments: DataFrame) -> DataFrame:
    return per_product.join(products.select("product_id", "department_id"), "product_id").join(
        departments.select("department_id", "department"), "department_id"
    )


def department_sales(facts: DataFrame, products: DataFrame, departments: DataFrame) -> DataFrame:
    """Items and their share by department, from per-product ``facts``."""
    per_dept = (
        _with_departments(facts.select("product_id", "n"), products, departments)
        .groupBy("department_id", "department")
        .agg(F.sum("n").alias("items_sold"))
    )
    return (
        with_share(per_dept, "items_sold", "pct")
        .select("department_id", "department", "items_sold", "pct")
        .orderBy(F.col("items_sold").desc(), F.col("department_id").asc())
    )


def department_reorders(facts: DataFrame, products: DataFrame, departments: DataFrame) -> DataFrame:
    """Mean ``reordered`` (NULLs skipped: sum / count of non-NULL) and item count, from per-product ``facts``."""
    return (
        _with_departments(facts, products, departments)
        .groupBy("department_id", "department")
        .agg(ratio(F.sum("again"), F.sum("known")).alias("reorder_rate"), F.sum("n").alias("items"))
        .orderBy(F.col("reorder_rate").desc(), F.col("items").desc(), F.col("department_id").asc())
    )


def sales_by_department(items: DataFrame, products: DataFrame, departments: DataFrame) -> DataFrame:
    return department_sales(product_facts(items), products, departments)


def reorder_rate_by_department(items: DataFrame, products: DataFrame, departments: DataFrame) -> DataFrame:
    return department_reorders(product_facts(items), products, departments)
