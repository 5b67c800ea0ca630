"""Product rankings (Q2, Q4).  Both start from the shared per-product aggregate and
join names to that product-sized result; items of unknown products drop out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basket.functions.columns import ratio
from basket.operators.facts import product_facts


def _named(facts: DataFrame, products: DataFrame) -> DataFrame:
    return facts.join(products.select("product_id", "product_name"), "product_id")


def most_bought(facts: DataFrame, products: DataFrame, n: int) -> DataFrame:
    """The n products with most items in per-product ``facts``, ties by product_id.

    Counts are summed again per (id, name) so a duplicated product row counts
    twice, as joining first would.  Sort + limit plans as a top-k.
    """
    return (
        _named(facts.select("product_id", "n"), products)
        .groupBy("product_id", "product_name")
        .agg(F.sum("n").alias("times_bought"))
        .orderBy(F.desc("times_bought"), "product_id")
        .limit(int(n))
    )


def most_reordered(facts: DataFrame, products: DataFrame, n: int, min_count: int) -> DataFrame:
    rated = facts.where(F.col("n") >= int(min_count)).withColumn("rate", ratio(F.col("again"), F.col("known")))
    ranked = _named(rated, products).orderBy(F.desc("rate"), F.desc("n"), "product_id").limit(int(n))
    return ranked.select("product_id", "product_name", F.col("n").alias("times_bought"), F.col("rate").alias("reorder_rate"))


def top_products(items: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """The n most bought products, ties by product_id."""
    return most_bought(product_facts(items), products, n)


def top_reordered_products(items: DataFrame, products: DataFrame, n: int = 10, min_count: int = 200) -> DataFrame:
    """The n products with the highest reorder rate among those bought at least
    ``min_count`` times (inclusive, counted before the name join); ties by times bought, then product_id."""
    return most_reordered(product_facts(items), products, n, min_count)
