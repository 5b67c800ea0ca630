"""Derive the basket tables from the TPC-H-style test tables.

Mapping (FIXTURES.md section 2):

* an order is an ``orders`` row; user = customer; ``order_number`` is the position of
  the order in its customer's history ordered by (date, key); the customer's last
  order is ``test`` when ``user_id % 3 = 0`` else ``train``, every other order is
  ``prior``; weekday from the date (0 = Sunday); the hour is synthetic
  ``(order_id * 7 + user_id) % 24``; days since the previous order of the customer.
* a product is a distinct ``p_name`` ("adjective noun"); its aisle is the
  adjective and its department the noun; ids are dense ranks of the names.
* an item is a ``lineitem`` row of a prior or train order; ``reordered`` is 1 when
  the user bought the product in an earlier order.

Scale notes.  The per-customer history is one shuffle on the customer; a customer
with very many orders is split over many tasks instead (:func:`sequence_by_group`).  ``reordered`` compares each item with the minimum order number
of its (user, product), a window over the lines, which move once for it; pairs above a row
threshold get it by a bounded broadcast instead (see :func:`mark_reorders`).  The line-item
joins on order and part keys are shuffle-vs-shuffle sort-merge joins, which AQE's
skew handling splits.  Dimension joins are left to AQE, which broadcasts a side
only once its measured size is under the threshold and keeps the sort-merge join
otherwise.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basket.operators.sequence import dense_ids_by, sequence_by_group
from basket.session import ensure_checkpoint_dir, run_concurrently, scratch_folder
from basket.sources import schema as S
from basket.sources.tables import Tables, load_tables, save_tables


def read_star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def star_orders(orders_raw: DataFrame) -> DataFrame:
    o = orders_raw.select(
        F.col("o_orderkey").cast("long").alias("order_id"),
        F.col("o_custkey").cast("long").alias("user_id"),
        F.col("o_orderdate").alias("order_date"),
    )
    s = sequence_by_group(o, ["user_id"], ["order_date", "order_id"], lag_cols=["order_date"])
    return s.select(
        "order_id",
        "user_id",
        F.when(~F.col("is_last"), F.lit(S.PRIOR))
        .when(F.col("user_id") % 3 == 0, F.lit(S.TEST))
        .otherwise(F.lit(S.TRAIN))
        .alias("eval_set"),
        F.col("seq").cast("int").alias("order_number"),
        (F.dayofweek("order_date") - 1).cast("int").alias("order_dow"),
        ((F.col("order_id") * 7 + F.col("user_id")) % 24).cast("int").alias("order_hour_of_day"),
        F.datediff(F.col("order_date"), F.col("prev_order_date")).cast("double").alias("days_since_prior_order"),
    )


def star_products(part: DataFrame) -> DataFrame:
    names = part.select(F.col("p_name").alias("product_name")).distinct()
    named = names.select(
        "product_name",
        F.split_part("product_name", F.lit(" "), F.lit(1)).alias("aisle"),
        F.split_part("product_name", F.lit(" "), F.lit(2)).alias("department"),
    )
    # The three dictionaries are ranked together, one sequence per kind.
    words = named.select(
        F.explode(
            F.array(
                F.struct(F.lit("product").alias("kind"), F.col("product_name").alias("value")),
                F.struct(F.lit("aisle").alias("kind"), F.col("aisle").alias("value")),
                F.struct(F.lit("department").alias("kind"), F.col("department").alias("value")),
            )
        ).alias("w")
    ).select("w.kind", "w.value")
    ids = dense_ids_by(words, "kind", "value", "id")

    def ids_of(kind: str, name: str, id_name: str) -> DataFrame:
        return ids.filter(F.col("kind") == kind).select(F.col("value").alias(name), F.col("id").alias(id_name))

    return (
        named.join(ids_of("product", "product_name", "product_id"), "product_name")
        .join(ids_of("aisle", "aisle", "aisle_id"), "aisle")
        .join(ids_of("department", "department", "department_id"), "department")
        .select(
            F.col("product_id").cast("long"),
            "product_name",
            F.col("aisle_id").cast("int"),
            "aisle",
            F.col("department_id").cast("int"),
            "department",
        )
    )


def star_lines(lineitem: DataFrame, part: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Line items of prior and train orders with their product, user and order number."""
    part_product = part.select(F.col("p_partkey").alias("partkey"), F.col("p_name").alias("product_name")).join(
        products.select("product_name", "product_id"), "product_name"
    )
    lines = lineitem.select(
        F.col("l_orderkey").cast("long").alias("order_id"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_linenumber").cast("int").alias("add_to_cart_order"),
    )
    kept = (F.col("eval_set") != S.TEST) & F.col("user_id").isNotNull()
    kept_orders = orders.filter(kept).select("order_id", "user_id", "order_number", "eval_set")
    # The products first: a line is three numbers then, and it ends up beside the other lines of its order.
    bought = lines.join(part_product.select("partkey", "product_id"), "partkey").drop("partkey")
    return bought.join(kept_orders, "order_id")


# Fixed value: a (user, product) pair with more line items than this is "hot".
HOT_PAIR_ROWS = 1_000_000


def pair_facts(lines: DataFrame) -> DataFrame:
    """Per (user, product): the first order number and the number of lines."""
    return lines.groupBy("user_id", "product_id").agg(
        F.min("order_number").alias("first_number"), F.count(F.lit(1)).alias("_n")
    )


def busy_pair_facts(lines: DataFrame, hot_pair_rows: int = HOT_PAIR_ROWS) -> DataFrame:
    """:func:`pair_facts` of the users with more than ``hot_pair_rows`` lines; no other user has a hot pair.

    There are at most ``rows / hot_pair_rows`` of them, so they are broadcast, and ordinarily none.
    """
    users = lines.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_pair_rows)
    return pair_facts(lines.join(F.broadcast(users.select("user_id")), "user_id", "left_semi"))


def mark_reorders(
    lines: DataFrame, hot_pair_rows: int = HOT_PAIR_ROWS, stats: DataFrame | None = None, partitions: int | None = None
) -> DataFrame:
    """Items with ``reordered``: the order number is above the user's first order
    number for that product.

    The first order number is a window's minimum over (user, product), so that the
    lines move once and meet no second table of their size.  A pair holding more
    than ``hot_pair_rows`` items would put all of them in one window task, so those
    pairs get their first number by broadcast instead; there
    are at most ``rows / hot_pair_rows`` of them, so the broadcast is bounded.
    ``stats`` is :func:`busy_pair_facts` of the lines (or :func:`pair_facts`), where that is stored already;
    ``partitions`` the number of window tasks, where the caller knows the rows.
    """
    pair = ["user_id", "product_id"]
    # A line without a user or a product belongs to no pair.
    known = lines.dropna(subset=pair)
    stats = busy_pair_facts(known, hot_pair_rows) if stats is None else stats
    hot = stats.filter(F.col("_n") > hot_pair_rows).select(*pair, F.col("first_number").alias("_hot_first"))
    tagged = known.join(F.broadcast(hot), pair, "left")
    hot_items = tagged.filter(F.col("_hot_first").isNotNull()).withColumn("first_number", F.col("_hot_first"))
    cold_items = tagged.filter(F.col("_hot_first").isNull())
    if partitions:
        cold_items = cold_items.repartition(int(partitions), *pair)
    cold_items = cold_items.withColumn("first_number", F.min("order_number").over(Window.partitionBy(*pair)))
    return hot_items.unionByName(cold_items).select(
        "order_id",
        "product_id",
        "add_to_cart_order",
        (F.col("order_number") > F.col("first_number")).cast("int").alias("reordered"),
        "eval_set",
    )


def star_items(lineitem: DataFrame, part: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    return mark_reorders(star_lines(lineitem, part, orders, products))


def from_star(spark: SparkSession, sf_dir: str) -> Tables:
    """The basket bundle derived from the star tables under ``sf_dir`` (lazy,
    except for the checkpoints of the ordered numbering)."""
    part = read_star(spark, sf_dir, "part")
    orders, products_full = _orders_and_products(spark, sf_dir, part)
    items = star_items(read_star(spark, sf_dir, "lineitem"), part, orders, products_full)
    return _bundle(orders, items, products_full)


def _orders_and_products(spark: SparkSession, sf_dir: str, part: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The order history and the product dictionaries are independent; their
    (checkpointing) jobs are submitted side by side."""
    ensure_checkpoint_dir(spark)
    orders_raw = read_star(spark, sf_dir, "orders")
    orders, products_full = run_concurrently(lambda: star_orders(orders_raw), lambda: star_products(part))
    return orders, products_full


def _bundle(orders: DataFrame, items: DataFrame, products_full: DataFrame) -> Tables:
    return Tables(
        orders=orders,
        order_items=items,
        products=products_full.select("product_id", "product_name", "aisle_id", "department_id"),
        aisles=products_full.select("aisle_id", "aisle").distinct(),
        departments=products_full.select("department_id", "department").distinct(),
    )


# Items per order_id bucket of the stored fact; a small fact is cut further, down to
# the least, while there are idle cores.
ITEMS_PER_BUCKET, LEAST_ITEMS_PER_BUCKET = 4_000_000, 50_000


# Fixed value: lines sorted by one window task, so that none spills whatever the session's partition count is.
LINES_PER_TASK = 1_000_000


def auto_buckets(items: int, cores: int) -> int:
    """Bucket count from the fact size.  Only speed depends on it, never results."""
    return max(1, -(-int(items) // ITEMS_PER_BUCKET), min(int(cores), int(items) // LEAST_ITEMS_PER_BUCKET))


def build_star_tables(spark: SparkSession, sf_dir: str, out_path: str, buckets: int | str | None = "auto") -> Tables:
    """Derive the bundle and store it (the one-off ETL); returns the stored tables.

    The joined lines feed the counts of hot pairs and hot orders and the (user, product) window: they are
    written once to a scratch folder in the shared checkpoint folder
    and read back, so a lost executor recomputes no join.  ``buckets``:
    the fact and orders are stored bucketed by order_id ("auto" sizes the count
    from the number of items; None stores them plain).
    """
    part = read_star(spark, sf_dir, "part")
    orders, products_full = _orders_and_products(spark, sf_dir, part)
    staging = scratch_folder(spark, "basket-staging")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{staging}/{name}")
        return spark.read.parquet(f"{staging}/{name}")

    orders = stored(orders, "orders")
    lines = stored(star_lines(read_star(spark, sf_dir, "lineitem"), part, orders, products_full), "lines")
    rows, cores = lines.count(), spark.sparkContext.defaultParallelism
    if buckets == "auto":
        buckets = auto_buckets(rows, cores)
    tasks = max(auto_buckets(rows, cores), -(-rows // LINES_PER_TASK))
    items = mark_reorders(lines, stats=stored(busy_pair_facts(lines), "pairs"), partitions=tasks)
    save_tables(_bundle(orders, items, products_full), out_path, buckets=buckets, item_orders=lines.select("order_id"))
    return load_tables(spark, out_path, "parquet")
