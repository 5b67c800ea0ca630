"""

Every query reads the driver's star tables (``orders``, ``lineitem``, ``part``)
under ``sf_dir``: the basket tables are derived from them with Spark
(``basket.sources.star.build_star_tables``) and written once per application into
the session's shared checkpoint folder, and each query then runs one catalogue
query over the whole of them -- the same path as ``bench.py`` and the CLI.  The
``*_table`` entries check the derived tables themselves.
``oracle_sql`` gives the same computation in DuckDB SQL: the derivation as CTEs,
then the query.  The k-means labels themselves have no SQL twin; what must hold for any
correct run (scaling, nearest centres, profile totals) is queried and has one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from importlib.util import find_spec

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basket.operators.facts import basket_sizes
from basket.operators.sampling import sample_predicate, threshold
from basket.operators.sketches import distinct_sketches, error_bound, estimate, merge_sketches
from basket.plans import catalog, cubes
from basket.plans import segments as G
from basket.session import scratch_folder
from basket.sources.star import build_star_tables
from basket.sources.tables import (
    Tables, cached_tables, load_quarantined, load_tables, quarantine, quarantined, register_views, save_csv,
)

SMOKE_DIR = "/root/testdata/sf0.001"

# Averages of averages depend on summation order; both sides round them.
DIGITS = 9

_cache: dict[tuple[str, str], Tables] = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The derived basket tables, built and stored once per application and directory."""
    key = (spark.conf.get("spark.app.id", str(id(spark))), sf_dir)
    if key not in _cache:
        _cache[key] = build_star_tables(spark, sf_dir, scratch_folder(spark, "basket-tables"))
    return _cache[key]


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the ten most bought products on the sf0.001 tables."""
    return catalog.run(tables(spark, SMOKE_DIR), "top_products", n=10)


def _q(key: str, **params) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: catalog.run(tables(spark, sf_dir), key, **params)


_report_cache: dict[tuple[str, str], cubes.Cubes] = {}


def _report(key: str) -> Callable[[SparkSession, str], DataFrame]:
    """A query of the batch report, from its aggregates, which are stored once per application and directory."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        own = (spark.conf.get("spark.app.id", str(id(spark))), sf_dir)
        if own not in _report_cache:
            _report_cache[own] = cubes.build_cubes(spark, tables(spark, sf_dir))
        return cubes.answer(_report_cache[own], key)

    return query


def _rounded(f: DataFrame) -> DataFrame:
    return f.select("user_id", *[F.round(c, DIGITS).alias(c) for c in G.FEATURES])


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    return _rounded(G.user_features(t.orders, t.item_parts, t.products))


def _features_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    kept = sample_predicate(t.orders, "user_id", 0.3, 42, step=G.USER_STEP)
    return _rounded(G.user_features(t.orders, t.item_parts, t.products, user_filter=kept))


def _training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of a 0.3 sample that a 0.5 sample of their own keeps for the fit."""
    t = tables(spark, sf_dir)
    kept = sample_predicate(t.orders, "user_id", 0.3, 42, step=G.USER_STEP)
    feats = G.user_features(t.orders, t.item_parts, t.products, user_filter=kept)
    return G.training_rows(feats, 5, 0.5, 42).select("user_id")


def _fit(spark: SparkSession, sf_dir: str):
    t = tables(spark, sf_dir)
    return G.fitted(t.orders, t.item_parts, t.products)


def _scaling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deviations the fitted model scales with, beside the feature names (six rows)."""
    scales = G.feature_scales(_fit(spark, sf_dir)[1])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(round(v, 6)).alias("std")) for c, v in scales.items()]))
    # From the fitted rows, so that an empty fit gives no row.
    return _fit(spark, sf_dir)[1].train.limit(1).select(rows.alias("r")).select("r.feature", "r.std")


# Centres (raw units) for the checkable assignment.
CENTRES = [[5.0, 200.0, 8.0, 3.0, 0.1, 4.0], [15.0, 150.0, 12.0, 4.0, 0.2, 7.0], [25.0, 80.0, 14.0, 5.0, 0.3, 8.0]]


def _assign_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    feats = G.user_features(t.orders, t.item_parts, t.products)
    near = G.nearest_centre(feats, CENTRES, dict.fromkeys(G.FEATURES, 1.0))
    return near.select("user_id", "nearest", F.round("distance", 6).alias("distance"))


def _assignment_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled users, clusters, and users whose label is not their nearest centre."""
    feats, seg = _fit(spark, sf_dir)
    centres = [list(map(float, c)) for c in seg.model.stages[-1].clusterCenters()]
    near = G.nearest_centre(seg.train, centres, G.feature_scales(seg)).select("user_id", "nearest", "distance")
    raw = seg.model.transform(seg.train).select("user_id", "raw_cluster").join(G.assign_segments(seg, seg.train), "user_id")
    own = F.element_at(F.array(*[F.lit(i) for i in range(len(centres))]), F.col("raw_cluster") + 1)
    return raw.join(near, "user_id").agg(
        F.count(F.lit(1)).alias("users"),
        F.count_distinct("cluster").alias("clusters"),
        F.coalesce(F.sum((own != F.col("nearest")).cast("long")), F.lit(0)).alias("violations"),
    )


def _profile_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile put together again: all users and the overall means."""
    prof = _q("kmeans_user_cluster_profile")(spark, sf_dir)
    users = F.sum("users")
    means = [c for c in prof.columns if c.startswith("avg_")]
    return prof.agg(users.alias("users"), *[F.round(F.sum(F.col(c) * F.col("users")) / users, 6).alias(c) for c in means])


def _csv_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after a round trip through the csv layout."""
    out = scratch_folder(spark, "basket-csv")
    save_csv(tables(spark, sf_dir), out)
    return load_tables(spark, out, "csv").order_items


def _views_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales by department in SQL over the registered views."""
    register_views(tables(spark, sf_dir))
    return spark.sql(
        """SELECT department_id, department, items_sold,
             CAST(items_sold AS DOUBLE) * 100.0 / (SELECT count(*) FROM order_items JOIN products USING (product_id)) AS pct
           FROM (SELECT p.department_id, d.department, count(*) AS items_sold
                 FROM order_items i JOIN products p ON i.product_id = p.product_id
                   JOIN departments d ON p.department_id = d.department_id
                 GROUP BY p.department_id, d.department)"""
    )


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: it outlives what it was computed from."""
    out = f"{scratch_folder(df.sparkSession, name)}/rows"
    df.write.parquet(out)
    return df.sparkSession.read.parquet(out)


def _cached(key: str) -> Callable[[SparkSession, str], DataFrame]:
    """A catalogue query over the cached bundle, which is released before the result is returned."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        with cached_tables(tables(spark, sf_dir)) as t:
            return _stored(catalog.run(t, key), "basket-cached")

    return query


def _csv_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 on the csv layout, where orders are counted with bitmaps."""
    out = scratch_folder(spark, "basket-csv")
    save_csv(tables(spark, sf_dir), out)
    return catalog.run(load_tables(spark, out, "csv"), "kpi")


def _csv_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per file: good rows, corrupt lines and the sum of the order ids in these, of a csv layout with planted errors."""
    t, out = tables(spark, sf_dir), scratch_folder(spark, "basket-csv-bad")
    save_csv(t, f"{out}/csv")

    def plant(name: str, rows: DataFrame, column: str) -> None:
        broken = rows.withColumn(column, F.concat(F.lit("x"), F.col(column).cast("string")))
        broken.write.mode("append").option("header", True).csv(f"{out}/csv/{name}")

    plant("orders.csv", t.orders.filter("order_id % 50 = 0"), "user_id")
    plant("order_products__prior.csv", t.op_prior.filter("order_id % 40 = 0"), "add_to_cart_order")
    counts = quarantine(spark, f"{out}/csv", f"{out}/split")
    own = F.split("record", ",")[0].cast("long")
    found = quarantined(spark, f"{out}/split").groupBy("file").agg(F.sum(own).alias("bad_orders"))
    kept = load_quarantined(spark, f"{out}/split")
    good = [kept.orders.agg(F.lit("orders.csv").alias("file"), F.sum("order_id").alias("good_orders"))]
    for name, split in (("order_products__prior.csv", kept.op_prior), ("order_products__train.csv", kept.op_train)):
        good.append(split.agg(F.lit(name).alias("file"), F.sum("order_id").alias("good_orders")))
    return counts.join(found, "file", "left").join(good[0].union(good[1]).union(good[2]), "file", "left")


def _order_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per department: exact, whether the splits' stored sketches, united, are near it and equal to a sketch of all."""
    t = tables(spark, sf_dir)
    facts = t.order_items.join(t.products, "product_id").select("eval_set", "department_id", "order_id")
    per_split = _stored(distinct_sketches(facts, ["eval_set", "department_id"], "order_id"), "basket-sketches")

    def united(sketches: DataFrame, name: str) -> DataFrame:
        # Each sketch twice: a union of large ones is estimated from its registers alone, whatever their order was.
        twice = sketches.select("department_id", "sketch")
        return merge_sketches(twice.unionByName(twice), ["department_id"]).select("department_id", estimate().alias(name))

    whole = _stored(distinct_sketches(facts, ["department_id"], "order_id"), "basket-sketches")
    exact = facts.groupBy("department_id").agg(F.count_distinct("order_id").alias("orders"))
    return exact.join(united(per_split, "united"), "department_id").join(united(whole, "at_once"), "department_id").select(
        "department_id",
        "orders",
        (F.abs(F.col("united") - F.col("orders")) <= error_bound("orders")).alias("within_bound"),
        (F.col("united") == F.col("at_once")).alias("merges"),
    )


def _active(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    return G.training_rows(G.user_features(t.orders, t.item_parts, t.products))


def _stationary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per cluster of a fit that runs until no centre moves: the centre's distance from its members' mean, and the cost test."""
    found = G.certificate(G.fit_segments(_active(spark, sf_dir), max_iter=500, tol=0.0))
    return found.select("cluster", F.round("gap", 6).alias("gap"), "improves")


ROUNDS = 8


def _from_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active users with their cluster after ``ROUNDS`` of Lloyd's iterations from ``CENTRES``."""
    # Stored: the rounds and the labels read the features several times.
    active = _stored(_active(spark, sf_dir), "basket-active")
    return G.label_nearest(active, *G.lloyd_from(active, CENTRES, ROUNDS))


def _from_centres_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    prof = G.profile_segments(_from_centres(spark, sf_dir))
    return prof.select("cluster", "users", *[F.round(c, 6).alias(c) for c in prof.columns if c.startswith("avg_")])


def _saved_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fit saved, loaded and profiled: clusters, and those whose profile differs from that of the fit itself."""
    seg = _fit(spark, sf_dir)[1]
    out = scratch_folder(spark, "basket-model")
    G.save_segments(seg, out)
    back = G.load_segments(spark, out)
    one, two = (G.profile_segments(G.label_segments(x, x.train)) for x in (seg, back))
    same = [F.round(one[c], 9).eqNullSafe(F.round(two[c], 9)) for c in one.columns if c != "cluster"]
    equal = reduce(Column.__and__, same)
    return one.join(two, "cluster", "full").agg(
        F.count(F.lit(1)).alias("clusters"), F.coalesce(F.sum((~equal).cast("long")), F.lit(0)).alias("differing")
    )


def _fixed_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile of the fixed assignment cluster = user_id % 5 (oracle-checkable)."""
    t = tables(spark, sf_dir)
    f = G.user_features(t.orders, t.item_parts, t.products)
    prof = G.profile_segments(f.withColumn("cluster", (F.col("user_id") % 5).cast("int")))
    return prof.select(
        "cluster", "users", *[F.round(c, DIGITS).alias(c) for c in prof.columns if c.startswith("avg_")]
    )


def _table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: getattr(tables(spark, sf_dir), name)


def _sampled_users(max_users: int | None = None) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: G.sample_users(tables(spark, sf_dir).orders, 0.3, 42, max_users)


def _llm():
    """The training-data queries: (queries, SQL), empty when that subpackage or a package it needs is not there."""
    spec = find_spec("basket.llm")
    if spec is None or spec.origin is None:  # no folder, or one without sources
        return {}, {}
    try:
        import corpus_pipeline
        from basket.llm import registry
    except ModuleNotFoundError as e:
        if (e.name or "").split(".")[0] not in ("corpus_pipeline", "public_tokenizers", "numpy", "pyarrow"):
            raise
        return {}, {}
    found, sql = registry.queries(), registry.oracle_sql()
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL is not None:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_catalogue_queries(), **_llm()[0]}


def _catalogue_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # derived tables (the loader / adapter)
        "orders_table": _table("orders"),
        "order_items_table": _table("order_items"),
        "op_prior_table": _table("op_prior"),
        "op_train_table": _table("op_train"),
        "products_table": _table("products"),
        "aisles_table": _table("aisles"),
        "departments_table": _table("departments"),
        "basket_sizes": lambda spark, d: basket_sizes(tables(spark, d).item_parts),
        "csv_items": _csv_items,
        "views_sales_by_department": _views_sales,
        "csv_kpi": _csv_kpi,
        "csv_bad_records": _csv_bad_records,
        "cached_kpi": _cached("kpi"),
        "cached_departments": _cached("sales_by_department"),
        "department_order_sketches": _order_sketches,
        # the catalogue, default parameters
        "kpi": _q("kpi"),
        "top_products": _q("top_products"),
        "reorder_rate_global": _q("reorder_rate_global"),
        "top_reordered_products": _q("top_reordered_products"),
        "sales_by_department": _q("sales_by_department"),
        "reorder_rate_by_department": _q("reorder_rate_by_department"),
        "orders_by_dow": _q("orders_by_dow"),
        "orders_by_hour": _q("orders_by_hour"),
        "avg_items_by_dow": _q("avg_items_by_dow"),
        "basket_size_buckets": _q("basket_size_buckets"),
        "avg_orders_per_user": _q("avg_orders_per_user"),
        "top_users_by_orders": _q("top_users_by_orders"),
        "orders_count_by_eval_set": _q("orders_count_by_eval_set"),
        "items_sold_by_eval_set": _q("items_sold_by_eval_set"),
        "avg_items_per_order_by_eval_set": _q("avg_items_per_order_by_eval_set"),
        "reorder_rate_by_eval_set": _q("reorder_rate_by_eval_set"),
        # the batch report: the same queries from aggregates of two scans of the fact
        **{f"report_{key}": _report(key) for key in cubes.KEYS},
        # other parameters
        "top_products_n25": _q("top_products", n=25),
        "top_reordered_products_n20_min100": _q("top_reordered_products", n=20, min_count=100),
        "top_users_by_orders_n25": _q("top_users_by_orders", n=25),
        # segmentation
        "user_features": _features,
        "segment_profile_fixed": _fixed_profile,
        "user_features_sampled": _features_sampled,
        "sampled_users": _sampled_users(),
        "sampled_users_capped": _sampled_users(50),
        "training_rows_sampled": _training_rows,
        "segment_scaling": _scaling,
        "segment_assign_fixed": _assign_fixed,
        "kmeans_assignment_check": _assignment_check,
        "kmeans_profile_totals": _profile_totals,
        "kmeans_stationary": _stationary,
        "kmeans_from_centres": lambda spark, d: _from_centres(spark, d).select("user_id", "cluster"),
        "kmeans_from_centres_cluster0": lambda spark, d: _from_centres(spark, d).filter("cluster = 0").select("user_id", "cluster"),
        "kmeans_from_centres_profile": _from_centres_profile,
        "kmeans_saved_profile": _saved_profile,
        "kmeans_user_clusters": _q("kmeans_user_clusters"),
        "kmeans_user_clusters_cluster0": _q("kmeans_user_clusters", cluster=0),
        "kmeans_user_cluster_profile": _q("kmeans_user_cluster_profile"),
    }


# ---------------------------------------------------------------------------
# DuckDB oracle: the derivation of FIXTURES.md section 2 as CTEs.

_BASE = """
WITH o AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS order_number,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn_desc,
    lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev_date
  FROM orders),
b_orders AS (
  SELECT order_id, user_id,
    CASE WHEN rn_desc > 1 THEN 'prior' WHEN user_id % 3 = 0 THEN 'test' ELSE 'train' END AS eval_set,
    CAST(order_number AS INT) AS order_number,
    CAST(extract(dow FROM o_orderdate) AS INT) AS order_dow,
    CAST((order_id * 7 + user_id) % 24 AS INT) AS order_hour_of_day,
    CAST(date_diff('day', prev_date, o_orderdate) AS DOUBLE) AS days_since_prior_order
  FROM o),
b_products AS (
  SELECT CAST(dense_rank() OVER (ORDER BY p_name) AS BIGINT) AS product_id, p_name AS product_name,
    CAST(dense_rank() OVER (ORDER BY adj) AS INT) AS aisle_id, adj AS aisle,
    CAST(dense_rank() OVER (ORDER BY noun) AS INT) AS department_id, noun AS department
  FROM (SELECT DISTINCT p_name, split_part(p_name, ' ', 1) AS adj, split_part(p_name, ' ', 2) AS noun
        FROM part) t),
f AS (
  SELECT l.l_orderkey AS order_id, b.product_id, bo.user_id, bo.order_number, bo.eval_set,
    l.l_linenumber AS add_to_cart_order
  FROM lineitem l JOIN b_orders bo ON l.l_orderkey = bo.order_id
    JOIN part p ON l.l_partkey = p.p_partkey JOIN b_products b ON p.p_name = b.product_name),
b_items AS (
  SELECT order_id, product_id, add_to_cart_order,
    CASE WHEN order_number > min(order_number) OVER (PARTITION BY user_id, product_id)
         THEN 1 ELSE 0 END AS reordered,
    eval_set
  FROM f WHERE eval_set <> 'test'),
b_prod AS (SELECT product_id, product_name, aisle_id, department_id FROM b_products),
b_depts AS (SELECT DISTINCT department_id, department FROM b_products),
b_baskets AS (SELECT eval_set, order_id, count(*) AS num_items FROM b_items GROUP BY eval_set, order_id),
b_feats AS (
  SELECT uo.user_id,
    CAST(uo.num_orders AS DOUBLE) AS num_orders,
    coalesce(uo.avg_days, 0.0) AS avg_days_between_orders,
    coalesce(uo.avg_hour, 0.0) AS avg_hour,
    coalesce(ub.avg_items, 0.0) AS avg_items_per_order,
    coalesce(ub.rate, 0.0) AS reorder_rate_user,
    CAST(coalesce(ud.depts, 0) AS DOUBLE) AS dept_diversity
  FROM (SELECT user_id, count(*) AS num_orders, avg(days_since_prior_order) AS avg_days,
          avg(CAST(order_hour_of_day AS DOUBLE)) AS avg_hour
        FROM b_orders GROUP BY user_id) uo
  LEFT JOIN (
    SELECT o.user_id, avg(CAST(po.n AS DOUBLE)) AS avg_items, avg(po.rate) AS rate
    FROM (SELECT order_id, count(*) AS n, avg(CAST(reordered AS DOUBLE)) AS rate FROM b_items GROUP BY order_id) po
    JOIN b_orders o ON po.order_id = o.order_id GROUP BY o.user_id) ub ON ub.user_id = uo.user_id
  LEFT JOIN (
    SELECT o.user_id, count(DISTINCT p.department_id) AS depts
    FROM b_items i JOIN b_orders o ON i.order_id = o.order_id
    LEFT JOIN b_prod p ON i.product_id = p.product_id GROUP BY o.user_id) ud ON ud.user_id = uo.user_id)
"""

_BODIES = {
    "orders_table": "SELECT * FROM b_orders",
    "order_items_table": "SELECT order_id, product_id, add_to_cart_order, reordered, eval_set FROM b_items",
    "op_prior_table": "SELECT order_id, product_id, add_to_cart_order, reordered FROM b_items WHERE eval_set = 'prior'",
    "op_train_table": "SELECT order_id, product_id, add_to_cart_order, reordered FROM b_items WHERE eval_set = 'train'",
    "products_table": "SELECT * FROM b_prod",
    "aisles_table": "SELECT DISTINCT aisle_id, aisle FROM b_products",
    "departments_table": "SELECT * FROM b_depts",
    "basket_sizes": "SELECT * FROM b_baskets",
    "kpi": """
SELECT (SELECT count(*) FROM b_orders) AS num_orders, count(*) AS num_items,
  CAST(count(*) AS DOUBLE) / count(DISTINCT order_id) AS avg_items_per_order
FROM b_items""",
    "top_products": """
SELECT i.product_id, p.product_name, count(*) AS times_bought
FROM b_items i JOIN b_prod p ON i.product_id = p.product_id
GROUP BY i.product_id, p.product_name ORDER BY times_bought DESC, i.product_id LIMIT {n}""",
    "reorder_rate_global": "SELECT avg(CAST(reordered AS DOUBLE)) AS reorder_rate FROM b_items",
    "top_reordered_products": """
SELECT s.product_id, p.product_name, s.times_bought, s.reorder_rate
FROM (SELECT product_id, count(*) AS times_bought, avg(CAST(reordered AS DOUBLE)) AS reorder_rate
      FROM b_items GROUP BY product_id HAVING count(*) >= {min_count}) s
JOIN b_prod p ON s.product_id = p.product_id
ORDER BY s.reorder_rate DESC, s.times_bought DESC, s.product_id LIMIT {n}""",
    "sales_by_department": """
SELECT department_id, department, items_sold,
  CAST(items_sold AS DOUBLE) * 100.0 / CAST(sum(items_sold) OVER () AS DOUBLE) AS pct
FROM (SELECT p.department_id, d.department, count(*) AS items_sold
      FROM b_items i JOIN b_prod p ON i.product_id = p.product_id
      JOIN b_depts d ON p.department_id = d.department_id
      GROUP BY p.department_id, d.department) t""",
    "reorder_rate_by_department": """
SELECT p.department_id, d.department, avg(CAST(i.reordered AS DOUBLE)) AS reorder_rate, count(*) AS items
FROM b_items i JOIN b_prod p ON i.product_id = p.product_id
JOIN b_depts d ON p.department_id = d.department_id
GROUP BY p.department_id, d.department""",
    "orders_by_dow": "SELECT order_dow, count(*) AS num_orders FROM b_orders GROUP BY order_dow",
    "orders_by_hour": "SELECT order_hour_of_day, count(*) AS num_orders FROM b_orders GROUP BY order_hour_of_day",
    "avg_items_by_dow": """
SELECT o.order_dow, avg(CAST(b.num_items AS DOUBLE)) AS avg_items
FROM b_baskets b JOIN b_orders o ON b.order_id = o.order_id GROUP BY o.order_dow""",
    "basket_size_buckets": """
SELECT CASE WHEN num_items <= 5 THEN '1-5' WHEN num_items <= 10 THEN '6-10'
            WHEN num_items <= 20 THEN '11-20' ELSE '21+' END AS bucket,
  count(*) AS num_orders
FROM b_baskets GROUP BY 1""",
    "avg_orders_per_user": """
SELECT avg(CAST(num_orders AS DOUBLE)) AS avg_orders_per_user
FROM (SELECT user_id, count(*) AS num_orders FROM b_orders GROUP BY user_id) t""",
    "top_users_by_orders": """
SELECT user_id, count(*) AS num_orders FROM b_orders GROUP BY user_id
ORDER BY num_orders DESC, user_id LIMIT {n}""",
    "orders_count_by_eval_set": "SELECT eval_set, count(*) AS num_orders FROM b_orders GROUP BY eval_set",
    "items_sold_by_eval_set": "SELECT eval_set, count(*) AS num_items FROM b_items GROUP BY eval_set",
    "avg_items_per_order_by_eval_set": """
SELECT s.eval_set, avg(CAST(b.num_items AS DOUBLE)) AS avg_items
FROM (VALUES ('prior'), ('train')) s(eval_set) LEFT JOIN b_baskets b ON b.eval_set = s.eval_set
GROUP BY s.eval_set""",
    "reorder_rate_by_eval_set": """
SELECT s.eval_set, avg(CAST(i.reordered AS DOUBLE)) AS reorder_rate
FROM (VALUES ('prior'), ('train')) s(eval_set) LEFT JOIN b_items i ON i.eval_set = s.eval_set
GROUP BY s.eval_set""",
    "user_features": f"""
SELECT user_id, round(num_orders, {DIGITS}) AS num_orders,
  round(avg_days_between_orders, {DIGITS}) AS avg_days_between_orders,
  round(avg_hour, {DIGITS}) AS avg_hour, round(avg_items_per_order, {DIGITS}) AS avg_items_per_order,
  round(reorder_rate_user, {DIGITS}) AS reorder_rate_user, round(dept_diversity, {DIGITS}) AS dept_diversity
FROM b_feats""",
    "user_features_sampled": f"""
SELECT user_id, round(num_orders, {DIGITS}) AS num_orders,
  round(avg_days_between_orders, {DIGITS}) AS avg_days_between_orders,
  round(avg_hour, {DIGITS}) AS avg_hour, round(avg_items_per_order, {DIGITS}) AS avg_items_per_order,
  round(reorder_rate_user, {DIGITS}) AS reorder_rate_user, round(dept_diversity, {DIGITS}) AS dept_diversity
FROM b_feats WHERE md5('42/users/' || user_id) < '{threshold(0.3)}'""",
    "sampled_users": f"SELECT DISTINCT user_id FROM b_orders WHERE md5('42/users/' || user_id) < '{threshold(0.3)}'",
    "sampled_users_capped": f"""
SELECT user_id FROM (SELECT DISTINCT user_id FROM b_orders WHERE md5('42/users/' || user_id) < '{threshold(0.3)}') t
ORDER BY md5('42/users-cap/' || user_id), user_id LIMIT 50""",
    "training_rows_sampled": f"""
SELECT user_id FROM b_feats WHERE num_orders >= 5
  AND md5('42/users/' || user_id) < '{threshold(0.3)}' AND md5('42/fit/' || user_id) < '{threshold(0.5)}'""",
    "segment_scaling": "UNION ALL".join(
        f" SELECT '{c}' AS feature, round(stddev_samp({c}), 6) AS std FROM b_feats WHERE num_orders >= 5 " for c in G.FEATURES
    ),
    "segment_assign_fixed": f"""
SELECT user_id, CAST(CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS INT) AS nearest,
  round(least(d0, d1, d2), 6) AS distance
FROM (SELECT user_id, {", ".join(" + ".join(f"({c} - {v}) * ({c} - {v})" for c, v in zip(G.FEATURES, centre, strict=True)) + f" AS d{i}" for i, centre in enumerate(CENTRES))} FROM b_feats) t""",
    "kmeans_assignment_check": "SELECT count(*) AS users, 5 AS clusters, 0 AS violations FROM b_feats WHERE num_orders >= 5",
    "kmeans_profile_totals": """
SELECT count(*) AS users, round(avg(num_orders), 6) AS avg_num_orders, round(avg(avg_items_per_order), 6) AS avg_basket_size,
  round(avg(reorder_rate_user), 6) AS avg_reorder_rate, round(avg(dept_diversity), 6) AS avg_dept_diversity,
  round(avg(avg_days_between_orders), 6) AS avg_days_between, round(avg(avg_hour), 6) AS avg_hour
FROM b_feats WHERE num_orders >= 5""",
    "kmeans_stationary": """
SELECT CAST(cluster AS INT) AS cluster, 0.0::DOUBLE AS gap, true AS improves
FROM range(5) t(cluster) WHERE (SELECT count(*) FROM b_feats WHERE num_orders >= 5) > 0""",
    "kmeans_saved_profile": "SELECT 5 AS clusters, 0 AS differing FROM b_feats LIMIT 1",
    "department_order_sketches": """
SELECT p.department_id, count(DISTINCT i.order_id) AS orders, true AS within_bound, true AS merges
FROM b_items i JOIN b_prod p USING (product_id) GROUP BY p.department_id""",
    "csv_bad_records": """
SELECT 'orders.csv' AS file, count(*) AS good, count(*) FILTER (order_id % 50 = 0) AS bad,
  CAST(sum(order_id) FILTER (order_id % 50 = 0) AS BIGINT) AS bad_orders, CAST(sum(order_id) AS BIGINT) AS good_orders FROM b_orders
UNION ALL SELECT 'order_products__prior.csv', count(*), count(*) FILTER (order_id % 40 = 0),
  CAST(sum(order_id) FILTER (order_id % 40 = 0) AS BIGINT), CAST(sum(order_id) AS BIGINT) FROM b_items WHERE eval_set = 'prior'
UNION ALL SELECT 'order_products__train.csv', count(*), 0, NULL, CAST(sum(order_id) AS BIGINT) FROM b_items WHERE eval_set = 'train'
UNION ALL SELECT 'products.csv', count(*), 0, NULL, NULL FROM b_prod
UNION ALL SELECT 'aisles.csv', count(DISTINCT aisle_id), 0, NULL, NULL FROM b_products
UNION ALL SELECT 'departments.csv', count(*), 0, NULL, NULL FROM b_depts""",
    "segment_profile_fixed": f"""
SELECT CAST(user_id % 5 AS INT) AS cluster, count(*) AS users,
  round(avg(num_orders), {DIGITS}) AS avg_num_orders,
  round(avg(avg_items_per_order), {DIGITS}) AS avg_basket_size,
  round(avg(reorder_rate_user), {DIGITS}) AS avg_reorder_rate,
  round(avg(dept_diversity), {DIGITS}) AS avg_dept_diversity,
  round(avg(avg_days_between_orders), {DIGITS}) AS avg_days_between,
  round(avg(avg_hour), {DIGITS}) AS avg_hour
FROM b_feats GROUP BY 1""",
}


def _lloyd_sql(body: str) -> str:
    """``body`` over ``labelled`` (the features and ``cluster``): the rounds of Lloyd's iteration as CTEs, one after the other."""
    at = [f"x{i}" for i in range(len(G.FEATURES))]
    scaled = ", ".join(f"coalesce({c} / nullif(s{i}, 0), 0) AS x{i}" for i, c in enumerate(G.FEATURES))
    devs = ", ".join(f"stddev_samp({c}) AS s{i}" for i, c in enumerate(G.FEATURES))
    start = " UNION ALL ".join(
        f"SELECT {n} AS id, " + ", ".join(f"coalesce({v} / nullif(s{i}, 0), 0) AS x{i}" for i, v in enumerate(own)) + " FROM dev"
        for n, own in enumerate(CENTRES)
    )
    distance = " + ".join(f"(z.{x} - c.{x}) * (z.{x} - c.{x})" for x in at)
    ctes = [
        f"dev AS MATERIALIZED (SELECT {devs} FROM b_feats WHERE num_orders >= 5)",
        f"z AS MATERIALIZED (SELECT f.*, {scaled} FROM b_feats f, dev WHERE num_orders >= 5)",
        f"c0 AS MATERIALIZED ({start})",
    ]
    for k in range(ROUNDS + 1):
        ctes.append(
            f"a{k} AS MATERIALIZED (SELECT z.*, c.id FROM z, c{k} c "
            f"QUALIFY row_number() OVER (PARTITION BY z.user_id ORDER BY {distance}, c.id) = 1)"
        )
        means = ", ".join(f"coalesce(avg(a.{x}), any_value(c.{x})) AS {x}" for x in at)
        ctes.append(f"c{k + 1} AS MATERIALIZED (SELECT c.id, {means} FROM c{k} c LEFT JOIN a{k} a USING (id) GROUP BY c.id)")
    ctes.append(
        "numbered AS (SELECT id, CAST(row_number() OVER (ORDER BY count(*) DESC, min(user_id)) - 1 AS INT) AS cluster "
        f"FROM a{ROUNDS} GROUP BY id)"
    )
    ctes.append(f"labelled AS (SELECT a.*, n.cluster FROM a{ROUNDS} a JOIN numbered n USING (id))")
    return _BASE.rstrip() + ",\n" + ",\n".join(ctes) + "\n" + body


def _sql(body: str, **params) -> str:
    return _BASE + body.format(**params)


def oracle_sql() -> dict[str, str]:
    out = {k: _sql(v, n=10, min_count=200) for k, v in _BODIES.items()}
    out.update({f"report_{key}": out[key] for key in cubes.KEYS})
    out["csv_items"] = out["order_items_table"]
    out["views_sales_by_department"] = out["sales_by_department"]
    out["cached_kpi"] = out["csv_kpi"] = out["kpi"]
    out["cached_departments"] = out["sales_by_department"]
    out["kmeans_from_centres"] = _lloyd_sql("SELECT user_id, cluster FROM labelled")
    out["kmeans_from_centres_cluster0"] = _lloyd_sql("SELECT user_id, cluster FROM labelled WHERE cluster = 0")
    out["kmeans_from_centres_profile"] = _lloyd_sql(
        """SELECT cluster, count(*) AS users, round(avg(num_orders), 6) AS avg_num_orders,
  round(avg(avg_items_per_order), 6) AS avg_basket_size, round(avg(reorder_rate_user), 6) AS avg_reorder_rate,
  round(avg(dept_diversity), 6) AS avg_dept_diversity, round(avg(avg_days_between_orders), 6) AS avg_days_between,
  round(avg(avg_hour), 6) AS avg_hour FROM labelled GROUP BY cluster"""
    )
    out["top_products_n25"] = _sql(_BODIES["top_products"], n=25)
    out["top_reordered_products_n20_min100"] = _sql(_BODIES["top_reordered_products"], n=20, min_count=100)
    out["top_users_by_orders_n25"] = _sql(_BODIES["top_users_by_orders"], n=25)
    out.update(_llm()[1])
    return out
