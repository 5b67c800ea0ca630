"""User segmentation: features, sampling, k-means fit, assignment, profile (Q17, Q18).

Feature table (one row per user, all doubles):

* num_orders, avg_days_between_orders (NULL days skipped), avg_hour: from orders;
* avg_items_per_order and reorder_rate_user: means over the user's orders of the
  per-order item count and per-order reorder rate (an average of per-order
  rates, not of items); per-order stats group both splits together by order;
* dept_diversity: distinct departments bought (unknown products count for none);
* users without any item get 0 for the basket features, single-order users 0 days.

Scale: every step is a (partially aggregated) hash aggregate or an equi-join on a key
that is unique on one side (order_id in orders, user_id in per-user tables).  The fact
is reduced to one row per order before it meets orders; the departments of an
order, and then of a user, are bits of a few long columns, so no buffer grows with
the data.  With a user sample, items are restricted to the kept orders before anything else.

k-means is Spark ML (distributed Lloyd iterations, k-means|| seeding).  The
training rows are pinned to a layout (hash partitioned and sorted on user_id,
partition count derived from the row count) before the fit, so the seeding and
hence the clusters depend on the data and the seed only, not on how the input
happened to be partitioned or on session settings; the fit input is
checkpointed, so the iterations re-read it instead of re-running the feature
plan (and survive lost executors).  Clusters are renumbered by size (largest first, then smallest
user_id) so ids are stable.  Equal requests over the same tables share one fit, which
can be saved and loaded.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basket.functions.columns import ratio
from basket.operators.facts import Items, over_parts
from basket.operators.sampling import hash_cap, hash_sample, sample_predicate
from basket.session import ensure_checkpoint_dir

# The two sampling steps hash differently, so their fractions multiply.
USER_STEP, FIT_STEP = "users", "fit"

# Feature columns, in the order they enter the vector.
FEATURES = (
    "num_orders",
    "avg_days_between_orders",
    "avg_hour",
    "avg_items_per_order",
    "reorder_rate_user",
    "dept_diversity",
)


def sample_users(orders: DataFrame, fraction: float = 0.3, seed: int = 42, max_users: int | None = None) -> DataFrame:
    """Distinct user ids kept by a seeded hash threshold (same users whatever the
    layout); optionally at most ``max_users`` of them, smallest hash first."""
    users = hash_sample(orders.select("user_id").distinct(), "user_id", fraction, seed, USER_STEP)
    if max_users is not None:
        users = hash_cap(users, "user_id", max_users, seed, f"{USER_STEP}-cap")
    return users


# Bits used of a long, and the words up to which departments are kept as bits.
WORD_BITS, MAX_WORDS = 63, 16


def _department_bits(products: DataFrame) -> tuple[DataFrame, int] | None:
    """``(product_id, dept_no)`` and the number of departments; None if there are too many for bits."""
    ids = products.select("department_id").where(F.col("department_id").isNotNull()).distinct()
    count = ids.limit(WORD_BITS * MAX_WORDS + 1).count()
    if count > WORD_BITS * MAX_WORDS:
        return None
    # At most WORD_BITS * MAX_WORDS rows: one task numbers them.
    numbered = ids.select("department_id", (F.row_number().over(Window.orderBy("department_id")) - 1).alias("dept_no"))
    return products.join(F.broadcast(numbered), "department_id").select("product_id", "dept_no"), count


def user_features(
    orders: DataFrame,
    items: Items,
    products: DataFrame,
    users: DataFrame | None = None,
    exact_departments: bool = True,
    user_filter: Column | None = None,
) -> DataFrame:
    """The six features per user.  ``users`` (a user_id table, semi-joined) or
    ``user_filter`` (a predicate on orders.user_id, map-only) restricts the users."""
    o = orders.select("order_id", "user_id", "days_since_prior_order", "order_hour_of_day")
    restricted = user_filter is not None or users is not None
    if user_filter is not None:
        o = o.filter(user_filter)
    if users is not None:
        o = o.join(users.select("user_id"), "user_id", "left_semi")

    user_orders = o.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("num_orders"),
        F.avg("days_since_prior_order").alias("avg_days_between_orders"),
        F.avg("order_hour_of_day").alias("avg_hour"),
    )
    bits = _department_bits(products) if exact_departments else None
    words = [f"_d{w}" for w in range(-(-bits[1] // WORD_BITS))] if bits else []

    def per_order(part: DataFrame) -> DataFrame:
        # Both splits together.  Partial aggregation: the fact shuffles as one row per order and
        # task (on the bucketed layout not at all), and moves only the orders side of the join.
        rows = part.select("order_id", "product_id", "reordered")
        if restricted:
            rows = rows.join(o.select("order_id"), "order_id", "left_semi")
        own = []
        if bits:
            rows = rows.join(bits[0], "product_id", "left")
            for w, name in enumerate(words):
                place = F.col("dept_no") - w * WORD_BITS
                bit = F.when(place.between(0, WORD_BITS - 1), F.expr(f"shiftleft(1L, dept_no - {w * WORD_BITS})"))
                own.append(F.bit_or(bit).alias(name))
        counted = rows.groupBy("order_id").agg(
            F.count(F.lit(1)).alias("num_items"),
            ratio(F.sum("reordered"), F.count("reordered")).alias("reorder_rate_order"),
            *own,
        )
        return counted.join(o.select("order_id", "user_id"), "order_id")

    user_items = over_parts(items, per_order).groupBy("user_id").agg(
        F.avg("num_items").alias("avg_items_per_order"),
        F.avg("reorder_rate_order").alias("reorder_rate_user"),
        *[F.bit_or(w).alias(w) for w in words],
    )
    if bits:
        found = [F.coalesce(F.bit_count(w), F.lit(0)) for w in words]
        user_items = user_items.withColumn("dept_diversity", reduce(Column.__add__, found, F.lit(0))).drop(*words)
    else:
        # More departments than bits, or an approximate count: pairs of user and department.
        pairs = over_parts(
            items,
            lambda part: part.select("order_id", "product_id")
            .join(o.select("order_id", "user_id"), "order_id")
            .join(products.select("product_id", "department_id"), "product_id"),
        )
        count = F.count_distinct if exact_departments else F.approx_count_distinct
        user_items = user_items.join(pairs.groupBy("user_id").agg(count("department_id").alias("dept_diversity")), "user_id", "left")

    feats = user_orders.join(user_items, "user_id", "left")
    return feats.select(
        "user_id",
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES],
    )


def training_rows(features: DataFrame, min_orders: int = 5, sample_fraction: float = 1.0, seed: int = 42) -> DataFrame:
    """Active users (num_orders >= min_orders), hash-sampled for the fit."""
    active = features.filter(F.col("num_orders") >= F.lit(float(min_orders)))
    return hash_sample(active, "user_id", sample_fraction, seed, FIT_STEP)


@dataclass(frozen=True)
class Segments:
    model: PipelineModel
    cluster_ids: DataFrame  # raw k-means prediction -> stable cluster id (at most k rows)
    train: DataFrame  # the fitted rows, checkpointed


# Fixed value: rows per partition of the k-means input.
FIT_ROWS_PER_PARTITION = 200_000


def fit_partitions(rows: int) -> int:
    """Partition count of the fit input, from the data alone: k-means|| seeding
    depends on the layout, so tying it to a session setting would make clusters
    change with the configuration."""
    return max(1, -(-int(rows) // FIT_ROWS_PER_PARTITION))


def _pinned(df: DataFrame, n: int) -> DataFrame:
    return df.repartition(n, "user_id").sortWithinPartitions("user_id")


def _size_order() -> Window:
    # At most k rows: a window without partition is fine here.
    return Window.orderBy(F.col("size").desc(), F.col("first_user").asc())


def fit_segments(train: DataFrame, k: int = 5, seed: int = 42, max_iter: int = 15, tol: float = 1e-4) -> Segments:
    """Fit assemble -> scale (std only) -> k-means on ``train`` (a feature table).

    Lloyd's iterations end when no centre moves by more than ``tol``, or after ``max_iter`` of them.
    """
    ensure_checkpoint_dir(train.sparkSession)
    # Features are computed once: kept while counting them and writing the
    # layout-pinned checkpoint the iterations read.
    cached = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = _pinned(cached, fit_partitions(cached.count())).checkpoint(eager=True)
    finally:
        cached.unpersist()
    points = rows.select(*FEATURES)
    distinct_points = points.distinct().limit(int(k)).count()
    if distinct_points < k:
        raise ValueError(f"k-means needs at least k={k} distinct feature rows, got {distinct_points}")

    stages = [
        VectorAssembler(inputCols=list(FEATURES), outputCol="features_raw"),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=False, withStd=True),
        KMeans(
            k=int(k),
            seed=int(seed),
            maxIter=int(max_iter),
            tol=float(tol),
            initMode="k-means||",
            featuresCol="features",
            predictionCol="raw_cluster",
        ),
    ]
    model = Pipeline(stages=stages).fit(rows)

    # Stable numbering: by cluster size desc, then smallest member id.  k rows.
    sizes = (
        model.transform(rows)
        .groupBy("raw_cluster")
        .agg(F.count(F.lit(1)).alias("size"), F.min("user_id").alias("first_user"))
    )
    ids = sizes.select(
        "raw_cluster",
        (F.row_number().over(_size_order()) - 1).cast("int").alias("cluster"),
    ).checkpoint(eager=True)
    return Segments(model=model, cluster_ids=ids, train=rows)


def label_segments(segments: Segments, features: DataFrame) -> DataFrame:
    """``features`` plus its stable ``cluster``; the mapping table has k rows."""
    predicted = segments.model.transform(features).drop("features_raw", "features")
    return predicted.join(F.broadcast(segments.cluster_ids), "raw_cluster").drop("raw_cluster")


def assign_segments(segments: Segments, features: DataFrame) -> DataFrame:
    """(user_id, cluster) for every row of ``features``."""
    return label_segments(segments, features).select("user_id", "cluster")


def save_segments(segments: Segments, path: str) -> None:
    """Write the fitted model, the cluster numbering and the fitted rows below ``path``."""
    segments.model.write().overwrite().save(os.path.join(path, "model"))
    segments.cluster_ids.write.mode("overwrite").parquet(os.path.join(path, "cluster_ids"))
    segments.train.write.mode("overwrite").parquet(os.path.join(path, "train"))


def load_segments(spark: SparkSession, path: str) -> Segments:
    return Segments(
        model=PipelineModel.load(os.path.join(path, "model")),
        cluster_ids=spark.read.parquet(os.path.join(path, "cluster_ids")),
        train=spark.read.parquet(os.path.join(path, "train")),
    )


def feature_scales(segments: Segments) -> dict[str, float]:
    """The standard deviation that the model divides each feature by."""
    return dict(zip(FEATURES, (float(x) for x in segments.model.stages[1].std), strict=True))


def nearest_centre(features: DataFrame, centres: list[list[float]], scales: dict[str, float]) -> DataFrame:
    """``features`` with ``nearest`` (the first of the closest centres) and ``distance`` (squared), as expressions.

    Centres are in scaled units; a feature with scale 0 counts as 0, as in the model.
    """
    scaled = [F.col(c) / F.lit(scales[c]) if scales[c] else F.lit(0.0) for c in FEATURES]
    each = [
        F.struct(reduce(Column.__add__, [(x - F.lit(float(v))) ** 2 for x, v in zip(scaled, centre, strict=True)]).alias("d"), F.lit(i).alias("i"))
        for i, centre in enumerate(centres)
    ]
    return features.withColumn("_n", F.array_min(F.array(*each))).select(
        "*", F.col("_n.i").alias("nearest"), F.col("_n.d").alias("distance")
    ).drop("_n")


def _distance(xs, ys) -> Column:
    return F.sqrt(reduce(Column.__add__, [(x - y) ** 2 for x, y in zip(xs, ys, strict=True)]))


def certificate(segments: Segments) -> DataFrame:
    """What shows that a fit is a fixed point of Lloyd's iteration: per cluster ``cluster, users, gap, improves``.

    ``gap`` is the distance (in scaled units) of the model's centre from the mean of the rows nearest to it: 0 when neither
    centres nor labels would change in another round.  ``improves``: the summed squared distances are at most those of the centres
    that the same seeding starts from.
    """
    k_means = segments.model.stages[-1]
    scales = feature_scales(segments)
    centres = [list(map(float, c)) for c in k_means.clusterCenters()]
    seeds = _seed_centres(segments)
    near = nearest_centre(segments.train, centres, scales)
    cost = F.sum("distance").alias("cost")
    seeding = nearest_centre(segments.train, seeds, scales).agg(cost).scalar()
    fitted = near.agg(cost).scalar()
    means = near.groupBy("nearest").agg(
        F.count(F.lit(1)).alias("users"), *[F.avg(F.col(c) / scales[c] if scales[c] else F.lit(0.0)).alias(c) for c in FEATURES]
    )
    own = [F.element_at(F.array(*[F.lit(c[i]) for c in centres]), F.col("nearest") + 1) for i in range(len(FEATURES))]
    gaps = means.select(F.col("nearest").alias("raw_cluster"), "users", _distance([F.col(c) for c in FEATURES], own).alias("gap"))
    # Costs of equal labels may differ in their last digits.
    improves = fitted <= seeding * (1 + 1e-9)
    return gaps.join(F.broadcast(segments.cluster_ids), "raw_cluster").select("cluster", "users", "gap", improves.alias("improves"))


def _seed_centres(segments: Segments) -> list[list[float]]:
    """The centres that the model's seeding starts from: a fit of no iterations over the same rows."""
    prepared = PipelineModel(segments.model.stages[:-1]).transform(segments.train)
    start = segments.model.stages[-1]
    seeding = KMeans(
        k=start.getK(), seed=start.getSeed(), maxIter=0, initMode=start.getInitMode(), featuresCol="features", predictionCol="_seeded"
    ).fit(prepared)
    return [list(map(float, c)) for c in seeding.clusterCenters()]


def standard_deviations(train: DataFrame) -> dict[str, float]:
    """Sample standard deviation of each feature (0 where it is constant)."""
    row = train.agg(*[F.stddev_samp(c).alias(c) for c in FEATURES]).head()
    return {c: float(row[c] or 0.0) for c in FEATURES}


def lloyd_from(train: DataFrame, centres: list[list[float]], rounds: int) -> tuple[list[list[float]], dict[str, float]]:
    """(centres in scaled units, scales) after at most ``rounds`` of Lloyd's iterations from given ``centres`` (raw units).

    MLlib's k-means with an initial model; a cluster that loses all its rows keeps its centre.  It ends early only when no
    centre moves at all.  The rows are read from a checkpoint, as in :func:`fit_segments`.
    """
    from pyspark.mllib.clustering import KMeans as Lloyd
    from pyspark.mllib.clustering import KMeansModel

    ensure_checkpoint_dir(train.sparkSession)
    rows = _pinned(train, fit_partitions(train.count())).checkpoint(eager=True)
    scales = standard_deviations(rows)
    scaled = F.array(*[F.col(c) / scales[c] if scales[c] else F.lit(0.0) for c in FEATURES])
    start = [[v / scales[c] if scales[c] else 0.0 for v, c in zip(own, FEATURES, strict=True)] for own in centres]
    points = rows.select(scaled.alias("x")).rdd.map(lambda r: r[0]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = Lloyd.train(points, k=len(start), maxIterations=int(rounds), epsilon=0.0, initialModel=KMeansModel(start))
    finally:
        points.unpersist()
    return [list(map(float, c)) for c in model.clusterCenters], scales


def label_nearest(features: DataFrame, centres: list[list[float]], scales: dict[str, float]) -> DataFrame:
    """``features`` plus ``cluster``: the number of its nearest centre, numbered by size and smallest user as in :func:`fit_segments`."""
    near = nearest_centre(features, centres, scales).drop("distance")
    sizes = near.groupBy("nearest").agg(F.count(F.lit(1)).alias("size"), F.min("user_id").alias("first_user"))
    ids = sizes.select("nearest", (F.row_number().over(_size_order()) - 1).cast("int").alias("cluster"))
    return near.join(F.broadcast(ids), "nearest").drop("nearest")


def profile_segments(labelled: DataFrame) -> DataFrame:
    """Per cluster of a labelled feature table: users and the six feature means."""
    return (
        labelled.groupBy("cluster")
        .agg(
            F.count(F.lit(1)).alias("users"),
            F.avg("num_orders").alias("avg_num_orders"),
            F.avg("avg_items_per_order").alias("avg_basket_size"),
            F.avg("reorder_rate_user").alias("avg_reorder_rate"),
            F.avg("dept_diversity").alias("avg_dept_diversity"),
            F.avg("avg_days_between_orders").alias("avg_days_between"),
            F.avg("avg_hour").alias("avg_hour"),
        )
        .orderBy("cluster")
    )


def _target(feats: DataFrame, segments: Segments, assign: str, min_orders: int, seed: int) -> DataFrame:
    if assign == "train":
        return segments.train
    if assign == "active":
        return training_rows(feats, min_orders, 1.0, seed)
    if assign == "all":
        return feats
    raise ValueError(f"assign must be 'train', 'active' or 'all', got {assign!r}")


# Fits of the session, newest last; equal requests over the same tables share one.
_FITS: dict[tuple, tuple[DataFrame, Segments, tuple]] = {}
FITS_KEPT = 4


def forget_fits() -> None:
    _FITS.clear()


def fitted(
    orders: DataFrame,
    items: Items,
    products: DataFrame,
    k: int = 5,
    seed: int = 42,
    min_orders: int = 5,
    sample_fraction: float = 1.0,
    user_fraction: float = 1.0,
    max_users: int | None = None,
) -> tuple[DataFrame, Segments]:
    """The feature table and the fit for one set of parameters; computed once."""
    tables = (orders, *([items] if isinstance(items, DataFrame) else items), products)
    key = (tuple(map(id, tables)), k, seed, min_orders, sample_fraction, user_fraction, max_users)
    if key not in _FITS:
        pred = None
        if user_fraction < 1.0 or max_users is not None:
            # The user sample as a predicate on user_id (same users as sample_users).
            pred = sample_predicate(orders, "user_id", user_fraction, seed, max_users, USER_STEP)
        feats = user_features(orders, items, products, user_filter=pred)
        segments = fit_segments(training_rows(feats, min_orders, sample_fraction, seed), k, seed)
        while len(_FITS) >= FITS_KEPT:
            _FITS.pop(next(iter(_FITS)))
        _FITS[key] = (feats, segments, tables)  # the tables stay alive, so their ids stay theirs
    return _FITS[key][:2]


def kmeans_user_clusters(
    orders: DataFrame,
    items: Items,
    products: DataFrame,
    cluster: int | None = None,
    assign: str = "train",
    min_orders: int = 5,
    seed: int = 42,
    **fit,
) -> DataFrame:
    """(user_id, cluster).  Fits on a hash sample of the active users.

    ``assign``: ``"train"`` labels the fitted rows, ``"active"`` every user with at
    least ``min_orders`` orders, ``"all"`` every user.  ``cluster`` keeps one
    cluster only.
    """
    feats, segments = fitted(orders, items, products, seed=seed, min_orders=min_orders, **fit)
    out = assign_segments(segments, _target(feats, segments, assign, min_orders, seed))
    if cluster is not None:
        out = out.filter(F.col("cluster") == F.lit(int(cluster)))
    return out


def kmeans_cluster_profile(
    orders: DataFrame,
    items: Items,
    products: DataFrame,
    assign: str = "train",
    min_orders: int = 5,
    seed: int = 42,
    **fit,
) -> DataFrame:
    feats, segments = fitted(orders, items, products, seed=seed, min_orders=min_orders, **fit)
    return profile_segments(label_segments(segments, _target(feats, segments, assign, min_orders, seed)))
