"""Segmentation: sampling is layout-free, clusters are stable, assignment is nearest-centre."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from basket.plans import segments as G
from basket.sources.star import from_star
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def t(spark):
    return from_star(spark, SF_SMALL)


@pytest.fixture(scope="module")
def feats(t):
    return G.user_features(t.orders, t.order_items, t.products)


def test_sample_users_ignores_layout(t):
    a = {r.user_id for r in G.sample_users(t.orders, 0.3, 42).collect()}
    b = {r.user_id for r in G.sample_users(t.orders.repartition(13), 0.3, 42).collect()}
    c = {r.user_id for r in G.sample_users(t.orders.coalesce(1), 0.3, 42).collect()}
    assert a == b == c and 0.2 < len(a) / t.orders.select("user_id").distinct().count() < 0.4
    capped = G.sample_users(t.orders, 0.3, 42, max_users=10).collect()
    assert len(capped) == 10 and {r.user_id for r in capped} <= a


def test_features_restricted_to_sampled_users(t):
    users = G.sample_users(t.orders, 0.3, 42)
    f = G.user_features(t.orders, t.order_items, t.products, users)
    assert f.count() == users.count()


def test_clusters_nearest_centre_and_stable(spark, feats):
    train = G.training_rows(feats, min_orders=5)
    seg = G.fit_segments(train, k=4, seed=42)
    labelled = G.label_segments(seg, train)
    centres = np.array(seg.model.stages[-1].clusterCenters())
    scale = np.array(seg.model.stages[1].std.toArray())
    scale[scale == 0] = 1.0
    raw_to_stable = {r.raw_cluster: r.cluster for r in seg.cluster_ids.collect()}
    stable_to_raw = {v: k for k, v in raw_to_stable.items()}
    for r in labelled.collect():
        x = np.array([r[c] for c in G.FEATURES]) / scale
        x[np.array(seg.model.stages[1].std.toArray()) == 0] = 0.0
        d = ((centres - x) ** 2).sum(axis=1)
        assert d[stable_to_raw[r.cluster]] <= d.min() + 1e-9
    prof = G.profile_segments(labelled).collect()
    assert sum(r.users for r in prof) == train.count()
    sizes = [r.users for r in prof]
    assert sizes == sorted(sizes, reverse=True)  # numbered by size
    # Same clusters from a different input layout.
    seg2 = G.fit_segments(G.training_rows(feats.repartition(13), min_orders=5), k=4, seed=42)
    a = {tuple(r) for r in G.assign_segments(seg, train).collect()}
    b = {tuple(r) for r in G.assign_segments(seg2, train).collect()}
    assert a == b


def test_catalogue_entry_filters_one_cluster(t):
    all_ = G.kmeans_user_clusters(t.orders, t.order_items, t.products, k=3)
    one = G.kmeans_user_clusters(t.orders, t.order_items, t.products, k=3, cluster=1)
    assert one.count() == all_.filter(F.col("cluster") == 1).count() > 0


def test_cap_is_the_smallest_hashes(spark):
    import hashlib

    from basket.operators import sampling

    keys = spark.range(1, 2001).withColumnRenamed("id", "user_id")
    got = {r.user_id for r in sampling.hash_cap(keys.repartition(7), "user_id", 150, 42).collect()}
    assert got == set(sorted(range(1, 2001), key=lambda u: (hashlib.md5(f"42/cap/{u}".encode()).hexdigest(), u))[:150])


def test_samples_compose(spark):
    """Two steps sample independently: 0.3 then 0.05 keeps about 1.5 %, in either order."""
    users = spark.range(200_000).withColumnRenamed("id", "user_id").withColumn("num_orders", F.lit(9.0))
    for first, second in ((0.3, 0.05), (0.05, 0.3)):
        kept = G.training_rows(G.sample_users(users, first, 42).join(users, "user_id"), 5, second, 42).count()
        assert 2700 < kept < 3300
    capped = G.sample_users(users, 1.0, 42, max_users=3000).join(users, "user_id")
    assert 90 < G.training_rows(capped, 5, 0.05, 42).count() < 220


def test_fractions_keep_their_precision(spark):
    from basket.operators.sampling import hash_sample, threshold

    assert threshold(0.5) == "8" + "0" * 31 and threshold(4e-7) > "0" * 32
    keys = spark.range(4_000_000).withColumnRenamed("id", "k")
    assert 2 <= hash_sample(keys, "k", 4e-6, 1).count() <= 40


def test_model_survives_saving(spark, feats, tmp_path):
    seg = G.fit_segments(G.training_rows(feats, min_orders=5), k=3)
    G.save_segments(seg, str(tmp_path / "seg"))
    back = G.load_segments(spark, str(tmp_path / "seg"))
    a, b = ({tuple(r) for r in G.assign_segments(x, feats).collect()} for x in (seg, back))
    assert a == b


def test_equal_requests_share_one_fit(t):
    G.forget_fits()
    a = G.fitted(t.orders, t.order_items, t.products, k=3)
    assert G.fitted(t.orders, t.order_items, t.products, k=3) is not None and len(G._FITS) == 1
    assert G.fitted(t.orders, t.order_items, t.products, k=3)[1] is a[1]
    for k in range(2, 9):
        G._FITS[k] = (None, None, ())
    G.fitted(t.orders, t.order_items, t.products, k=4)
    assert len(G._FITS) == G.FITS_KEPT
    G.forget_fits()


def test_many_departments_take_the_other_way(t, feats, monkeypatch):
    monkeypatch.setattr(G, "WORD_BITS", 3)  # several words
    rows = lambda df: {(r.user_id, *(round(r[c], 9) for c in G.FEATURES)) for r in df.collect()}
    words = rows(G.user_features(t.orders, t.order_items, t.products))
    monkeypatch.setattr(G, "MAX_WORDS", 1)  # too many for bits
    pairs = rows(G.user_features(t.orders, t.order_items, t.products))
    assert words == pairs == rows(feats)


def test_restricted_items_meet_the_kept_orders_first(t):
    kept = G.sample_users(t.orders, 0.1, 42)
    plan = G.user_features(t.orders, t.order_items, t.products, kept)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") >= 2


def test_clusters_do_not_depend_on_shuffle_partitions(spark, feats):
    train = G.training_rows(feats, min_orders=5)
    a = {tuple(r) for r in G.assign_segments(G.fit_segments(train, k=3, seed=7), train).collect()}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = {tuple(r) for r in G.assign_segments(G.fit_segments(train, k=3, seed=7), train).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b
    assert G.fit_partitions(1) == 1 and G.fit_partitions(500_000) == 3
    assert G.fit_partitions(10**12) == 5_000_000


def test_sample_predicate_equals_sampled_users(t):
    from pyspark.sql import functions as F

    from basket.operators.sampling import sample_predicate

    for fraction, cap in [(0.3, None), (0.3, 25), (1.0, 40)]:
        users = {r.user_id for r in G.sample_users(t.orders, fraction, 42, cap).collect()}
        pred = sample_predicate(t.orders, "user_id", fraction, 42, cap, G.USER_STEP)
        got = {r.user_id for r in t.orders.filter(pred).select("user_id").distinct().collect()}
        assert got == users
    f1 = G.user_features(t.orders, t.order_items, t.products, G.sample_users(t.orders, 0.3, 42, 25))
    f2 = G.user_features(t.orders, t.order_items, t.products, user_filter=sample_predicate(t.orders, "user_id", 0.3, 42, 25, G.USER_STEP))
    assert f1.exceptAll(f2).count() == 0 and f2.exceptAll(f1).count() == 0


def test_sampled_fit_end_to_end(t):
    out = G.kmeans_user_clusters(t.orders, t.order_items, t.products, k=3, user_fraction=0.6, max_users=80, assign="all")
    users = {r.user_id for r in G.sample_users(t.orders, 0.6, 42, 80).collect()}
    got = {r.user_id for r in out.collect()}
    assert got == users


def test_approximate_department_count_option(t, feats):
    approx = G.user_features(t.orders, t.order_items, t.products, exact_departments=False)
    a = {r.user_id: r.dept_diversity for r in approx.collect()}
    e = {r.user_id: r.dept_diversity for r in feats.collect()}
    assert a.keys() == e.keys()
    # HLL++ is exact for such small cardinalities (8 departments).
    assert a == e


def test_certificate_tells_a_fixed_point_from_a_start(feats):
    train = G.training_rows(feats, min_orders=5)
    done = G.certificate(G.fit_segments(train, k=4, max_iter=500, tol=0.0)).collect()
    assert sorted(r.cluster for r in done) == [0, 1, 2, 3] and sum(r.users for r in done) == train.count()
    assert all(r.gap < 1e-9 and r.improves for r in done)
    for rounds in (0, 1):
        assert max(r.gap for r in G.certificate(G.fit_segments(train, k=4, max_iter=rounds, tol=0.0)).collect()) > 1e-3


def test_lloyd_from_given_centres_against_numpy(feats):
    train = G.training_rows(feats, min_orders=5)
    rows = train.orderBy("user_id").collect()
    x = np.array([[r[c] for c in G.FEATURES] for r in rows])
    std = x.std(axis=0, ddof=1)
    x, centres = x / std, x[[0, 7, 20]] / std
    # The last centre is far from every row and keeps its place.
    start, centres = [*(centres * std).tolist(), [1e6] * 6], np.vstack([centres, np.full(6, 1e6) / std])
    for rounds in (1, 6):
        want = centres
        for _ in range(rounds):
            near = ((x[:, None] - want) ** 2).sum(axis=2).argmin(axis=1)
            want = np.array([x[near == i].mean(axis=0) if (near == i).any() else want[i] for i in range(4)])
        got, scales = G.lloyd_from(train, start, rounds)
        assert np.allclose(got, want) and np.allclose([scales[c] for c in G.FEATURES], std)
        labels = {r.user_id: r.cluster for r in G.label_nearest(train, got, scales).collect()}
        near = ((x[:, None] - want) ** 2).sum(axis=2).argmin(axis=1)
        first = sorted(set(near.tolist()), key=lambda i: (-(near == i).sum(), min(r.user_id for r, n in zip(rows, near, strict=True) if n == i)))
        assert labels == {r.user_id: first.index(n) for r, n in zip(rows, near.tolist(), strict=True)}


def test_caps_by_prefix_counts(spark, monkeypatch):
    """Any number of passes gives the same keys; none of them sorts the keys."""
    import hashlib

    from basket.operators import sampling

    rows = [(u,) for u in range(500)] * 2 + [(None,)] * 300
    keys = spark.createDataFrame(rows, "user_id long").repartition(5)
    order = sorted([*range(500), None], key=lambda u: (hashlib.md5(f"42/cap/{'' if u is None else u}".encode()).hexdigest(), u or 0))
    for few in (0, 1, 10_000):
        monkeypatch.setattr(sampling, "_FEW", few)
        for cap in (1, 2, 100, 500, 501, 900):
            capped = sampling.hash_cap(keys, "user_id", cap, 42)
            assert {r.user_id for r in capped.collect()} == set(order[:cap]), (few, cap)
            assert "Sort" not in capped._jdf.queryExecution().executedPlan().toString()
    assert sampling.hash_cap(keys.limit(0), "user_id", 5, 42).collect() == []
    kept = sampling.sample_predicate(keys, "user_id", 1.0, 42, max_keys=7, step="x")
    assert kept is not None and keys.filter(kept).select("user_id").distinct().count() == 7


def test_given_centres_compute_the_features_once(spark, feats, monkeypatch):
    """Lloyd's rounds, the numbering and the labels of ``kmeans_from_centres`` read stored features."""
    import __spark_entry__ as E

    made = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def seen(_):
        made.add(1)
        return True

    active = G.training_rows(feats)
    monkeypatch.setattr(E, "_active", lambda spark, d: active.filter(seen("user_id")))
    assert len(E._active(spark, "").collect()) > 0
    once = made.value
    assert E._from_centres(spark, "").count() == active.count() and made.value == 2 * once > 0
