"""sequence_within / dense ids against a plain window (brute force), with a hot group."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from basket.operators.sequence import dense_ids_by, sequence_by_group, sequence_within


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(6000):
        g = 7 if rnd.random() < 0.4 else rnd.randint(0, 200)  # one group holds ~40 %
        if rnd.random() < 0.01:
            g = None
        rows.append((g, rnd.randint(0, 30), i, rnd.random()))
    return spark.createDataFrame(rows, "g long, d long, k long, v double")


@pytest.mark.parametrize("parts", [1, 5, 16])
def test_matches_window(spark, skewed, parts):
    s = sequence_within(skewed, ["g"], ["d", "k"], lag_cols=["v"], num_partitions=parts)
    w = Window.partitionBy("g").orderBy("d", "k")
    ref = skewed.select(
        "k",
        F.row_number().over(w).alias("rn"),
        F.lag("v").over(w).alias("lv"),
        (F.row_number().over(w) == F.count(F.lit(1)).over(Window.partitionBy("g"))).alias("last"),
    )
    j = s.join(ref, "k")
    bad = j.filter((F.col("seq") != F.col("rn")) | (F.col("is_last") != F.col("last")) | ~F.col("prev_v").eqNullSafe(F.col("lv")))
    assert j.count() == skewed.count()
    assert bad.count() == 0


def test_hot_group_is_spread(spark, skewed):
    """The hot group's rows land in several range partitions, not one task."""
    ranged = skewed.repartitionByRange(16, "g", "d", "k").withColumn("pid", F.spark_partition_id())
    assert ranged.filter(F.col("g") == 7).select("pid").distinct().count() > 4


def test_no_group_is_a_global_row_number(spark, skewed):
    s = sequence_within(skewed, [], ["k"], num_partitions=8)
    assert s.filter(F.col("seq") != F.col("k") + 1).count() == 0
    assert [r.k for r in s.filter("is_last").collect()] == [5999]


def test_dense_ids(spark):
    kinds = spark.createDataFrame([("x", "b"), ("x", "a"), ("y", "z"), ("y", "a"), ("x", "a")], "kind string, v string")
    got = sorted(tuple(r) for r in dense_ids_by(kinds, "kind", "v", "id").collect())
    assert got == [("x", "a", 1), ("x", "b", 2), ("y", "a", 1), ("y", "z", 2)]


def test_empty_input(spark):
    empty = spark.createDataFrame([], "g long, d long, k long, v double")
    assert sequence_within(empty, ["g"], ["d", "k"], lag_cols=["v"]).count() == 0
    assert sequence_within(empty, [], ["k"]).count() == 0


@pytest.mark.parametrize("hot_rows", [10, 1000, 10**9])
def test_by_group_equals_the_sliced_way(spark, skewed, hot_rows):
    a = sequence_by_group(skewed, ["g"], ["d", "k"], lag_cols=["v"], hot_rows=hot_rows)
    b = sequence_within(skewed, ["g"], ["d", "k"], lag_cols=["v"])
    assert a.count() == skewed.count() and a.exceptAll(b.select(a.columns)).count() == 0


def test_ordinary_groups_take_one_shuffle(spark, skewed):
    plan = sequence_by_group(skewed, ["g"], ["d", "k"], lag_cols=["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "rangepartitioning" not in plan
