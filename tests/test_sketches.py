"""Stored distinct-count sketches."""

from pyspark.sql import functions as F

from basket.operators.sketches import distinct_sketches, error_bound, estimate, merge_sketches


def test_estimates_keep_their_bound_and_unions_count_once(spark, tmp_path):
    rows = spark.range(60_000).selectExpr("id % 7 AS g", "id % 2 AS half", "IF(id % 11 = 0, NULL, id % 20011) AS v")
    exact = {r.g: r.n for r in rows.groupBy("g").agg(F.count_distinct("v").alias("n")).collect()}
    distinct_sketches(rows, ["half", "g"], "v").write.parquet(str(tmp_path / "s"))
    united = merge_sketches(spark.read.parquet(str(tmp_path / "s")), ["g"])
    found = united.select("g", estimate().alias("e")).join(spark.createDataFrame(list(exact.items()), "g long, n long"), "g")
    for r in found.withColumn("ok", F.abs(F.col("e") - F.col("n")) <= error_bound("n")).collect():
        assert r.ok, r
    twice = merge_sketches(united.unionByName(united), ["g"]).select("g", estimate().alias("e"))
    assert sorted(twice.collect()) == sorted(united.select("g", estimate().alias("e")).collect())


def test_nulls_and_empty(spark):
    none = spark.createDataFrame([(1, None), (1, None)], "g long, v long")
    assert distinct_sketches(none, ["g"], "v").select(estimate().alias("e")).head().e == 0
    assert distinct_sketches(none.limit(0), ["g"], "v").collect() == []
