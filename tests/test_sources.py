"""Temp views (A4), opt-in persistence (A5/A6), split accessors."""

from pyspark import StorageLevel

from basket.sources.tables import persist_tables, register_views, unpersist_tables
from tests.mini import item, make, orders_row


def _t(spark):
    return make(
        spark,
        [orders_row(1, 1), orders_row(2, 1, "train", 2)],
        [item(1, 10, 0), item(1, 20, 1)],
        [item(2, 10, 1)],
    )


def test_views_answer_sql(spark):
    t = _t(spark)
    register_views(t)
    assert spark.sql("SELECT count(*) FROM op_prior").collect()[0][0] == 2
    assert spark.sql("SELECT count(*) FROM op_train").collect()[0][0] == 1
    got = spark.sql(
        "SELECT d.department, count(*) AS n FROM order_items i JOIN products p USING (product_id) "
        "JOIN departments d USING (department_id) GROUP BY d.department ORDER BY d.department"
    ).collect()
    assert [tuple(r) for r in got] == [("dairy", 1), ("produce", 2)]
    assert {r.name for r in spark.catalog.listTables()} >= {"orders", "op_prior", "op_train", "products", "aisles", "departments"}


def test_persist_and_unpersist(spark):
    t = persist_tables(_t(spark))
    assert t.orders.storageLevel == StorageLevel.MEMORY_AND_DISK
    assert t.products.is_cached and t.departments.is_cached
    assert t.order_items.count() == 3
    unpersist_tables(t)
    assert not t.orders.is_cached and not t.products.is_cached
    m = persist_tables(_t(spark), materialize=True)
    assert m.orders.is_cached and m.order_items.count() == 3
    unpersist_tables(m)


def test_split_accessors_drop_label(spark):
    t = _t(spark)
    assert t.op_prior.columns == ["order_id", "product_id", "add_to_cart_order", "reordered"]
    assert t.op_prior.count() == 2 and t.op_train.count() == 1


def test_load_with_views(spark, tmp_path):
    from basket.sources.tables import load_tables, save_tables

    save_tables(_t(spark), str(tmp_path / "t"))
    load_tables(spark, str(tmp_path / "t"), views=True)
    assert spark.sql("SELECT count(*) FROM order_items").collect()[0][0] == 3


def _tables_in_catalog(spark):
    return {r.tableName for r in spark.sql("SHOW TABLES").collect() if r.tableName.startswith("basket_")}


def test_plain_save_over_a_bucketed_one(spark, tmp_path):
    from basket.sources.tables import load_tables, save_tables

    path = str(tmp_path / "t")
    save_tables(_t(spark), path, buckets=2)
    assert load_tables(spark, path).order_items.groupBy("order_id").count().count() == 2
    save_tables(_t(spark), path)
    assert load_tables(spark, path).order_items.groupBy("order_id").count().count() == 2
    save_tables(_t(spark), path, buckets=3)
    assert load_tables(spark, path).order_items.groupBy("order_id").count().count() == 2


def test_relative_and_quoted_paths(spark, tmp_path, monkeypatch):
    import os
    import shutil

    from basket.sources.tables import load_tables, save_tables

    name = f"rel-{os.getpid()} it's"
    try:
        save_tables(_t(spark), name, buckets=2)
        # relative paths are resolved where Spark resolves them, for every table alike
        assert sorted(x for x in os.listdir(name) if not x.startswith(".")) == ["_layout", "aisles", "departments", "order_items", "orders", "products"]
        assert load_tables(spark, name).order_items.count() == load_tables(spark, os.path.abspath(name)).order_items.count() == 3
    finally:
        shutil.rmtree(name, ignore_errors=True)


def test_loads_do_not_pile_up_in_the_catalog(spark, tmp_path):
    from basket.sources.tables import load_tables, save_tables

    before, path = _tables_in_catalog(spark), str(tmp_path / "t")
    for _ in range(2):
        save_tables(_t(spark), path, buckets=2)
        for _ in range(3):
            load_tables(spark, path)
    assert len(_tables_in_catalog(spark) - before) == 2


def test_scratch_folders_are_marked_for_deletion(spark):
    import os

    from basket.session import scratch_folder

    path = scratch_folder(spark, "x")
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    assert os.path.isdir(path.removeprefix("file:")) and fs.cancelDeleteOnExit(p)
    fs.delete(p, True)


CSV = {
    "orders.csv": "order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order\n1,1,prior,1,2,9,\nx,1,train,2,3,10,7.0\n",
    "order_products__prior.csv": "order_id,product_id,add_to_cart_order,reordered\n1,10,1,0\n",
    "order_products__train.csv": "order_id,product_id,add_to_cart_order,reordered\n2,10,1,1\n",
    "products.csv": 'product_id,product_name,aisle_id,department_id\n10,"0% Greek, ""Blended"" Yogurt",1,1\n',
    "aisles.csv": "aisle_id,aisle\n1,a\n",
    "departments.csv": "department_id,department\n1,d\n",
}


def test_csv_bad_records_and_quotes(spark, tmp_path):
    from basket.sources.tables import bad_records, load_tables, save_csv

    for name, text in CSV.items():
        (tmp_path / name).write_text(text)
    assert [tuple(r) for r in bad_records(spark, str(tmp_path)).collect()] == [("orders.csv", "x,1,train,2,3,10,7.0")]
    t = load_tables(spark, str(tmp_path), "csv")
    assert t.products.first().product_name == '0% Greek, "Blended" Yogurt'
    save_csv(t, str(tmp_path / "again"))
    back = load_tables(spark, str(tmp_path / "again"), "csv")
    assert back.products.collect() == t.products.collect() and back.order_items.count() == 2


def test_cached_tables_are_always_released(spark):
    import pytest

    from basket.sources.tables import cached_tables

    def held():
        return spark.sparkContext._jsc.sc().getPersistentRDDs().size()

    before, t = held(), _t(spark)
    with cached_tables(t) as c:
        # Dimensions included: five tables are filled on entry.
        assert held() == before + 5 and c.departments.is_cached and c.order_items.count() == 3
        assert "InMemoryTableScan" in c.products._jdf.queryExecution().executedPlan().toString()
    assert held() == before
    with pytest.raises(RuntimeError), cached_tables(t):
        raise RuntimeError
    assert held() == before
    assert "InMemoryTableScan" not in t.orders._jdf.queryExecution().executedPlan().toString()


def test_caches_of_the_caller_stay(spark):
    from basket.sources.tables import cached_tables

    t = _t(spark)
    t.orders.cache().count()
    try:
        with cached_tables(t):
            pass
        assert t.orders.is_cached and "InMemoryTableScan" in t.orders.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        t.orders.unpersist()


def test_quarantine_is_one_parse(spark, tmp_path):
    """Good and corrupt rows of every file from one job each; good rows carry no NULLs of corrupt ones."""
    from basket.sources.tables import bad_records, load_quarantined, quarantine, quarantined, save_csv

    src, out = str(tmp_path / "csv"), str(tmp_path / "out")
    save_csv(_t(spark), src)
    (tmp_path / "csv" / "orders.csv" / "part-x.csv").write_text(
        "order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order\n"
        'x,1,train,2,3,10,7.0\n9,1,train,2,3,10\n8,1,"a ""quoted"" set",2,3,10,7.0\n'
    )
    counts = {r.file: (r.good, r.bad) for r in quarantine(spark, src, out).collect()}
    assert counts["orders.csv"] == (3, 2) and counts["aisles.csv"][1] == 0 and len(counts) == 6
    found = sorted(tuple(r) for r in quarantined(spark, out).collect())
    assert found == sorted(tuple(r) for r in bad_records(spark, src).collect()) and len(found) == 2
    kept = load_quarantined(spark, out)
    assert sorted(r.order_id for r in kept.orders.collect()) == [1, 2, 8] and kept.order_items.count() == 3
    assert [r.eval_set for r in kept.orders.filter("order_id = 8").collect()] == ['a "quoted" set']
