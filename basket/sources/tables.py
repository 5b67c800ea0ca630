"""The table bundle, its readers and writers.

Two on-disk layouts are read:

* ``csv``: the six-file layout of the original data set (``orders.csv``,
  ``order_products__prior.csv``, ``order_products__train.csv``,
  ``products.csv``, ``aisles.csv``, ``departments.csv``), header line, read
  with explicit schemas (no inference pass).  Malformed values become NULL in
  ``PERMISSIVE`` mode or fail the read in ``FAILFAST`` mode; :func:`bad_records`
  shows the malformed lines.  A doubled quote inside a quoted field is one quote.
* ``parquet``: the layout :func:`save_tables` writes: the two split files are
  one ``order_items`` fact partitioned by ``eval_set`` (a filter on the split
  prunes whole directories), ``orders`` sorted by ``order_id`` inside files so
  row-group statistics skip on it, dimensions as plain parquet.  Optionally the
  fact and orders are bucketed by ``order_id`` (see :func:`save_tables`), the
  items of very large orders in an unbucketed table of their own; every save records
  its layout next to the tables.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from basket.session import ensure_checkpoint_dir, qualified, run_concurrently
from basket.sources import schema as S


@dataclass(frozen=True)
class Tables:
    orders: DataFrame
    order_items: DataFrame  # both splits, with an eval_set column naming the split
    products: DataFrame
    aisles: DataFrame
    departments: DataFrame
    # order_items in parts with disjoint orders, when it is stored so
    parts: tuple[DataFrame, ...] = ()
    # read from files that say nothing of where an order's items are (the csv layout)
    raw: bool = False

    @property
    def item_parts(self) -> tuple[DataFrame, ...]:
        """What per-order aggregates read: each part keeps its own partitioning."""
        return self.parts or (self.order_items,)

    @property
    def op_prior(self) -> DataFrame:
        return split_items(self.order_items, S.PRIOR)

    @property
    def op_train(self) -> DataFrame:
        return split_items(self.order_items, S.TRAIN)


def order_items(op_prior: DataFrame, op_train: DataFrame) -> DataFrame:
    """Union of the two split tables; the label says which table a row came from."""
    cols = [f.name for f in S.ORDER_PRODUCTS.fields]
    return op_prior.select(*cols, F.lit(S.PRIOR).alias("eval_set")).unionByName(
        op_train.select(*cols, F.lit(S.TRAIN).alias("eval_set"))
    )


def split_items(items: DataFrame, split: str) -> DataFrame:
    return items.filter(F.col("eval_set") == split).drop("eval_set")


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the schema's columns with its types; bad values become NULL."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


CORRUPT, BAD = "_corrupt_record", "_bad"


def _csv(spark: SparkSession, path: str, schema: StructType, mode: str, corrupt: bool = False) -> DataFrame:
    # enforceSchema=false: the header names are checked against the schema
    # instead of columns being taken by position.
    wanted = StructType([*schema.fields, StructField(CORRUPT, StringType())]) if corrupt else schema
    return (
        spark.read.schema(wanted)
        .option("header", True)
        .option("enforceSchema", corrupt)
        .option("escape", '"')
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


# The files of the csv layout and their schemas.
CSV_FILES = {
    "orders.csv": S.ORDERS,
    "order_products__prior.csv": S.ORDER_PRODUCTS,
    "order_products__train.csv": S.ORDER_PRODUCTS,
    "products.csv": S.PRODUCTS,
    "aisles.csv": S.AISLES,
    "departments.csv": S.DEPARTMENTS,
}


def bad_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, record``: every line of the csv layout that its schema cannot read, as it stands."""
    found = [
        _csv(spark, os.path.join(path, name), schema, "PERMISSIVE", corrupt=True)
        # The reader marks a line only when its columns are parsed: the condition reads them all.
        .filter(F.col(CORRUPT).isNotNull() & (F.length(F.to_json(F.struct(*schema.names))) > 0))
        .select(F.lit(name).alias("file"), F.col(CORRUPT).alias("record"))
        for name, schema in CSV_FILES.items()
    ]
    return reduce(DataFrame.unionByName, found)


def quarantine(spark: SparkSession, path: str, out: str) -> DataFrame:
    """Read the csv layout below ``path`` once and store it below ``out``, good rows apart from corrupt ones.

    Each file is parsed by one job, which writes both kinds and counts them on the way.  Returns ``file, good, bad``;
    :func:`load_quarantined` and :func:`quarantined` read the two sides.
    """

    def store(name: str, schema: StructType) -> tuple[str, int, int]:
        seen = Observation()
        rows = _csv(spark, os.path.join(path, name), schema, "PERMISSIVE", corrupt=True)
        # Written with all its columns, every line is parsed whole and so marked where it is corrupt.
        split = rows.withColumn(BAD, F.col(CORRUPT).isNotNull())
        counted = split.observe(seen, F.count_if(~F.col(BAD)).alias("good"), F.count_if(F.col(BAD)).alias("bad"))
        counted.write.mode("overwrite").partitionBy(BAD).parquet(os.path.join(out, name))
        return name, seen.get["good"], seen.get["bad"]

    counts = run_concurrently(*[lambda n=n, s=s: store(n, s) for n, s in CSV_FILES.items()])
    return spark.createDataFrame(counts, "file string, good long, bad long")


def _side(spark: SparkSession, out: str, name: str, bad: bool) -> DataFrame:
    schema = StructType([*CSV_FILES[name].fields, StructField(CORRUPT, StringType()), StructField(BAD, BooleanType())])
    return spark.read.schema(schema).parquet(os.path.join(out, name)).filter(F.col(BAD) == F.lit(bad))


def load_quarantined(spark: SparkSession, out: str) -> Tables:
    """The bundle of the good rows that :func:`quarantine` stored; corrupt lines are left out, not read as NULLs."""
    orders, prior, train, products, aisles, departments = (
        _side(spark, out, name, False).select(*schema.names) for name, schema in CSV_FILES.items()
    )
    return Tables(orders, order_items(prior, train), products, aisles, departments, raw=True)


def quarantined(spark: SparkSession, out: str) -> DataFrame:
    """``file, record``: the corrupt lines that :func:`quarantine` stored."""
    found = [
        _side(spark, out, name, True).select(F.lit(name).alias("file"), F.col(CORRUPT).alias("record")) for name in CSV_FILES
    ]
    return reduce(DataFrame.unionByName, found)


def save_csv(tables: Tables, path: str, mode: str = "overwrite") -> None:
    """Write the bundle as the csv layout (each file a folder of part files)."""
    frames = (tables.orders, tables.op_prior, tables.op_train, tables.products, tables.aisles, tables.departments)
    for (name, schema), df in zip(CSV_FILES.items(), frames, strict=True):
        df.select(*schema.names).write.mode(mode).option("header", True).option("escape", '"').csv(os.path.join(path, name))


def load_tables(
    spark: SparkSession, path: str, fmt: str = "parquet", mode: str = "PERMISSIVE", views: bool = False
) -> Tables:
    """Read the bundle (lazy); ``views=True`` also registers the temp views."""
    tables = _read_tables(spark, path, fmt, mode)
    if views:
        register_views(tables)
    return tables


def _read_tables(spark: SparkSession, path: str, fmt: str, mode: str) -> Tables:
    if fmt == "csv":
        j = lambda name: os.path.join(path, name)
        prior = _csv(spark, j("order_products__prior.csv"), S.ORDER_PRODUCTS, mode)
        train = _csv(spark, j("order_products__train.csv"), S.ORDER_PRODUCTS, mode)
        return Tables(
            orders=_csv(spark, j("orders.csv"), S.ORDERS, mode),
            order_items=order_items(prior, train),
            products=_csv(spark, j("products.csv"), S.PRODUCTS, mode),
            aisles=_csv(spark, j("aisles.csv"), S.AISLES, mode),
            departments=_csv(spark, j("departments.csv"), S.DEPARTMENTS, mode),
            raw=True,
        )
    if fmt == "parquet":
        path = qualified(spark, path)
        p = lambda name: spark.read.parquet(os.path.join(path, name))
        layout = _layout(spark, path)
        if layout and layout["buckets"]:
            tag, n = layout["tag"], layout["buckets"]
            items = _attach_bucketed(spark, os.path.join(path, "order_items"), S.ORDER_ITEMS, n, tag, "eval_set")
            orders = _attach_bucketed(spark, os.path.join(path, "orders"), S.ORDERS, n, tag)
            parts = [items, p(HOT)] if layout["hot"] else [items]
        else:
            parts, orders = [p("order_items")], p("orders")
        parts = [conform(part, S.ORDER_ITEMS) for part in parts]
        return Tables(
            orders=conform(orders, S.ORDERS),
            order_items=reduce(DataFrame.unionByName, parts),
            products=conform(p("products"), S.PRODUCTS),
            aisles=conform(p("aisles"), S.AISLES),
            departments=conform(p("departments"), S.DEPARTMENTS),
            parts=tuple(parts),
        )
    raise ValueError(f"unknown format {fmt!r}; use 'csv' or 'parquet'")


# Fixed value: an order with more items than this stays out of the buckets.
HOT_ORDER_ROWS = 1_000_000


def save_tables(
    tables: Tables,
    path: str,
    mode: str = "overwrite",
    buckets: int | None = None,
    hot_order_rows: int = HOT_ORDER_ROWS,
    item_orders: DataFrame | None = None,
) -> None:
    """Write the bundle in the parquet layout :func:`load_tables` reads.

    With ``buckets``, ``order_items`` and ``orders`` are also bucketed (and
    sorted) by ``order_id`` into that many buckets: per-order aggregates of the
    fact and the fact-to-orders joins then need no shuffle at all.  The write
    pays one shuffle on order_id for it (one file per bucket and split, not one
    per task and bucket).  A bucket is read by one task, so the items of orders
    with more than ``hot_order_rows`` items go to a plain table beside the bucketed one.
    ``item_orders`` has the order_id of each item, where that is stored already: the orders are
    counted there then, and the items are computed for the write alone.
    The writes are submitted side by side; the layout record comes last.
    """
    spark = tables.orders.sparkSession
    path = qualified(spark, path)
    j = lambda name: os.path.join(path, name)
    tag, hot = uuid.uuid4().hex[:12], 0
    if buckets:
        items = tables.order_items
        # There are at most rows / hot_order_rows such orders, so their ids are few.
        counted = items if item_orders is None else item_orders
        large = counted.groupBy("order_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > int(hot_order_rows))
        ensure_checkpoint_dir(spark)
        ids = large.select(F.col("order_id").alias("_hot")).checkpoint()
        hot = ids.count()
        cold = items
        writes = []
        if hot:
            on = items["order_id"].eqNullSafe(ids["_hot"])
            cold = items.join(F.broadcast(ids), on, "left_anti")
            apart = items.join(F.broadcast(ids), on, "left_semi")
            writes.append(lambda: apart.write.mode(mode).partitionBy("eval_set").parquet(j(HOT)))
        writes += [
            lambda: _write_bucketed(cold, j("order_items"), f"basket_items_{tag}", buckets, mode, "eval_set"),
            lambda: _write_bucketed(tables.orders, j("orders"), f"basket_orders_{tag}", buckets, mode),
        ]
    else:
        writes = [
            # No extra shuffle for the layout: each task writes its rows into the
            # split directories (the writer sorts locally by eval_set).
            lambda: tables.order_items.write.mode(mode).partitionBy("eval_set").parquet(j("order_items")),
            lambda: tables.orders.sortWithinPartitions("order_id").write.mode(mode).parquet(j("orders")),
        ]
    # Dimensions: no coalesce(1) -- the product dictionary grows with the data;
    # AQE already merges small result partitions into few files.
    for name in ("products", "aisles", "departments"):
        writes.append(lambda name=name: getattr(tables, name).write.mode(mode).parquet(j(name)))
    run_concurrently(*writes)
    record = [(int(buckets or 0), int(hot), tag)]
    spark.createDataFrame(record, "buckets int, hot long, tag string").write.mode("overwrite").json(j(LAYOUT))


# Layout record next to the tables: the bucket count (0: none), the number of hot orders, a tag of the save.
LAYOUT = "_layout"
# Items of the orders that are too large for a bucket.
HOT = "order_items_hot"


def _write_bucketed(df: DataFrame, path: str, name: str, buckets: int, mode: str, partition: str | None = None) -> None:
    # repartition uses the same hash as bucketing: each task holds one bucket.
    w = df.repartition(int(buckets), "order_id").write.mode(mode).format("parquet").option("path", path)
    if partition:
        w = w.partitionBy(partition)
    w.bucketBy(int(buckets), "order_id").sortBy("order_id").saveAsTable(name)
    # The files stay (an external table); readers attach them under a name of their own.
    df.sparkSession.sql(f"DROP TABLE {name}")


def _layout(spark: SparkSession, path: str) -> dict | None:
    try:
        row = spark.read.schema("buckets int, hot long, tag string").json(os.path.join(path, LAYOUT)).first()
    except AnalysisException:
        return None
    return row.asDict() if row is not None else None


def _attach_bucketed(
    spark: SparkSession, path: str, schema: StructType, buckets: int, tag: str, partition: str | None = None
) -> DataFrame:
    """Register stored bucketed data as a catalog table (the bucketing lives in
    the catalog, not in the files) and read it through the table.

    One name for each path and save, used again by later loads; names of earlier saves to the path are dropped.
    """
    place = f"basket_{hashlib.md5(path.encode()).hexdigest()[:12]}_"
    name = place + tag
    for t in spark.sql(f"SHOW TABLES LIKE '{place}*'").collect():
        if t["tableName"] != name:
            spark.sql(f"DROP TABLE IF EXISTS {t['tableName']}")
    if not spark.catalog.tableExists(name):
        cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        parts = f"PARTITIONED BY ({partition}) " if partition else ""
        location = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({cols}) USING parquet {parts}"
            f"CLUSTERED BY (order_id) SORTED BY (order_id) INTO {int(buckets)} BUCKETS LOCATION '{location}'"
        )
        if partition:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)


def register_views(tables: Tables) -> None:
    """Temp views under the reference's names, plus the unified fact."""
    tables.orders.createOrReplaceTempView("orders")
    tables.op_prior.createOrReplaceTempView("op_prior")
    tables.op_train.createOrReplaceTempView("op_train")
    tables.order_items.createOrReplaceTempView("order_items")
    tables.products.createOrReplaceTempView("products")
    tables.aisles.createOrReplaceTempView("aisles")
    tables.departments.createOrReplaceTempView("departments")


def persist_tables(
    tables: Tables, level: StorageLevel = StorageLevel.MEMORY_AND_DISK, materialize: bool = False
) -> Tables:
    """Opt-in caching of the bundle: dimensions in memory, orders and facts at ``level``.

    Pair with :func:`unpersist_tables`.  Lazy unless ``materialize``: then one
    count per table fills the caches (side by side), as a warm-up before serving.
    """
    cached = Tables(
        orders=tables.orders.persist(level),
        order_items=tables.order_items.persist(level),
        products=tables.products.cache(),
        aisles=tables.aisles.cache(),
        departments=tables.departments.cache(),
        parts=(),
        raw=tables.raw,
    )
    if materialize:
        run_concurrently(
            *[
                (lambda df=df: df.count())
                for df in (cached.orders, cached.order_items, cached.products, cached.aisles, cached.departments)
            ]
        )
    return cached


def unpersist_tables(tables: Tables) -> None:
    for df in (tables.orders, tables.order_items, tables.products, tables.aisles, tables.departments):
        df.unpersist()


@contextmanager
def cached_tables(tables: Tables, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[Tables]:
    """The bundle in memory for the length of a ``with`` block, dimensions included.

    Filled on entry and released on exit, also after an error, so later queries read the stored layout again.
    Results that outlive the block must be written inside it.  What the caller had cached before stays cached.
    """
    # Copies, as a DataFrame remembers its own caching; what the caller has cached before stays so.
    own = tables.orders, tables.order_items, tables.products, tables.aisles, tables.departments
    before = [df.storageLevel.useMemory or df.storageLevel.useDisk for df in own]
    cached = persist_tables(Tables(*[df.select("*") for df in own], raw=tables.raw), level)
    frames = cached.orders, cached.order_items, cached.products, cached.aisles, cached.departments
    try:
        run_concurrently(*[df.count for df in frames])
        yield cached
    finally:
        for df, was in zip(frames, before, strict=True):
            if not was:
                df.unpersist(blocking=True)
