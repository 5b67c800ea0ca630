"""Ordered numbering inside groups, safe for hot groups.

A plain ``row_number() OVER (PARTITION BY g ORDER BY o)`` sends every row of a
group to one task; a customer (or, with no group at all, the whole table) that
holds a third of the rows would then run in a single task.  Here the rows are
range-partitioned on ``(group, order)`` instead, so a hot group is cut into
contiguous slices across many partitions.  Each slice is numbered locally with a
window on ``(partition, group)`` and the slices are stitched together with a
small per-partition-edge table (at most two rows per range partition, so its
size is bounded by the partition count, never by the data) that is broadcast.

The numbered slices are checkpointed once (reliable checkpoint in the session's
checkpoint folder).  That matters for correctness, not only lineage: Spark's
range partitioner draws its sample with a seed tied to the RDD id, so two
executions of the "same" range shuffle may cut at different bounds; every
branch below must see one partition assignment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basket.session import ensure_checkpoint_dir

_PID = "_sq_pid"
_LRN = "_sq_lrn"
_LCNT = "_sq_lcnt"
_OFF = "_sq_off"
_MORE = "_sq_more"


def _null_safe_on(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    cond = None
    for lc, rc in pairs:
        c = left[lc].eqNullSafe(right[rc])
        cond = c if cond is None else cond & c
    return cond


def sequence_within(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[str],
    *,
    lag_cols: Sequence[str] = (),
    seq_col: str = "seq",
    last_col: str = "is_last",
    lag_prefix: str = "prev_",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add the 1-based position of each row in its group, ordered ascending by
    ``order_cols``, a flag for the group's last row, and ``prev_<c>`` (the value of
    ``c`` on the previous row of the group, NULL on the first).

    ``order_cols`` must make the order total inside a group (end with a unique
    key), otherwise positions of tied rows are arbitrary.  ``group_cols`` may be
    empty: the whole input is then one sequence (a distributed row number).
    """
    keys = list(group_cols)
    order = list(order_cols)
    lags = list(lag_cols)
    # 1. Range-partition on the full sort key: hot groups span several partitions.
    # Without an explicit count AQE may coalesce the ranges; it only merges
    # adjacent ones, so partition ids stay contiguous and in key order.
    sort_key = [F.col(c).asc_nulls_first() for c in keys + order]
    if num_partitions:
        ranged = df.repartitionByRange(int(num_partitions), *sort_key)
    else:
        ranged = df.repartitionByRange(*sort_key)
    ranged = ranged.withColumn(_PID, F.spark_partition_id())

    # 2. Number each (partition, group) slice locally; one Window operator.
    w = Window.partitionBy(_PID, *keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    w_all = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    local = ranged.select(
        "*",
        F.row_number().over(w).alias(_LRN),
        F.count(F.lit(1)).over(w_all).alias(_LCNT),
        *[F.lag(c).over(w).alias(lag_prefix + c) for c in lags],
    )
    ensure_checkpoint_dir(df.sparkSession)
    local = local.checkpoint(eager=True)

    # 3. A group can continue into the next partition only as the last group of
    # one partition and the first group of the next.  Only group boundary rows
    # (first or last row of a local group) can be partition edges, so just those
    # feed one aggregate per partition (partial, so one row per task): the
    # smallest first row and the largest last row, ordered by the group key.
    # The last one carries the group's local count and its last values.
    boundary = local.filter((F.col(_LRN) == 1) | (F.col(_LRN) == F.col(_LCNT)))
    first = F.min(F.when(F.col(_LRN) == 1, F.struct(*keys, F.col(_LCNT).alias("_cnt"))))
    last = F.max(
        F.when(
            F.col(_LRN) == F.col(_LCNT),
            F.struct(*keys, F.col(_LCNT).alias("_cnt"), *[F.col(c).alias(f"_last_{c}") for c in lags]),
        )
    )
    edges = boundary.groupBy(_PID).agg(first.alias("_first"), last.alias("_last"))
    first_entry = F.struct(
        *[F.col(f"_first.{c}").alias(c) for c in keys],
        F.col("_first._cnt").alias("_cnt"),
        *[F.lit(None).alias(f"_last_{c}") for c in lags],
    )
    last_entry = F.struct(
        *[F.col(f"_last.{c}").alias(c) for c in keys],
        F.col("_last._cnt").alias("_cnt"),
        *[F.col(f"_last._last_{c}").alias(f"_last_{c}") for c in lags],
    )
    # A partition holding a single group lists it once.
    one_group = F.struct(*[F.col(f"_first.{c}") for c in keys]).eqNullSafe(
        F.struct(*[F.col(f"_last.{c}") for c in keys])
    ) if keys else F.lit(True)
    edge_rows = edges.select(
        _PID,
        F.explode(F.when(one_group, F.array(last_entry)).otherwise(F.array(first_entry, last_entry))).alias("e"),
    ).select(_PID, "e.*")
    # At most 2 rows per range partition: bounded by the partition count,
    # whatever the data size.
    fw = Window.partitionBy(*keys).orderBy(_PID) if keys else Window.orderBy(_PID)
    fix = edge_rows.select(
        F.col(_PID).alias("_f_pid"),
        *[F.col(c).alias(f"_f_{c}") for c in keys],
        F.sum("_cnt").over(fw.rowsBetween(Window.unboundedPreceding, -1)).alias(_OFF),
        F.lead(_PID).over(fw).isNotNull().alias(_MORE),
        *[F.lag(f"_last_{c}").over(fw).alias(f"_f_carry_{c}") for c in lags],
    ).checkpoint(eager=True)

    # 4. Stitch: fix has at most one row per (partition, edge group), so it is
    # bounded by twice the partition count and safe to broadcast.
    on = _null_safe_on(local, fix, [(_PID, "_f_pid")] + [(c, f"_f_{c}") for c in keys])
    joined = local.join(F.broadcast(fix), on, "left")
    off = F.coalesce(F.col(_OFF), F.lit(0))
    out = joined.select(
        *[F.col(c) for c in df.columns],
        (F.col(_LRN) + off).cast("long").alias(seq_col),
        ((F.col(_LRN) == F.col(_LCNT)) & ~F.coalesce(F.col(_MORE), F.lit(False))).alias(last_col),
        *[
            F.when((F.col(_LRN) == 1) & F.col(_OFF).isNotNull(), F.col(f"_f_carry_{c}"))
            .otherwise(F.col(lag_prefix + c))
            .alias(lag_prefix + c)
            for c in lags
        ],
    )
    return out


# Fixed value: a group with more rows than this is cut into slices.
HOT_GROUP_ROWS = 1_000_000


def sequence_by_group(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[str],
    *,
    lag_cols: Sequence[str] = (),
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """:func:`sequence_within` with one shuffle for all groups of ordinary size.

    Rows are counted per group first (a partial-then-final aggregate).  Groups of up to ``hot_rows``
    rows are numbered by a plain window; the others, at most rows / hot_rows of
    them and so safe to broadcast, take the sliced way.
    """
    keys, order = list(group_cols), [F.col(c).asc_nulls_first() for c in order_cols]
    ensure_checkpoint_dir(df.sparkSession)
    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > int(hot_rows))
    hot = large.select(*[F.col(c).alias(f"_h_{c}") for c in keys]).checkpoint(eager=True)

    def plain(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order)
        total = F.count(F.lit(1)).over(Window.partitionBy(*keys))
        seq = F.row_number().over(w)
        return rows.select(
            *df.columns,
            seq.cast("long").alias("seq"),
            (seq == total).alias("is_last"),
            *[F.lag(c).over(w).alias(f"prev_{c}") for c in lag_cols],
        )

    if hot.isEmpty():
        return plain(df)
    on = _null_safe_on(df, hot, [(c, f"_h_{c}") for c in keys])
    sliced = sequence_within(df.join(F.broadcast(hot), on, "left_semi"), keys, order_cols, lag_cols=lag_cols)
    return plain(df.join(F.broadcast(hot), on, "left_anti")).unionByName(sliced)


def dense_ids_by(df: DataFrame, kind_col: str, value_col: str, id_col: str, *, num_partitions: int | None = None) -> DataFrame:
    """Dense ranks of ``value`` computed separately for each ``kind`` in one pass:
    ``(kind, value, id)``.  Several small dictionaries share one range shuffle."""
    values = df.select(kind_col, value_col).distinct()
    ranked = sequence_within(values, [kind_col], [value_col], num_partitions=num_partitions)
    return ranked.select(kind_col, value_col, F.col("seq").alias(id_col))
