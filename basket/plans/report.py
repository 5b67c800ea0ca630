"""Result sinks: bounded records for a caller, full results to storage, the batch report."""

from __future__ import annotations

import os
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from basket.plans.catalog import CATALOG, LIMIT, result_limit, run
from basket.plans.cubes import KEYS, answer, build_cubes
from basket.sources.tables import Tables


@dataclass(frozen=True)
class Records:
    """Rows for a caller: the first ``len(rows)`` of ``total`` in a fixed order."""

    rows: list[dict[str, Any]]
    total: int

    @property
    def truncated(self) -> bool:
        return len(self.rows) < self.total


def to_records(df: DataFrame, limit: int = 1000, order: tuple[str, ...] = ()) -> Records:
    """At most ``limit`` rows as dicts, with the number of rows there are.

    ``order`` names the columns to sort by (all columns if none is given), so the rows do not
    depend on the layout; the bounded sort is a top-k.  The rows are counted on their way into it, so
    the query runs once.  For whole results use :func:`write_result`.
    """
    limit = LIMIT.check(limit)
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("total"))
    top = counted.orderBy(*(order or df.columns)).limit(limit).collect()
    total = len(top) if len(top) < limit else seen.get["total"]
    return Records([row.asDict(recursive=True) for row in top], total)


def query_records(tables: Tables, key: str, limit: int | None = None, **params: Any) -> Records:
    """Run one catalogue query and return its first rows: ``limit`` when given, else 200
    for department and profile results and 1000 otherwise.

    Ranked results keep their ranking (they are bounded already); others are ordered by key.
    """
    limit = LIMIT.check(result_limit(key) if limit is None else limit)
    result = run(tables, key, **params)
    if CATALOG[key].ranked:
        rows = [row.asDict(recursive=True) for row in result.take(limit)]
        return Records(rows, len(rows) if len(rows) < limit else result.count())
    return to_records(result, limit)


def write_result(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    df.write.mode(mode).format(fmt).save(path)


# The batch report covers the 16 non-ML queries, as the original console report did.
REPORT_KEYS = KEYS


def run_report(tables: Tables, out_dir: str | None = None, show: bool = False, **params: Any) -> dict[str, DataFrame]:
    """Build every report query; write each to ``out_dir/<key>`` and/or show all its rows.

    The fact is scanned twice for all of them (:mod:`basket.plans.cubes`); each query reads the stored aggregates.
    Every report result is small by nature (a fixed domain or a top-n).  ``params`` (n,
    min_count) apply to the queries that take them.
    """
    results = {}
    cubes = build_cubes(tables.orders.sparkSession, tables)
    for key in REPORT_KEYS:
        entry = CATALOG[key]
        own = {p.name: params[p.name] for p in entry.params if p.name in params}
        df = answer(cubes, key, **own)
        results[key] = df
        if out_dir is not None:
            write_result(df, os.path.join(out_dir, key))
        if show:
            print(f"== {entry.label} ==")
            df.show(max(1, df.count()), truncate=False)
    return results
