"""Command line: the batch report and single catalogue queries.

    python -m basket report --path DIR [--fmt csv|parquet] [--out DIR] [--n 10] [--min-count 200]
    python -m basket query KEY --path DIR [--fmt ...] [--param n=5 ...] [--limit 1000 | --out DIR]
    python -m basket build --star DIR --out DIR [--buckets auto|N|0]   # derive + store

The session comes from ``SparkSession.builder.getOrCreate()``, so under
``spark-submit`` the cluster settings apply unchanged.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from basket.plans import catalog
from basket.plans.report import query_records, run_report, write_result
from basket.sources.star import build_star_tables
from basket.sources.tables import load_tables


def _params(pairs: list[str]) -> dict[str, str]:
    out = {}
    for p in pairs:
        k, _, v = p.partition("=")
        out[k] = v
    return out


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="basket")
    sub = ap.add_subparsers(dest="cmd", required=True)
    rep = sub.add_parser("report")
    rep.add_argument("--path", required=True)
    rep.add_argument("--fmt", default="parquet", choices=["csv", "parquet"])
    rep.add_argument("--out")
    rep.add_argument("--n", type=int, default=10)
    rep.add_argument("--min-count", type=int, default=200)
    q = sub.add_parser("query")
    q.add_argument("key", choices=sorted(catalog.CATALOG))
    q.add_argument("--path", required=True)
    q.add_argument("--fmt", default="parquet", choices=["csv", "parquet"])
    q.add_argument("--param", action="append", default=[])
    q.add_argument("--limit", type=int)
    q.add_argument("--out", help="write the whole result as parquet instead")
    b = sub.add_parser("build")
    b.add_argument("--star", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--buckets", default="auto", help='order_id buckets: "auto", a number, or 0 for none')
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("basket").getOrCreate()
    if args.cmd == "build":
        buckets = args.buckets if args.buckets == "auto" else (int(args.buckets) or None)
        build_star_tables(spark, args.star, args.out, buckets=buckets)
        return
    tables = load_tables(spark, args.path, args.fmt)
    if args.cmd == "report":
        run_report(tables, args.out, show=args.out is None, n=args.n, min_count=args.min_count)
    else:
        if args.out:
            write_result(catalog.run(tables, args.key, **_params(args.param)), args.out)
            return
        found = query_records(tables, args.key, args.limit, **_params(args.param))
        for rec in found.rows:
            print(json.dumps(rec, default=str))
        if found.truncated:
            print(f"first {len(found.rows)} of {found.total} rows; --out DIR writes them all", file=sys.stderr)


if __name__ == "__main__":
    main()
