"""The command line runs a query and the report against stored tables."""

import json

from basket.__main__ import main
from basket.sources.star import build_star_tables
from tests.conftest import SF_SMALL


def test_cli_query_and_report(spark, tmp_path, capsys):
    build_star_tables(spark, SF_SMALL, str(tmp_path / "t"))
    main(["query", "top_users_by_orders", "--path", str(tmp_path / "t"), "--param", "n=3"])
    recs = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert len(recs) == 3 and set(recs[0]) == {"user_id", "num_orders"}
    main(["report", "--path", str(tmp_path / "t"), "--out", str(tmp_path / "r"), "--n", "4"])
    assert spark.read.parquet(str(tmp_path / "r" / "top_products")).count() == 4


def test_cli_says_what_it_cuts(spark, tmp_path, capsys):
    build_star_tables(spark, SF_SMALL, str(tmp_path / "t"))
    main(["query", "orders_by_hour", "--path", str(tmp_path / "t"), "--limit", "4"])
    said = capsys.readouterr()
    assert len(said.out.splitlines()) == 4 and "first 4 of 24" in said.err
    main(["query", "orders_by_hour", "--path", str(tmp_path / "t"), "--out", str(tmp_path / "all")])
    assert spark.read.parquet(str(tmp_path / "all")).count() == 24
