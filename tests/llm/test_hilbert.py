import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from basket.llm import hilbert


def walk(dims, bits):
    """The curve by the state machine alone: cell of each index."""
    following, digit = hilbert.curve_tables(dims)
    inverse = {(s, digit[s * 2**dims + g]): (g, following[s * 2**dims + g]) for s in range(dims * 2**dims) for g in range(2**dims)}
    cells = []
    for h in range(2 ** (dims * bits)):
        state, cell = 0, [0] * dims
        for level in range(bits - 1, -1, -1):
            given, state = inverse[state, (h >> (dims * level)) & (2**dims - 1)]
            for j in range(dims):
                cell[j] = cell[j] << 1 | (given >> j) & 1
        cells.append(tuple(cell))
    return cells


@pytest.mark.parametrize("dims, bits", [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_by_unit_steps(dims, bits):
    cells = walk(dims, bits)
    assert len(set(cells)) == len(cells)
    for a, b in zip(cells, cells[1:], strict=False):
        assert sum(abs(x - y) for x, y in zip(a, b, strict=True)) == 1


def test_expression_equals_the_walk(spark):
    cells = walk(3, 2)
    df = spark.createDataFrame([(*c, h) for h, c in enumerate(cells)], "x int, y int, z int, h long")
    got = df.select("h", hilbert.hilbert_index([F.col("x"), F.col("y"), F.col("z")], bits=2).alias("g")).collect()
    assert all(r.h == r.g for r in got)


def check(rows, docs, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs
    )
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))
    ordered = sorted(rows, key=lambda r: (r.shard, r.slot))
    curve = [r.curve for r in ordered]
    assert curve == sorted(curve)


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_rows_law(spark, documents, shards):
    check(hilbert.assign(documents.repartition(7), shards).collect(), [(r.doc_id, r.text) for r in documents.collect()], shards)


def test_odd_rows(spark, odd, none):
    wide = odd.selectExpr("*", "1 AS curve", "2 AS size", "3 AS shard")
    check(hilbert.assign(wide).collect(), [(r.doc_id, r.text) for r in odd.collect()], 8)
    assert hilbert.assign(none).collect() == []


def test_copies_with_equal_metadata_stand_together(spark, documents):
    rows = hilbert.assign(documents.unionByName(documents), 1).orderBy("slot").collect()
    assert all(a.doc_id == b.doc_id for a, b in zip(rows[::2], rows[1::2], strict=True))


def test_written_shards_prune(spark, documents, path):
    hilbert.write_shards(documents, path, shards=8)
    back = spark.read.parquet(path)
    assert back.count() == documents.count()
    assert {r.doc_id: r.text for r in back.collect()} == {r.doc_id: r.text for r in documents.collect()}
    stats = hilbert.manifest(back)
    files = hilbert.files_for(stats, lang=("de", "de"), size=(1, 2000))
    kept = back.withColumn("file", F.input_file_name()).join(files, "file", "left_semi")
    want = back.filter("lang = 'de' AND size BETWEEN 1 AND 2000").count()
    assert kept.filter("lang = 'de' AND size BETWEEN 1 AND 2000").count() == want
    assert files.count() < stats.count()


def test_runs_no_python(spark, documents):
    plan = hilbert.assign(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
