import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basket.llm import resampling
from basket.llm.resampling import bucketed, cutoff, gains, resample, weighted_median
from tests.oracle import compare, duck

SMALL = "/root/testdata/sf0.001"


def features(text, ngram):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    return [" ".join(words[i : i + n]) for n in range(1, ngram + 1) for i in range(len(words) - n + 1)], len(words)


def bucket(feature, buckets):
    return zlib.crc32(feature.encode()) % buckets


def plain(docs, target, ngram, buckets, seed, least, percent):
    """(doc_id, n_features, weight, score, rank) of every row, in the order of the rows."""
    own = [features(t, ngram) for _, t in docs]
    s = Counter(bucket(f, buckets) for fs, _ in own for f in fs)
    t = Counter(bucket(f, buckets) for text in target for f in features(text, ngram)[0])
    total_s, total_t = sum(s.values()), sum(t.values())
    rows = []
    for i, ((doc_id, _), (fs, n)) in enumerate(zip(docs, own, strict=True)):
        weight = sum(
            math.floor(1000 * math.log(float(t[b] + 1) * (total_s + buckets) / (float(s[b] + 1) * (total_t + buckets))))
            for b in (bucket(f, buckets) for f in fs)
        )
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(fs), weight, score, n, i))
    ranked = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[5]))
    rank = {r[5]: k + 1 for k, r in enumerate(ranked[: percent * len(ranked) // 100])}
    return [(*r[:4], rank.get(r[5])) for r in rows]


def got(df):
    return sorted([(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()], key=repr)


@pytest.mark.parametrize("ngram, least, percent", [(1, 20, 10), (2, 3, 40), (3, 0, 100), (1, 5, 0)])
def test_against_plain(spark, documents, ngram, least, percent):
    target = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    out = resample(documents, target, ngram, 997, 5, least, percent)
    docs, wanted = [(r.doc_id, r.text) for r in documents.collect()], [r.text for r in target.collect()]
    assert got(out) == sorted(plain(docs, wanted, ngram, 997, 5, least, percent), key=repr)


def test_odd_rows(spark, odd, none):
    """Nulls, repeated rows, extra columns: equal rows may change places, so their ranks are compared as a set."""
    target = spark.createDataFrame([("the same text",), (None,), ("",)], "text string")
    out = resample(odd.withColumnRenamed("items", "k0"), target, 1, 50, 1, 1, 60)
    assert out.columns[-4:] == ["weight", "n_words", "score", "rank"] and "k0" in out.columns and "text" not in out.columns
    want = plain([(r.doc_id, r.text) for r in odd.collect()], ["the same text", None, ""], 1, 50, 1, 1, 60)
    assert got(out) == sorted(want, key=repr)
    assert resample(none, target).collect() == []
    assert {r["rank"] for r in resample(odd, none).collect()} == {None}


def test_hot_ids_and_ties(spark):
    """Half of all rows with one id and text: the draw is exact though the scores are equal."""
    rows = [(5, "a b c")] * 300 + [(i, "a b c") for i in range(200)] + [(None, "a b c")] * 100
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    out = resample(docs, spark.createDataFrame([("a",)], "text string"), 1, 10, 0, 1, 30).collect()
    assert sorted(r["rank"] for r in out if r["rank"]) == list(range(1, 181))
    ranked = sorted((r for r in out if r["rank"]), key=lambda r: r["rank"])
    assert [r.score for r in ranked] == sorted((r.score for r in out), reverse=True)[:180]
    for a, b in zip(ranked, ranked[1:], strict=False):
        assert a.score > b.score or (a.doc_id is not None, a.doc_id or 0) <= (b.doc_id is not None, b.doc_id or 0)


def test_matches_sql(spark):
    from basket.llm.registry import op12_resampling, oracle_sql

    assert compare(op12_resampling(spark, SMALL), duck(SMALL), oracle_sql()["op12_resampling"]) is None


@pytest.mark.parametrize("at_once", [0, 20])
def test_rounds_discard_guaranteed_fractions(spark, tmp_path, at_once):
    rnd = random.Random(3)
    keys = [(rnd.choice([1, 1, 1, rnd.randint(-50, 50)]), rnd.randint(-3, 3), -i) for i in range(2000)]
    out = str(tmp_path / "keys")
    spark.createDataFrame(keys, "k0 long, k1 long, k2 long").repartition(7).write.parquet(out)
    stored, ordered = spark.read.parquet(out), sorted(keys, reverse=True)
    for k in (1, 777, 2000):
        found, rounds = cutoff(stored, k, block=100, at_once=at_once)
        assert found == ordered[k - 1]
        # Blocks of an even number of keys have their upper median, hence the few keys beyond three quarters.
        assert all(b <= 0.75 * a + 30 for a, b in zip(rounds, rounds[1:], strict=False))
    assert cutoff(stored, 0) == (None, [])
    with pytest.raises(ValueError):
        cutoff(stored, 2001)


def test_weighted_median():
    rnd = random.Random(1)
    for _ in range(200):
        parts = [[rnd.randint(0, 99) for _ in range(rnd.randint(1, 30))] for _ in range(rnd.randint(1, 9))]
        pivot = weighted_median([(len(p), sorted(p)[len(p) // 2]) for p in parts])
        every = [x for p in parts for x in p]
        assert 4 * sum(x >= pivot for x in every) >= len(every) - 4 * len(parts)
        assert 4 * sum(x <= pivot for x in every) >= len(every) - 4 * len(parts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aB9 é-\n日\x00Z", max_size=30)), max_size=6), st.integers(1, 4))
def test_buckets_of_any_text(texts, ngram):
    found, doc = bucketed(pa.array(texts, pa.string()), ngram, 101)
    for i, text in enumerate(texts):
        assert sorted(found[doc == i].tolist()) == sorted(bucket(f, 101) for f in features(text, ngram)[0])


def test_gains():
    corpus, target = np.array([0, 5, 100, 7]), np.array([3, 0, 1, 0])
    for g, s, t in zip(gains(corpus, target).tolist(), corpus.tolist(), target.tolist(), strict=True):
        assert g == math.floor(1000 * math.log((t + 1) * (112 + 4) / ((s + 1) * (4 + 4))))
    assert resampling.gains(np.zeros(3, int), np.zeros(3, int)).tolist() == [0, 0, 0]
