"""The pipeline against a plain Python version of its stages, and the registered SQL twins."""

import public_tokenizers
import pytest

import corpus_pipeline
from basket.llm import langid, registry
from tests.llm.test_decontam import WORD, lower
from tests.llm.test_decontam import brute as plain_hits
from tests.llm.test_ngram_join import brute as plain_similar
from tests.llm.test_packing import check as check_packing
from tests.llm.test_rules import failures
from tests.oracle import compare, duck

SMALL = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    outs = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        outs.append((docs, spark.read.parquet(str(tmp_path / name))))
        docs = outs[-1][1]
    rows = [[{r.doc_id: r for r in side.collect()} for side in pair] for pair in outs[:4]]
    assert all(a.columns == b.columns for a, b in outs[:4])

    before, after = rows[0]
    model = langid.train(outs[0][0])
    langs, scores = model.predict([r.text for r in before.values()])
    good = {d for d, lang, s in zip(before, langs, scores, strict=True) if lang != "und" and s >= 0.3}
    assert set(after) == good
    for (d, r), lang, s in zip(before.items(), langs, scores, strict=True):
        if d in good:
            assert after[d].lang == (lang if r.lang is None or s >= 0.9 else r.lang)

    before, after = rows[1]
    assert set(after) == {d for d, r in before.items() if failures(r.text) == 0}

    before, after = rows[2]
    classes = plain_similar([(d, r.text) for d, r in before.items()])
    assert set(after) == {d for d in before if classes.get(d, (d,))[0] == d}

    before, after = rows[3]
    hits = {d: (n, h) for d, n, h, _ in plain_hits([(d, r.text) for d, r in before.items()], bench)}
    assert set(after) == {d for d, (n, h) in hits.items() if not (h and 20 * h >= n)}
    for d, r in after.items():
        n, h = hits[d]
        assert r.text == before[d].text if not h else len(WORD.findall(lower(r.text))) >= n - h

    packed = corpus_pipeline.packing.pack(outs[4][0], public_tokenizers.path("byte_bpe_50k.json")).collect()
    check_packing(packed, [(d, r.text) for d, r in after.items()])
    last = outs[4][1].collect()
    assert {(r.doc_id, r.piece, r.length) for r in last} == {(r.doc_id, r.piece, r.length) for r in packed}


def test_stages_take_odd_and_empty_documents(spark, odd, none):
    wanted = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (odd, none.select(*wanted)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            rows = out.collect()
            assert len(rows) <= max(docs.count() * 40, 0)
            if name != "pack":
                assert out.columns == docs.columns


def test_run_returns_the_last_stage(spark):
    assert "sequence_id" in corpus_pipeline.run(spark, SMALL).columns


@pytest.mark.parametrize("key", sorted(registry.oracle_sql()))
def test_sql_twin(spark, key):
    assert compare(registry.queries()[key](spark, SMALL), duck(SMALL), registry.oracle_sql()[key]) is None


def test_one_query_for_each_operator():
    names = sorted(registry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))  # the operators dealt so far
