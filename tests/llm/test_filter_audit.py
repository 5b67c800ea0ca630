import re
from collections import defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from basket.llm import filter_audit
from basket.llm.filter_audit import FILTERS, audit, contract, failures, selectors, steps
from tests.oracle import compare, duck

SMALL = "/root/testdata/sf0.001"


def fails(text):
    """The names of the first four filters that a text fails."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = (
        len(words) < 50,
        100 * len(set(words)) < 65 * len(words),
        100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
        any(c in "#$%&*|" for c in text),
    )
    return {f for f, x in zip(FILTERS, found, strict=False) if x}


def plain(docs, labels):
    """Every order applied to the documents one after the other."""
    smallest = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            smallest[text or ""] = min(smallest.get(text or "", doc_id), doc_id)
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    rows = defaultdict(list)
    for doc_id, text, source in docs:
        own = fails(text) | ({"E"} if doc_id is not None and doc_id > smallest[text or ""] else set())
        rows[source or ""].append((doc_id, own))
    out = {}
    for part, own in rows.items():
        shapley = defaultdict(int)
        for order in map("".join, permutations(FILTERS)):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                failing = [r for r in own if f in r[1]]
                kept = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                out[part, order, step] = [
                    len(kept), len(gone), len(failing) - len(gone), sum(r[1] == {f} for r in own),
                    sum(r[0] in good for r in gone if r[0] is not None), sum(r[0] in toxic for r in gone if r[0] is not None),
                ]
                left = kept
        for order in map("".join, permutations(FILTERS)):
            for step, f in enumerate(order, 1):
                out[part, order, step].append(shapley[f])
    return out


def got(df):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in df.collect()}


def test_documents(spark, documents):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    want = plain([(r.doc_id, r.text, r.source) for r in documents.collect()], [tuple(r) for r in labels.collect()])
    out = audit(documents, labels)
    found = got(out)
    assert found == want and out.count() == len(want)
    assert any(v[2] for v in want.values()) and any(v[4] for v in want.values()) and any(v[5] for v in want.values())


def test_odd_rows(spark, odd, none):
    """Null ids, texts and sources, repeated rows, labels that repeat an id or have nulls, extra columns."""
    labels = [(5, 1, None), (5, 0, 1), (7, None, 1), (None, 1, 1), (99, 1, 1), (4, 0, 0), (4, 1, 0)]
    table = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, bits string")
    more = odd.unionByName(odd.filter("doc_id IS NULL")).unionByName(odd.filter("doc_id = 6").selectExpr("* EXCEPT (source)", "'' AS source"))
    rows = more.withColumnsRenamed({"items": "part", "score": "bits", "n_words": "n", "spans": "same"})
    assert got(audit(rows, table)) == plain([(r.doc_id, r.text, r.source) for r in rows.collect()], labels)
    assert audit(none, table).collect() == []
    assert got(audit(odd, table.limit(0))) == plain([(r.doc_id, r.text, r.source) for r in odd.collect()], [])


def test_hot_copies(spark):
    """A third of all rows are copies of a text, a third repeat one row."""
    rows = [(i, "copied text", "a") for i in range(300)] + [(1000, "copied text", "b")] * 300 + [(i, f"own {i}", "c") for i in range(2000, 2300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    labels = [(0, 1, 1), (1000, 1, 0)]
    assert got(audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))) == plain(rows, labels)


def test_matches_sql(spark):
    from basket.llm.registry import op13_filter_audit, oracle_sql

    assert compare(op13_filter_audit(spark, SMALL), duck(SMALL), oracle_sql()["op13_filter_audit"]) is None


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aB é#\n\x0b|日", max_size=200), st.text("ab ", min_size=120, max_size=300)), max_size=6))
def test_failures_of_any_text(texts):
    want = [sum(1 << FILTERS.index(f) for f in fails(t)) for t in texts]
    assert failures(pa.array(texts, pa.string())).tolist() == want


def test_contractions_against_sums_over_cells():
    rnd = np.random.default_rng(1)
    tensors = rnd.integers(0, 1 << 50, (3, 2, 2, 2, 2, 2))
    flat, chosen = tensors.reshape(3, 32), selectors()
    assert len(steps()) == 600 and steps() == sorted(steps())
    for s, (order, step) in enumerate(steps()):
        own, before = order[step - 1], set(order[: step - 1])
        for figure, keep in (
            ("removed", lambda bad: own in bad and not before & bad),
            ("kept", lambda bad: own not in bad and not before & bad),
            ("failing", lambda bad: own in bad),
            ("unique_fails", lambda bad: bad == {own}),
        ):
            picked = [c for c in range(32) if keep({f for i, f in enumerate(FILTERS) if c >> i & 1})]
            assert contract(tensors, chosen[figure][s : s + 1])[:, 0].tolist() == flat[:, picked].sum(axis=1).tolist()
    assert filter_audit.SCHEMA.startswith("part string")
