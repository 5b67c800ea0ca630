import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from basket.llm import rules


def measure(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(grams)
    covered = {k for i, g in enumerate(grams) if counts[g] > 1 for k in (i, i + 1, i + 2)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines), len(lines) - len(set(lines)), len(covered)


def failures(text):
    m = dict(zip(rules.MEASURES, measure(text), strict=True))
    return sum(bit for name, bit in rules.BITS.items() if eval(rules.RULES[name], {}, m))  # noqa: S307


def rows_of(df):
    return [(r.text, tuple(r[c] for c in rules.MEASURES), r.failures) for r in rules.ledger(df).collect()]


def test_documents(documents):
    for text, measured, failed in rows_of(documents):
        assert measured == measure(text) and failed == failures(text)


def test_odd_rows(odd, none):
    got = rows_of(odd)
    assert len(got) == odd.count()
    for text, measured, failed in got:
        assert measured == measure(text) and failed == failures(text)
    assert rows_of(none) == []
    kept = rules.apply_policy(odd, "base-1")
    assert kept.columns == odd.columns and kept.collect() == []


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("ab \n\t\x0b#é", max_size=60), min_size=20, max_size=20))
def test_any_text(spark, texts):
    for text, measured, failed in rows_of(spark.createDataFrame([(t,) for t in texts], "text string")):
        assert measured == measure(text) and failed == failures(text)


def test_windows_without_the_hash_step(spark, documents, monkeypatch):
    monkeypatch.setattr(rules, "_PLACE", 40)  # longer texts take the exact path
    for text, measured, _ in rows_of(documents):
        if len(measured) and measure(text)[0] > 40:
            assert measured == measure(text)


def test_policies_and_ablations(documents):
    found = rules.ledger(documents)
    bits = [r.failures for r in found.collect()]
    assert rules.apply_policy(documents, "full-1").count() == sum(b == 0 for b in bits)
    base = rules.mask("base-1")
    assert rules.apply_policy(documents, "base-1").count() == sum(b & base == 0 for b in bits)
    got = {r.rule: (r.n_failed, r.n_failed_alone, r.n_kept_without) for r in rules.ablations(found).collect()}
    assert got == {
        name: (sum(b & bit != 0 for b in bits), sum(b == bit for b in bits), sum(b & ~bit == 0 for b in bits))
        for name, bit in rules.BITS.items()
    }


def test_runs_no_python(documents):
    plan = rules.ledger(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
