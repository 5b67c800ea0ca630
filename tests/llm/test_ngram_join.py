import random
import re
from collections import Counter, defaultdict

import pytest

from basket.llm import ngram_join


def brute(rows, n=5, threshold=0.8):
    """(class, copy, copies, links) by row key, from all pairs of distinct word sequences."""
    members = defaultdict(list)
    for doc_id, text in rows:
        members[tuple(w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w)].append(doc_id)
    members.pop((), None)
    words = list(members)
    sets = [{w[i : i + n] for i in range(len(w) - n + 1)} or {w} for w in words]
    least = [min((d for d in members[w] if d is not None), default=None) for w in words]
    root, links = list(range(len(words))), Counter()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(words)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common >= threshold * (len(sets[i]) + len(sets[j]) - common):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    classes = defaultdict(list)
    for i in range(len(words)):
        classes[find(i)].append(i)
    out = {}
    for own in classes.values():
        name = min((least[i] for i in own if least[i] is not None), default=None)
        for i in own:
            for d in members[words[i]]:
                out[d] = (name, least[i], len(members[words[i]]), links[i])
    return out


def run(df, **kw):
    return [(r.doc_id, (r.class_id, r.copy_id, r.n_copies, r.n_links)) for r in ngram_join.similar(df, **kw).collect()]


def planted(seed=1):
    """Groups of copies and near copies of several degrees, and unrelated texts."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for length, copies, edits in ((120, 40, 1), (60, 12, 1), (40, 8, 2), (200, 30, 3), (8, 5, 1), (3, 4, 1)):
        base = [rnd.choice(words) for _ in range(length)]
        rows += [" ".join(base)] * 3
        for _ in range(copies):
            own = base[:]
            for _ in range(rnd.randint(0, edits)):
                own[rnd.randrange(length)] = rnd.choice(words)
            rows.append("  ".join(own).upper() if rnd.random() < 0.2 else " ".join(own))
    rows += [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 80))) for _ in range(60)]
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("block", [512, 7])
def test_planted_groups(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)  # small blocks: components span many tasks
    rows = planted()
    assert dict(run(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))) == brute(rows)


def test_documents(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert dict(run(documents)) == brute(rows)


def test_by_shuffle_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 0)
    rows = planted(2)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert dict(run(df)) == want
    assert {r.doc_id for r in ngram_join.deduplicate(df).collect()} == {d for d, v in want.items() if d == v[0]}


def test_odd_rows(spark, odd, none):
    got = run(odd)
    assert len(got) == odd.count()
    by = dict(got)
    for i in (1, 2, 3):
        assert by[i] == (i, i, 1, 0)
    assert by[5] == by[6] == (5, 5, 3, 0) and by[None] == (None, None, 1, 0)
    assert run(none) == [] and run(odd.filter("doc_id < 4")) == [(i, (i, i, 1, 0)) for i in (1, 2, 3)]
    kept = ngram_join.deduplicate(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7, 8]


@pytest.mark.parametrize("bound", [ngram_join.BROADCAST_ROWS, 0])
def test_rows_with_null_or_clashing_ids(spark, monkeypatch, bound):
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", bound)
    near = " ".join(f"w{i}" for i in range(80))
    rows = [
        (None, "a text without an id that stands here twice"),
        (None, "a text without an id that stands here twice"),
        (None, near),  # goes: near copy of 1
        (None, "a copy of a row that has an id"),  # goes: 2 has it
        (None, "a text of its own without any id"),
        (None, ""),
        (None, ""),
        (1, near + " more"),
        (2, "a copy of a row that has an id"),
        (2, "another text under the same id"),
        (2, "another  text under the same id"),  # a repeat in words
        (2, ""),
        (2, ""),
        (2, None),
        (3, "another text under the same id"),  # goes: 2 has it
        (3, "the third text"),
        (4, near),  # goes: near copy of 1
        (5, "alone"),
        (5, "alone"),
    ]
    gone = {2, 3, 14, 16}
    # min over equal ids and words; rows without an id and words all stay
    want = [r for i, r in enumerate(rows) if i not in gone | {1, 9, 12, 18}]
    df = spark.createDataFrame([(*r, "mine") for r in rows], "doc_id long, text string, _k1 string")
    for parts in (1, 5):
        got = ngram_join.deduplicate(df.repartition(parts))
        assert got.columns == df.columns
        assert sorted(map(repr, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(repr, want))


def counts(df):
    """(copies, links) of all rows, in order."""
    return sorted((r.n_copies, r.n_links) for r in ngram_join.similar(df).collect())


@pytest.mark.parametrize("bound", [ngram_join.BROADCAST_ROWS, 0])
def test_links_do_not_depend_on_the_ids(spark, monkeypatch, bound):
    """All rows under one id or under none have the links that they have under ids of their own."""
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", bound)
    rows = planted(3)
    want = sorted(v[2:] for v in brute(rows).values())
    for own in (lambda i: None, lambda i: 7, lambda i: None if i % 3 == 0 else i // 2):
        df = spark.createDataFrame([(own(i), t) for i, t in rows], "doc_id long, text string").repartition(4)
        assert counts(df) == want


@pytest.mark.parametrize("own", [None, 5])
def test_one_text_for_each_candidate(spark, monkeypatch, own):
    """10,000 rows under one id (or none), a third of them repeats of one row: a candidate reads one text."""
    read = []
    plain = ngram_join._texts_of

    def counted(docs, signed_docs, wanted):
        found = plain(docs, signed_docs, wanted)
        read.append((found.count(), wanted.count()))
        return found

    monkeypatch.setattr(ngram_join, "_texts_of", counted)
    base = [f"w{i}" for i in range(40)]
    rows = [" ".join(base)] * 3334 + [" ".join([*base, f"end{i}"]) for i in range(600)]
    rows += [f"text {i} of its own and like no other {i} one" for i in range(6066)]
    df = spark.createDataFrame([(own, t) for t in rows], "doc_id long, text string").repartition(4)
    got = counts(df)
    assert len(got) == 10_000 and got[-1] == (3334, 600)
    assert got.count((1, 600)) == 600
    ((texts, wanted),) = read
    assert texts == wanted and 601 <= wanted <= 6667


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.999), (0.8, 0.9), (0.5, 0.99), (0.95, 0.999)):
        bands, rows = ngram_join.choose_bands(threshold, recall)
        assert 1 - (1 - threshold**rows) ** bands >= recall and bands * rows <= 256


def test_components_against_union_find(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert ngram_join.components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("bound", [ngram_join.BROADCAST_ROWS, 0])
def test_components_of_paths_and_stars(spark, monkeypatch, bound):
    """Long paths (numbered in order and at random), a node with many neighbours, and repeated edges; whatever the bound."""
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", bound)
    rnd = random.Random(5)
    mixed = rnd.sample(range(1000, 1200), 200)
    edges = [(i, i + 1) for i in range(100)] + list(zip(mixed, mixed[1:])) + [(5000, i) for i in range(4000, 4300)] * 2 + [(7, 7)]
    got = {r.node: r.root for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(101)} | {i: 1000 for i in range(1000, 1200)} | {i: 4000 for i in [*range(4000, 4300), 5000]}
    assert got == want


def test_components_stop_when_settled(spark, monkeypatch):
    """A star takes one round, with one checkpoint beside that of its edges; a path of 200 nodes a few."""
    cuts = []
    plain = ngram_join.cut
    monkeypatch.setattr(ngram_join, "cut", lambda df: cuts.append(1) or plain(df))
    for edges, most in (([(0, i) for i in range(1, 50)], 2), ([(i, i + 1) for i in range(200)], 5)):
        cuts.clear()
        got = ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()
        assert {r.root for r in got} == {0} and len(got) == len(edges) + 1
        assert len(cuts) <= most
