import pickle
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from basket.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items):
    windows = []
    for item, text in items:
        w = WORD.findall(lower(text))
        n = min(13, len(w))
        windows += [(str(item), tuple(w[i : i + n])) for i in range(len(w) - n + 1) if n]
    out = []
    for doc_id, text in docs:
        w = WORD.findall(lower(text))
        hit, found = set(), set()
        for item, win in windows:
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    found.add(item)
        out.append((doc_id, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def made(seed=1):
    rnd = random.Random(seed)
    words = [f"w{i}é" for i in range(60)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(n))) for i, n in enumerate((5, 13, 14, 30, 1, 0, 13, 20))]
    items[4] = (4, "Unique")
    items += [(8, items[3][1]), (9, None), (10, items[2][1].upper() + "!")]
    docs = []
    for d in range(40):
        text = [rnd.choice(words) for _ in range(rnd.randrange(120))]
        for _ in range(rnd.randrange(3)):
            own = (rnd.choice(items)[1] or "").split()
            cut = rnd.randrange(max(1, len(own)))
            at = rnd.randrange(len(text) + 1)
            text[at:at] = own if rnd.random() < 0.6 else own[cut:]
        docs.append((d, rnd.choice([" ", ", ", "\n-- "]).join(text)))
    return docs, items


def run(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = decontam.find_hits(d, b, **kw).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(sorted(r["items"]))) for r in rows), key=str)


@pytest.mark.parametrize("max_windows", [2_000_000, 20])
def test_against_all_windows(spark, max_windows):
    docs, items = made()
    assert run(spark, docs, items, max_windows=max_windows) == brute(docs, items)


def test_parts_by_bytes(spark):
    docs, items = made(2)
    assert run(spark, docs, items, max_bytes=3000) == brute(docs, items)


def test_bytes_a_window():
    """What workers hold is some 30 bytes and the text a window, whatever number of items share it."""
    words = [f"word{i}" for i in range(30_012)]
    windows = [" ".join(words[i : i + 13]) for i in range(30_000)]
    rows = pa.table({"item": ["a"] * 30_000 + ["b"] * 30_000, "n": pa.array([13] * 60_000, pa.int32()), "window": windows + windows})
    held = decontam.WindowSet(rows)
    size = len(pickle.dumps(held))
    text = sum(map(len, windows))
    assert text < size <= text + 60_000 * decontam.WINDOW_BYTES + 10_000
    own = held.by_length[13]
    at = int(own.number.tolist().index(77))
    assert sorted(held.items.take(pa.array(own.owners_of(at, windows[77].encode()))).to_pylist()) == ["a", "b"]
    assert own.owners_of(at, b"another text") is None


def test_equal_hashes_are_told_apart(spark, monkeypatch):
    """Windows of one hash: each hit is settled by its words."""
    rows = pa.table({"item": ["a", "b"], "n": pa.array([2, 2], pa.int32()), "window": ["x y", "p q"]})
    monkeypatch.setattr(decontam, "_window_hashes", lambda hashes, n: np.zeros(max(0, len(hashes) - n + 1), np.uint64))
    held = decontam.WindowSet(rows)
    found = [held.items[int(held.by_length[2].owners_of(0, t)[0])].as_py() for t in (b"x y", b"p q")]
    assert found == ["a", "b"] and held.by_length[2].owners_of(0, b"x q") is None


def test_items_without_an_id(spark):
    docs = [(1, "one two three"), (2, "four")]
    items = [(None, "two three"), (None, "four"), (3, "four")]
    assert run(spark, docs, items) == [(1, 3, 2, ("",)), (2, 1, 1, ("", "3"))]


def test_odd_rows(spark, odd, none):
    bench = spark.createDataFrame([(1, "text of several WORDS"), (2, "テスト"), (2, "テスト")], "item_id long, text string")
    rows = decontam.find_hits(odd, bench).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, tuple(sorted(r["items"]))) for r in rows), key=str) == brute(
        [(r.doc_id, r.text) for r in odd.collect()], [(1, "text of several WORDS"), (2, "テスト")]
    )
    assert decontam.find_hits(none, bench).collect() == []
    assert {r.n_hit for r in decontam.find_hits(odd, bench.limit(0)).collect()} == {0}
    clean = decontam.decontaminate(odd, bench)
    assert clean.columns == odd.columns
    left = {r.doc_id: r for r in clean.collect()}
    assert 5 not in left and 8 not in left and left[1].text is None and left[7]["items"] == "mine"


def test_spans_are_cut_and_nothing_else(spark):
    passage = " ".join(f"p{i}" for i in range(13))
    rest = " ".join(f"r{i}" for i in range(400))
    docs = [(1, f"Start, {passage.upper()}! {rest}"), (2, rest), (3, passage), (4, f"{rest} {passage}")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, passage)], "item_id long, text string")
    got = {r.doc_id: r.text for r in decontam.decontaminate(d, b).collect()}
    assert got == {1: f"Start, ! {rest}", 2: rest, 4: f"{rest} "}
