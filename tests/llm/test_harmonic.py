import random
from array import array
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basket.llm import harmonic
from basket.llm.harmonic import Harmonic, class_of, lengths_of, pack, powers_of, report

WORDS = public_tokenizers.path("word_bpe_49k.json")


def check(rows, docs, capacity=2048, end_id=1):
    """Every id in exactly one piece, pieces gapless in their sequences; returns the sequences' sizes."""
    tok = Tokenizer.from_file(WORDS)
    places, have = defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length
        places[r.sequence_id].append((r.offset, r.length))
        have[r.doc_id].append((r.start, r.doc_tokens, array("I", bytes(r.ids)).tolist()))
    sizes = {}
    for q, own in places.items():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
        sizes[q] = at
    want = defaultdict(list)
    for doc_id, text in docs:
        want[doc_id].append(tok.encode(text or "", add_special_tokens=False).ids + [end_id])
    assert set(have) == set(want)
    for doc_id, texts in want.items():
        # Rows that share an id: every (text, place) in as many pieces as there are such rows.
        wanted = Counter((len(t), at, i) for t in texts for at, i in enumerate(t))
        found = Counter((n, start + k, i) for start, n, ids in have[doc_id] for k, i in enumerate(ids))
        assert found == wanted
    return sizes


def padding(sizes, capacity=2048):
    return sum(capacity - n for n in sizes.values() if n & (n - 1))


def test_contract(spark, documents):
    packed = pack(documents, WORDS)
    sizes = check(packed.collect(), [(r.doc_id, r.text) for r in documents.collect()])
    total = sum(sizes.values())
    assert padding(sizes) <= 0.005 * total
    assert len(sizes) <= total / 2048 * 1.01 + 12 * documents.rdd.getNumPartitions()
    r = report(packed).head()
    assert (r.sequences, r.tokens, r.padding) == (len(sizes), total, padding(sizes))


def test_full_sequences_hold_their_class_s_count(spark, documents):
    """A padded sequence is one of the classes': j pieces of class j."""
    for r in pack(documents, WORDS).groupBy("sequence_id").agg(F.collect_list("length").alias("l")).collect():
        if sum(r.l) & (sum(r.l) - 1):
            assert {class_of(n, 2048) for n in r.l} == {len(r.l)}


def test_odd_and_empty(spark, odd, none):
    check(pack(odd, WORDS).collect(), [(r.doc_id, r.text) for r in odd.collect()])
    assert pack(none, WORDS).collect() == []
    assert tuple(report(pack(none, WORDS)).head()) == (0, 0, 0, 0, None)


def test_hot_groups_and_any_layout(spark):
    """A third of all rows under one id and a third without one, dealt to several workers."""
    rows = [(7, f"word {i} " * (i % 90)) for i in range(200)] + [(None, "the same text")] * 200 + [(i, "x" * i) for i in range(200)]
    for parts in (1, 7):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        sizes = check(pack(docs, WORDS).collect(), rows)
        assert padding(sizes) <= 0.02 * sum(sizes.values())


@pytest.mark.parametrize("capacity", [1, 2, 7, 64, 2048])
def test_lengths(capacity):
    for n in range(1, 3 * capacity + 50):
        own = lengths_of(n, capacity, shortest=4)
        assert sum(own) == n and all(0 < x <= capacity for x in own)
        assert min(own) >= 4 or n % capacity < 8
        assert own[: n // capacity] == [capacity] * (n // capacity)


def test_powers():
    for n in range(300):
        assert sum(powers_of(n)) == n and len(set(powers_of(n))) == n.bit_count()


@pytest.mark.parametrize("capacity", [5, 64, 100])
def test_classes_against_a_plain_fill(capacity):
    rnd, bins, plain, out = random.Random(capacity), Harmonic(capacity, width=1), defaultdict(list), []
    for i in range(3000):
        n = rnd.randint(1, capacity)
        j = max(k for k in range(1, capacity + 1) if k * n <= capacity)
        plain[j].append(i)
        done = bins.place(i, 0, bytes(n))
        assert [d for d, *_ in done] == (plain.pop(j) if len(plain[j]) == j else [])
        out += done
    rest = bins.finish()
    assert sorted({d for d, *_ in rest}) == sorted(i for own in plain.values() for i in own)
    sizes = Counter()
    for _, _, ids, q, _ in rest:
        sizes[q] += len(ids)
    full, tail = [n for n in sizes.values() if n == capacity], [n for n in sizes.values() if n < capacity]
    assert tail == powers_of(sum(sizes.values()) % capacity) and len(full) + len(tail) == len(sizes)
    assert not {q for *_, q, _ in out} & set(sizes) and bins.finish() == []


def test_impossible_piece():
    for n in (0, 11):
        with pytest.raises(ValueError):
            Harmonic(10, width=1).place("d", 0, bytes(n))
    assert harmonic.class_of(1025, 2048) == 1
