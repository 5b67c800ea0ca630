import random
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from basket.llm.packing import BestFit, pack, pieces_of, sequences

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, docs, capacity=2048):
    tok = Tokenizer.from_file(BYTES)
    by_seq, seen = defaultdict(list), defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append((r.offset, r.length))
        seen[r.doc_id].append(r)
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    want = defaultdict(list)
    for doc_id, text in docs:
        own = tok.encode(text or "", add_special_tokens=False).ids + [0]
        want[doc_id] += [(p, s, own[s : s + n]) for p, (s, n) in enumerate(pieces_of(len(own), capacity))]
    from array import array

    have = {k: sorted((r.piece, r.start, array("I", bytes(r.ids)).tolist()) for r in v) for k, v in seen.items()}
    assert have == {k: sorted(v) for k, v in want.items()}
    return by_seq


def test_contract(spark, documents):
    rows = pack(documents, BYTES).collect()
    by_seq = check(rows, [(r.doc_id, r.text) for r in documents.collect()])
    total = sum(r.length for r in rows)
    assert len(by_seq) <= 1.02 * total / 2048 + documents.rdd.getNumPartitions()


def test_odd_and_empty(spark, odd, none):
    check(pack(odd, BYTES).collect(), [(r.doc_id, r.text) for r in odd.collect()])
    assert pack(none, BYTES).collect() == []


def test_sequences_hold_their_pieces(spark, documents):
    packed = pack(documents, BYTES)
    whole = {r.sequence_id: bytes(r.ids) for r in sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)


@pytest.mark.parametrize("total", [1, 2047, 2048, 2049, 4096, 5000])
def test_pieces(total):
    p = pieces_of(total, 2048)
    assert sum(n for _, n in p) == total and all(n == 2048 for _, n in p[1:])
    assert [s for s, _ in p] == [sum(n for _, n in p[:i]) for i in range(len(p))]
    assert len(p) == -(-total // 2048)


@pytest.mark.parametrize("max_open", [1, 3, 1000])
def test_best_fit_against_a_plain_search(max_open):
    rnd, bins, plain, closed = random.Random(max_open), BestFit(100, max_open), {}, 0
    for _ in range(2000):
        size = rnd.randint(1, 100)
        fits = [f for f in plain.values() if f >= size]
        seq, offset = bins.place(size)
        if fits:
            assert plain[seq] == min(fits) and offset == 100 - plain[seq]
        else:
            assert seq not in plain and offset == 0
            plain[seq] = 100
            if len(plain) > max_open and size < 100:
                fullest = min(f for s, f in plain.items() if s != seq)
                gone = next(s for s, f in plain.items() if s != seq and f == fullest and s not in sum(bins.by_free, []))
                del plain[gone]
                closed += 1
        plain[seq] -= size
        if not plain[seq]:
            del plain[seq]
        assert bins.open == len(plain) <= max_open
    assert closed or max_open == 1000


def test_impossible_piece():
    with pytest.raises(ValueError):
        BestFit(10, 2).place(11)
