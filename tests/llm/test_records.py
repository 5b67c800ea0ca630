import io
import zlib
from array import array

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from basket.llm import records
from basket.llm.tokenize import Encoder

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


TOKENIZERS = {p: Tokenizer.from_file(p) for p in (WORDS, BYTES)}


def ids(path, text):
    return TOKENIZERS[path].encode(text or "", add_special_tokens=False).ids


TEXTS = [
    "", " ", "\n", "it's you're, I'LL don't.", "  lead  two\n\nthree \t x", "<|endoftext|> a<|endoftext|>b. <|startoftext|>,",
    "ÀÉ×÷ß İstanbul. İ. İ, ǅ ŉ.", "é café, ö.", "日本語 テスト。 12½ ３", "x y z. a\x1cb c.", "'s 's' ''s a's.b, ...", "Σας ΣΑΣ.",
]


@pytest.mark.parametrize("path, pieces", [(WORDS, "dropped"), (BYTES, "leading"), (BYTES, "whole")])
@pytest.mark.parametrize("limit", [0, 5, 10_000])
def test_pieces_give_the_library_s_ids(path, pieces, limit):
    enc = Encoder(path, pieces, limit=limit)
    for _ in range(2):
        found, ends = enc.encode(pa.array(TEXTS))
        assert [found[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == [ids(path, t) for t in TEXTS]


ENCODERS = {WORDS: Encoder(WORDS, "dropped", limit=300), BYTES: Encoder(BYTES, "leading", limit=300)}
#: Letters, signs, all kinds of white space, contractions, special tokens, combining marks, digits.
ALPHABET = st.sampled_from(
    ["a", "B", "é", "É", "ß", "×", "÷", "İ", "Σ", "ς", "'", "'s", "’", ".", ",", "-", "—", "<|endoftext|>", "<", "|", "1", "½", "\u0301", "\u0338",
     " ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", "\u2003", "\u2028", "\u200b", "\x00", "日", "😀"]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=14).map("".join), min_size=1, max_size=4), st.sampled_from([WORDS, BYTES]))
def test_any_text_has_the_library_s_ids(texts, path):
    found, ends = ENCODERS[path].encode(pa.array(texts))
    assert [found[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == [ids(path, t) for t in texts]


def expected(rows):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        own = array("I", ids(WORDS, text) + [2])
        out.append((doc_id, start, len(own), zlib.crc32(own.tobytes())))
        start += len(own)
    return out


def got(spark, out):
    rows = records.read_records(spark, out).collect()
    return sorted(((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in rows), key=lambda r: r[1])


def test_round_trip(spark, documents, path):
    records.write_records(documents, path, WORDS, vocabulary=49_408)
    assert got(spark, path) == expected([(r.doc_id, r.text) for r in documents.collect()])


def test_odd_rows(spark, odd, path):
    records.write_records(odd, path, WORDS, vocabulary=1 << 20)  # four bytes an id
    assert got(spark, path) == expected([(r.doc_id, r.text) for r in odd.collect()])


def test_empty(spark, none, path):
    records.write_records(none, path, WORDS)
    assert got(spark, path) == []
    assert records.read_shuffled(spark, path, 1).collect() == []


def test_shuffled_reads(spark, documents, path):
    records.write_records(documents, path, WORDS)
    first, second = (records.read_shuffled(spark, path, s).collect() for s in (1, 2))
    whole = {r.doc_id: bytes(r.ids) for r in records.read_records(spark, path).collect()}
    assert {r.doc_id: bytes(r.ids) for r in first} == whole
    assert [r.doc_id for r in first] != [r.doc_id for r in second]
    assert [r.doc_id for r in first] == [r.doc_id for r in records.read_shuffled(spark, path, 1).collect()]


def test_broken_frames_are_found():
    whole = records.frame(b"payload of a record")
    assert records.read_frame(io.BytesIO(whole)) == b"payload of a record"
    assert records.read_frame(io.BytesIO(b"")) is None
    for at in range(len(whole)):
        broken = whole[:at] + bytes([whole[at] ^ 1]) + whole[at + 1 :]
        with pytest.raises(ValueError):
            records.read_frame(io.BytesIO(broken))


def test_one_id_on_many_rows(spark, path):
    """A third of all rows without an id: several shards hold them, in the order of their texts."""
    rows = [(None, f"text {i:05d} of nobody") for i in range(1500)] + [(i, f"text {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        records.write_records(docs, path, WORDS, vocabulary=49_408)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    index = records.read_index(spark, path)
    assert index.filter("doc_id IS NULL").select("shard").distinct().count() > 1
    assert got(spark, path) == expected(rows)
