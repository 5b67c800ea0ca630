"""Benchmark decontamination with a broadcast set of normalised test n-grams.

Method: benchmark texts are lower-cased (A-Z) and cut into words; every window of 13
consecutive words, or a shorter item whole, goes into a hash set that is broadcast.  Each task
scans every window of its documents with a rolling 64-bit hash, verifies each hash hit
word by word, and marks the words inside verified occurrences.  Documents whose marked
share reaches a threshold are removed, and the marked spans of the others cut out.

The broadcast is bounded: about ``max_bytes`` and ``max_windows`` windows at a time, held as a few flat
arrays (the text of a window, once, and some 30 bytes more).  A larger benchmark is dealt into parts by
hash and the documents are scanned once for each part, the marks carried along, so the result is the same at any size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basket.llm.common import arrow_map, constants, cut, extend, filtered, slices, span_hashes, utf8, word_spans

NGRAM = 13
#: Word bytes after lower-casing: digits, a-z and everything from 0x80 on.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[0x30:0x3A] = WORD_BYTES[0x61:0x7B] = WORD_BYTES[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
HITS = "n_words long, spans array<struct<first:int,last:int>>, items array<string>"
CLEAN = ", clean_text string"


def _words(column: pa.Array):
    raw, offsets = utf8(column)
    data = _LOWER[raw]
    start, end, doc = word_spans(data, offsets, WORD_BYTES)
    return raw, data, offsets, start, end, doc


def _window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive words (runs across documents included)."""
    out = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for j, c in enumerate(constants(n, seed=n)):
        out += hashes[j : j + len(out)] * c
    return out


def _text(data: np.ndarray, start: np.ndarray, end: np.ndarray, first: int, n: int) -> bytes:
    return b" ".join(data[start[i] : end[i]].tobytes() for i in range(first, first + n))


def _cut_windows(ngram):
    def run(batches):
        for batch in slices(batches, "text"):
            _, data, offsets, start, end, doc = _words(batch.column("text"))
            first = np.searchsorted(doc, np.arange(len(offsets)))
            items, sizes, texts = [], [], []
            for i, item in enumerate(batch.column("item").to_pylist()):
                lo, hi = int(first[i]), int(first[i + 1])
                n = min(ngram, hi - lo)
                for at in range(lo, hi - n + 1) if n else ():
                    items.append(item)
                    sizes.append(n)
                    texts.append(_text(data, start, end, at, n).decode("utf-8", "surrogateescape"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(sizes, pa.int32()), pa.array(texts, pa.string())],
                ["item", "n", "window"],
            )

    return run


def benchmark_windows(benchmark: DataFrame, ngram: int = NGRAM) -> DataFrame:
    """Distinct (item, n, window) rows; an item of fewer words is one window, one of none has no row."""
    narrow = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text"))
    return arrow_map(narrow, _cut_windows(ngram), "item string, n int, window string").distinct()


#: Bytes of a window in a ``WindowSet`` beside its text and its items' names: hash, number, two offsets, item.
WINDOW_BYTES = 8 + 4 + 8 + 8 + 4


class _Length:
    """The distinct windows of n words: sorted hashes, the window of each, and by window its text and its items."""

    def __init__(self, n: int, windows: pa.Array, owners: np.ndarray):
        coded = windows.dictionary_encode()
        self.data, self.offsets = (x.copy() for x in utf8(coded.dictionary))
        # Each window has n words, so the first word of a window is n times its number.
        start, end, _ = word_spans(self.data, self.offsets, WORD_BYTES)
        hashes = _window_hashes(span_hashes(self.data, start, end), n)[::n]
        self.number = np.argsort(hashes, kind="stable").astype(np.int32)
        self.hashes = hashes[self.number]
        codes = coded.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        self.owners = owners[order]
        self.first = np.searchsorted(codes[order], np.arange(len(self.offsets)))

    def owners_of(self, at: int, text: bytes) -> np.ndarray | None:
        """Items of the window ``text``, whose hash stands at ``at`` first; None if it is another of that hash."""
        known = self.hashes[at]
        while at < len(self.hashes) and self.hashes[at] == known:
            i = self.number[at]
            if self.data[self.offsets[i] : self.offsets[i + 1]].tobytes() == text:
                return self.owners[self.first[i] : self.first[i + 1]]
            at += 1
        return None


class WindowSet:
    """The windows of (item, n, window) rows by length, in flat arrays; ``items`` are the names."""

    def __init__(self, rows: pa.Table):
        rows = rows.combine_chunks()
        named = pa.concat_arrays(rows.column("item").chunks or [pa.array([], pa.string())]).dictionary_encode()
        self.items, owners = named.dictionary, named.indices.to_numpy().astype(np.int32)
        sizes = rows.column("n").to_numpy()
        self.by_length = {}
        for n in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == n)
            windows = pa.concat_arrays(rows.column("window").take(pa.array(at)).chunks)
            self.by_length[n] = _Length(n, windows, owners[at])


def _scan(windows, clean: bool):
    def function(batch: pa.RecordBatch) -> list[pa.Array]:
        raw, data, offsets, start, end, doc = _words(batch.column("text"))
        docs = len(offsets) - 1
        marks = np.zeros(len(start) + 1, np.int32)
        items: dict[int, set[str]] = {}
        first = np.searchsorted(doc, np.arange(docs + 1))
        if "spans" in batch.schema.names:  # marks of the parts scanned before
            for i, (spans, known) in enumerate(
                zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True)
            ):
                for s in spans or ():
                    marks[first[i] + s["first"]] += 1
                    marks[first[i] + s["last"] + 1] -= 1
                if known:
                    items[i] = set(known)
        hashes = span_hashes(data, start, end)
        owners: dict[int, set[int]] = {}
        for n, known in windows.value.by_length.items():
            h = _window_hashes(hashes, n)
            if not len(h):
                continue
            at = np.minimum(np.searchsorted(known.hashes, h), len(known.hashes) - 1)
            for w in np.flatnonzero((known.hashes[at] == h) & (doc[: len(h)] == doc[n - 1 :])).tolist():
                found = known.owners_of(int(at[w]), _text(data, start, end, w, n))
                if found is not None:
                    marks[w] += 1
                    marks[w + n] -= 1
                    owners.setdefault(int(doc[w]), set()).update(found.tolist())
        for i, codes in owners.items():
            items.setdefault(i, set()).update(windows.value.items.take(pa.array(sorted(codes))).to_pylist())
        hit = np.cumsum(marks[:-1]) > 0
        edge = np.ones(len(hit) + 1, bool)
        edge[1:-1] = (hit[1:] != hit[:-1]) | (doc[1:] != doc[:-1])
        runs = np.flatnonzero(edge)
        spans: list[list[dict]] = [[] for _ in range(docs)]
        for lo, hi in zip(runs[:-1].tolist(), runs[1:].tolist(), strict=True):
            if hit[lo]:
                i = int(doc[lo])
                spans[i].append({"first": lo - int(first[i]), "last": hi - 1 - int(first[i])})
        out = [
            pa.array(np.diff(first).astype(np.int64)),
            pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
            pa.array([sorted(items.get(i, ())) for i in range(docs)], pa.list_(pa.string())),
        ]
        if clean:
            texts = batch.column("text").to_pylist()
            for i in range(docs):
                if spans[i]:
                    keep, at = [], int(offsets[i])
                    for s in spans[i]:
                        keep.append(raw[at : start[first[i] + s["first"]]].tobytes())
                        at = int(end[first[i] + s["last"]])
                    texts[i] = b"".join([*keep, raw[at : offsets[i + 1]].tobytes()]).decode()
            out.append(pa.array(texts, pa.string()))
        return out

    return function


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    ngram: int = NGRAM,
    max_windows: int = 2_000_000,
    clean: bool = False,
    max_bytes: int = 64 << 20,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``spans`` (first and last word of each marked run) and ``items``.

    With ``clean`` also ``clean_text``, the text without the marked runs.

    Null and empty texts have no words and no hits; an empty benchmark marks nothing;
    repeated rows are scanned once each.  Very long texts are scanned whole, one a slice.  Benchmark items without
    an id share the empty name.  Columns of ``docs`` of those names are replaced.

    Workers hold the windows of one part: at most about ``max_bytes`` and ``max_windows``.
    """
    spark = docs.sparkSession
    windows = cut(benchmark_windows(benchmark, ngram))
    held = F.octet_length("window") + F.octet_length("item") + WINDOW_BYTES
    count, size = windows.agg(F.count("*"), F.coalesce(F.sum(held), F.lit(0))).head()
    parts = max(1, math.ceil(count / max_windows), math.ceil(size / max_bytes))
    dealt = windows.withColumn("part", F.pmod(F.xxhash64("item", "n", "window"), F.lit(parts)))
    out = docs.drop("n_words", "n_hit", "spans", "items", "clean_text")
    for part in range(parts):
        rows = dealt.filter(F.col("part") == part).select("item", "n", "window").toArrow()
        shared = spark.sparkContext.broadcast(WindowSet(rows))
        last = clean and part == parts - 1
        out = extend(out if part == 0 else cut(out), _scan(shared, last), HITS + CLEAN * last, limit=1 << 20)
    n_hit = F.expr("aggregate(spans, 0L, (a, s) -> a + s.last - s.first + 1)")
    return out.withColumn("n_hit", n_hit)


def is_contaminated(n_hit="n_hit", n_words="n_words", share: int = 20):
    """Some word is hit, and at least one in ``share`` words."""
    return (F.col(n_hit) > 0) & (F.col(n_hit) * share >= F.col(n_words))


def decontaminate(docs: DataFrame, benchmark: DataFrame, ngram: int = NGRAM, share: int = 20) -> DataFrame:
    """Documents that are not contaminated, with any marked spans cut out of ``text``; columns as in ``docs``.

    A text without marks is returned as it is.  Null texts stay null.
    """

    def keep(d: DataFrame) -> DataFrame:
        hits = find_hits(d, benchmark, ngram, clean=True).filter(~is_contaminated(share=share))
        return hits.withColumn("text", F.col("clean_text"))

    return filtered(docs, {"n_words", "n_hit", "spans", "items", "clean_text"}, keep)
