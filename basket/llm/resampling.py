"""Importance resampling towards a target corpus: array-scored weights, top share by weighted median of medians.

Features are runs of ``1`` to ``ngram`` consecutive words, hashed into buckets.  One pass over the corpus and one
over the target count the buckets; their smoothed log ratio is an array of whole gains, one for each bucket.  A second pass
scores every document by looking its features up in that array, adds Gumbel noise from a seeded hash of the id, and
stores narrow rows.  Drawing the documents with the highest noisy scores is sampling without replacement
in proportion to the weights.

The cutoff among the drawable rows is found exactly and without sorting them.  Each round every block of rows
gives the median of its keys that are still in question, and their number.  The median of those medians, weighted by
the numbers, is the pivot: at least a quarter of the keys lies on either side of it (half the weight has a median beyond it, and half
of each such block lies beyond that).  One pass counts the keys above the pivot and takes the blocks' medians on both of its
sides for the next round, and the side without the cutoff is discarded.  Only (median, number) rows go to the driver, two
for each block of up to ``BLOCK`` rows.  In the end the winners alone are sorted, by a range sort, to be ranked.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basket.llm.common import arrow_map, shared_folder, slices, utf8, word_spans
from basket.operators.sequence import sequence_within

#: Word bytes after lower-casing A-Z: digits, a-z and everything from 0x80 on.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[0x30:0x3A] = WORD_BYTES[0x61:0x7B] = WORD_BYTES[0x80:] = True
#: Keys of one block; a task with more rows gives several.
BLOCK = 1 << 20


def _features(column: pa.Array, ngram: int) -> tuple[pa.Array, np.ndarray]:
    """The feature strings of all texts, and the number of the text of each."""
    raw, offsets = utf8(column)
    data = raw + 32 * (raw - np.uint8(65) < 26).astype(np.uint8)
    start, end, doc = word_spans(data, offsets, WORD_BYTES)
    cuts = np.concatenate(([0], np.cumsum(end - start))).astype(np.int64)
    letters = np.ascontiguousarray(data[WORD_BYTES[data]])
    words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(cuts), pa.py_buffer(letters))
    arrays, docs = [words], [doc]
    for n in range(2, ngram + 1):
        last = max(0, len(doc) - n + 1)
        runs = pc.binary_join_element_wise(*[words.slice(i, last) for i in range(n)], pa.scalar(" ", pa.large_string()))
        whole = doc[:last] == doc[n - 1 : n - 1 + last]
        arrays.append(runs.filter(pa.array(whole)))
        docs.append(doc[:last][whole])
    return pa.concat_arrays(arrays), np.concatenate(docs)


def bucketed(column: pa.Array, ngram: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each feature (crc32 of its UTF-8 bytes, modulo), and the number of its text."""
    features, doc = _features(column, ngram)
    if not len(doc):
        return np.empty(0, np.int64), doc
    numbered = features.dictionary_encode()
    crc = np.fromiter(map(zlib.crc32, numbered.dictionary.cast(pa.large_binary()).to_pylist()), np.int64)
    return (crc % buckets)[numbered.indices.to_numpy()], doc


def _count(ngram, buckets):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches, "text"):
            total += np.bincount(bucketed(batch.column("text"), ngram, buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, ngram: int = 1, buckets: int = 10_000) -> np.ndarray:
    """Features in each bucket over all rows; each task sends one row for each of its buckets at most."""
    narrow = texts.select(F.col("text").cast("string").alias("text"))
    counted = arrow_map(narrow, _count(ngram, buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in counted.collect():
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target against that in the corpus."""
    n, all_corpus, all_target = len(corpus), int(corpus.sum()), int(target.sum())
    ratios = [(float(t + 1) * (all_corpus + n)) / (float(s + 1) * (all_target + n)) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def _weigh(array, ngram, kept):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found, doc = bucketed(batch.column("text"), ngram, len(array.value))
            total = np.zeros(batch.num_rows, np.int64)
            np.add.at(total, doc, array.value[found])
            n = np.bincount(doc, minlength=batch.num_rows).astype(np.int64)
            own = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*own, pa.array(n), pa.array(total)], [*kept, "n_features", "weight"])

    return run


def noise(doc_id: Column, seed: int) -> Column:
    """floor(1000 times a Gumbel variate) from the first 32 bits of a hash of ``seed:doc_id``; a null id hashes as none."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(uniform))).cast("long")


def score(docs: DataFrame, target: DataFrame, ngram: int = 1, buckets: int = 10_000, seed: int = 2024) -> DataFrame:
    """``docs`` without its text, with ``n_features``, ``n_words``, ``weight`` and ``score``, all long.

    Columns of those names are replaced.
    """
    array = gains(bucket_counts(docs, ngram, buckets), bucket_counts(target, ngram, buckets))
    docs = docs.drop("n_features", "n_words", "weight", "score").withColumn("text", F.col("text").cast("string"))
    kept = [f for f in docs.schema if f.name.lower() != "text"]
    schema = T.StructType([*kept, T.StructField("n_features", T.LongType()), T.StructField("weight", T.LongType())])
    shared = docs.sparkSession.sparkContext.broadcast(array)
    weighed = arrow_map(docs, _weigh(shared, ngram, [f.name for f in kept]), schema)
    # A text of w words has w + (w - 1) + ... features, down to its runs of ``ngram`` words.
    words = F.col("n_features") if ngram == 1 else _words_of(F.col("n_features"), ngram)
    return weighed.withColumn("n_words", words).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def _words_of(features: Column, ngram: int) -> Column:
    """The number of words of a text with so many features."""
    short = ngram * (ngram + 1) // 2  # features of a text of ``ngram`` words
    small = F.lit(0)
    for w in range(1, ngram):
        small = F.when(features >= w * (w + 1) // 2, F.lit(w)).otherwise(small)
    return F.when(features >= short, F.floor((features - short) / ngram).cast("long") + ngram).otherwise(small).cast("long")


# A key is (score, -doc_id, -row) as three int64: larger is better, and all keys are different.
Key = tuple[int, int, int]
_KEYS = "side int, n long, k0 long, k1 long, k2 long"


def _medians(pivot: Key | None, lo: Key | None, hi: Key | None, block: int):
    def summary(side: int, keys: np.ndarray) -> tuple:
        order = np.lexsort((keys[2], keys[1], keys[0]))
        return (side, keys.shape[1], *keys[:, order[keys.shape[1] // 2]].tolist())

    def beyond(keys: np.ndarray, than: Key) -> np.ndarray:
        """1 where a key is above ``than``, 0 where it is the same, -1 below."""
        out = np.zeros(keys.shape[1], np.int8)
        for own, other in zip(reversed(keys), reversed(than), strict=True):
            out = np.where(own > other, 1, np.where(own < other, -1, out))
        return out

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        held, n = [], 0
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("k0", "k1", "k2")])
            if lo is not None:
                keys = keys[:, beyond(keys, lo) > 0]
            if hi is not None:
                keys = keys[:, beyond(keys, hi) < 0]
            held.append(keys)
            n += keys.shape[1]
            if n >= block:
                yield np.concatenate(held, axis=1)
                held, n = [], 0
        if n:
            yield np.concatenate(held, axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys in blocks(batches):
            side = beyond(keys, pivot) if pivot is not None else np.ones(keys.shape[1], np.int8)
            rows = [summary(s, keys[:, side == s]) for s in (1, 0, -1) if (side == s).any()]
            types = (pa.int32(), *[pa.int64()] * 4)
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["side", "n", "k0", "k1", "k2"])

    return run


def weighted_median(medians: list[tuple[int, Key]]) -> Key:
    """The least key that at least half of the weight does not exceed."""
    half, seen = sum(n for n, _ in medians) / 2, 0
    for n, key in sorted(medians, key=lambda x: x[1]):
        seen += n
        if seen >= half:
            return key
    raise ValueError("no keys")


def cutoff(keys: DataFrame, k: int, block: int = BLOCK, at_once: int = 4096) -> tuple[Key | None, list[int]]:
    """The ``k``-th greatest of the different keys (k0, k1, k2), and how many were in question before each round.

    None if ``k`` is 0.  At most ``at_once`` keys are not divided further but sorted.  Read ``keys`` from a stored table: every
    round scans them.
    """
    if k < 1:
        return None, []

    def near() -> DataFrame:
        # Scores outside the range still in question need no look; row groups are skipped by them.
        frame = keys if lo is None else keys.filter(F.col("k0") >= lo[0])
        return frame if hi is None else frame.filter(F.col("k0") <= hi[0])

    def scan(pivot: Key | None) -> dict[int, list[tuple[int, Key]]]:
        out: dict[int, list[tuple[int, Key]]] = {1: [], 0: [], -1: []}
        for r in arrow_map(near(), _medians(pivot, lo, hi, block), _KEYS).collect():
            out[r.side].append((r.n, (r.k0, r.k1, r.k2)))
        return out

    lo = hi = None
    medians, rounds = scan(None)[1], []
    while True:
        rounds.append(sum(n for n, _ in medians))
        if not 1 <= k <= rounds[-1]:
            raise ValueError(f"no key number {k} of {rounds[-1]}")
        if rounds[-1] <= at_once:
            left = near().filter(_compare(lo, ">") & _compare(hi, "<"))
            return sorted((tuple(r) for r in left.select("k0", "k1", "k2").collect()), reverse=True)[k - 1], rounds
        pivot = weighted_median(medians)
        found = scan(pivot)
        above = sum(n for n, _ in found[1])
        if above >= k:
            lo, medians = pivot, found[1]
        elif above + sum(n for n, _ in found[0]) >= k:
            return pivot, rounds
        else:
            k -= above + 1
            hi, medians = pivot, found[-1]


def _compare(key: Key | None, sign: str) -> Column:
    """Whether a row's key is beyond ``key``; every key is where there is none."""
    if key is None:
        return F.lit(True)
    other = ", ".join(f"CAST({v} AS BIGINT) AS k{i}" for i, v in enumerate(key))
    return F.expr(f"named_struct('k0', k0, 'k1', k1, 'k2', k2) {sign} struct({other})")


def draw(scored: DataFrame, least: int = 20, percent: int = 10, block: int = BLOCK) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 ... for the drawn rows in the order of their scores, null for the others.

    Of the N rows with at least ``least`` words (``n_words``) the ``percent * N // 100`` with the highest scores are drawn, ties to
    the smaller ``doc_id`` (null before all), then to the row stored first.
    """
    if not 0 <= percent <= 100:
        raise ValueError(f"percent must be in 0..100, not {percent}")
    # ``scored`` is stored once: the rounds read the keys, and each row keeps its number.
    own = {c: f"own_{c}" for c in scored.columns}
    out = f"{shared_folder(scored.sparkSession, 'resampling')}/scored"
    least_id = F.lit(-(1 << 63) + 1)
    scored.withColumnsRenamed(own).withColumns(
        {
            "k0": F.when(F.col(own["n_words"]) >= least, F.col(own["score"])),
            "k1": -F.greatest(F.coalesce(F.col(own["doc_id"]).cast("long"), least_id), least_id),
            "k2": -F.monotonically_increasing_id(),
        }
    ).write.parquet(out)
    stored = scored.sparkSession.read.parquet(out)
    keys = stored.select("k0", "k1", "k2").filter("k0 IS NOT NULL")
    k = keys.count() * percent // 100
    least_key, _ = cutoff(keys, k, block)
    if least_key is None:
        ranked, rest = stored.filter("false").withColumn("rank", F.lit(None).cast("long")), stored
    else:
        won = F.col("k0").isNotNull() & _compare(least_key, ">=")
        better = stored.filter(won).withColumns({f"r{i}": -F.col(f"k{i}") for i in range(3)})
        ranked = sequence_within(better, [], ["r0", "r1", "r2"], seq_col="rank").drop("is_last", "r0", "r1", "r2")
        rest = stored.filter(~won)
    ranked = ranked.withColumn("rank", F.col("rank").cast("long"))
    both = ranked.unionByName(rest.withColumn("rank", F.lit(None).cast("long"))).drop("k0", "k1", "k2")
    return both.select(*[F.col(aside).alias(c) for c, aside in own.items() if c != "rank"], "rank")


def resample(
    docs: DataFrame,
    target: DataFrame,
    ngram: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
    least: int = 20,
    percent: int = 10,
) -> DataFrame:
    """``docs`` without its text, with ``n_features``, ``n_words``, ``weight``, ``score`` and ``rank`` (see :func:`draw`), all long.

    Words are runs of digits, letters a-z (after lower-casing A-Z) and anything from U+0080 on.  Null and empty texts
    have no feature, weight 0 and too few words to be drawn.  Repeated rows are drawn each for itself; with an empty target the
    weights only favour what is rare in the corpus.  An empty table gives no rows.  Columns of ``docs`` with those names give way.
    """
    return draw(score(docs, target, ngram, buckets, seed), least, percent)
