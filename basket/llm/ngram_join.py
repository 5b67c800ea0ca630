"""Similarity join on word n-grams: MinHash banding, then verification on the full n-gram sets.

1. One Arrow pass makes each document's five-word shingle hashes, a MinHash signature and its band hashes, and a
   128-bit hash of its word sequence.  Documents with equal word sequences are copies: they collapse to one
   representative, so a hot group of copies costs one row from here on.
2. Band and row counts are chosen for a target recall at the threshold.  Representatives are shuffled on their band
   hashes only.  Each bucket links its members to its least member (a star, never all pairs), and connected
   components of the stars gather everything that could be similar.
3. Components are verified on the full shingle sets.  A component of more than ``BLOCK`` members (or
   ``BLOCK_GRAMS`` shingles) is dealt into blocks and each pair of blocks is a task of its own, so no group is ever
   gathered in one place; within a task, all pairs are counted by matrix products, whether or not they share a band
   themselves.  Pairs are never written out: a task returns, per document, its number of links and a root it is connected with.
4. Components of the verified links are the similarity classes.

The work in a component of m different texts grows with m squared (each pair is checked, as the exact number of
links needs), but spread evenly over m / BLOCK squared tasks of fixed size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (used as pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basket.llm.common import (
    SPACE_BYTES,
    arrow_map,
    constants,
    cut,
    extend,
    filtered,
    mix,
    ship,
    signed,
    slices,
    span_hashes,
    utf8,
    word_spans,
)

N, THRESHOLD, RECALL, MAX_HASHES = 5, 0.8, 0.999, 256
BLOCK, BLOCK_GRAMS = 512, 1 << 20
#: A set of candidates up to this many rows (ids of 8 bytes) is broadcast; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000
#: Steps along broadcast pointers in a round of :func:`components`; they cost no shuffle.
JUMPS = 6


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band whose bands reach ``recall`` at ``threshold`` within ``max_hashes``.

    A pair of similarity s shares a band with probability 1 - (1 - s**rows)**bands; more rows
    a band mean fewer needless candidates.
    """
    best = (max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold))), 1) if threshold < 1 else (1, 1)
    rows = 2
    while threshold < 1:
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows > max_hashes:
            break
        best, rows = (bands, rows), rows + 1
    return best


def shingles(column: pa.Array, n: int = N):
    """Shingle hashes of all texts with the document of each, words per document, and two word-sequence hashes.

    Words are runs of anything but ASCII white space, lower-cased; a text of fewer than n words, but not
    none, is one shingle.
    """
    data, offsets = utf8(pa.compute.utf8_lower(pa.compute.fill_null(column.cast(pa.large_string()), "")))
    docs = len(offsets) - 1
    start, end, doc = word_spans(data, offsets, SPACE_BYTES)
    words = span_hashes(data, start, end)
    first = np.searchsorted(doc, np.arange(docs + 1))
    count = np.diff(first)
    c = constants(n, 17)
    windows = max(0, len(words) - n + 1)
    grams = np.zeros(windows, np.uint64)
    for j in range(n):
        grams += words[j : j + windows] * c[j]
    full = doc[:windows] == doc[n - 1 :] if windows else np.empty(0, bool)
    grams, owner = mix(grams[full]), doc[:windows][full]
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        own = np.array(
            [sum(int(words[first[i] + j]) * int(c[j]) for j in range(count[i])) + int(count[i]) for i in short.tolist()],
            dtype=object,
        )
        extra = mix(np.array([x & 0xFFFFFFFFFFFFFFFF for x in own], np.uint64))
        grams, owner = np.concatenate((grams, extra)), np.concatenate((owner, short))
        order = np.argsort(owner, kind="stable")
        grams, owner = grams[order], owner[order]
    place = (np.arange(len(words)) - first[doc]).astype(np.uint64) if len(words) else np.empty(0, np.uint64)
    keys = []
    for seed in (3, 5):
        per = mix(words ^ mix(place * constants(1, seed)[0] + np.uint64(seed)))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(per, dtype=np.uint64)))
        keys.append(sums[first[1:]] - sums[first[:-1]])
    return grams, owner, count, keys


def _signature(grams: np.ndarray, mult: np.ndarray, add: np.ndarray) -> np.ndarray:
    x = (grams >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(mult), 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(x), 1024):
        h = mult[:, None] * x[None, lo : lo + 1024]
        h += add[:, None]
        np.minimum(best, h.min(axis=1), out=best)
    return best


def _sign(n, bands, rows):
    def run(batches):
        k = constants(2 * bands * rows, 101)
        mult = ((k[: bands * rows] >> np.uint64(32)).astype(np.uint32)) | np.uint32(1)
        add = (k[bands * rows :] >> np.uint64(32)).astype(np.uint32)
        row_mix, band_mix = constants(rows, 7), constants(bands, 11)
        for batch in slices(batches, "text", 2 << 20):
            grams, owner, count, keys = shingles(batch.column("text"), n)
            bounds = np.searchsorted(owner, np.arange(len(count) + 1))
            hashes: list = []
            for i in range(len(count)):
                if not count[i]:
                    hashes.append(None)
                    continue
                sig = _signature(grams[bounds[i] : bounds[i + 1]], mult, add).astype(np.uint64).reshape(bands, rows)
                hashes.append(mix((sig * row_mix).sum(axis=1, dtype=np.uint64) ^ band_mix).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(count.astype(np.int64)),
                    signed(keys[0]),
                    signed(keys[1]),
                    pa.array(np.diff(bounds).astype(np.int64)),
                    pa.array(hashes, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_words", "k1", "k2", "n_grams", "bands"],
            )

    return run


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(
        narrow, _sign(n, bands, rows), "doc_id long, n_words long, k1 long, k2 long, n_grams long, bands array<long>"
    )


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` (the least node of its connected component) for every node of the edges.

    Each round points a node at its least lower neighbour, follows these pointers some steps, and links the nodes that an edge's
    ends lead to; it is cut off with a checkpoint.  The rounds end when every pointer leads to a root and no edge joins two of
    them; their number grows with the logarithm of the longest path.  Pointers are broadcast up to ``BROADCAST_ROWS`` edges
    (no shuffle on a node with very many neighbours), and joined by shuffle beyond; nodes never reach a single task.
    """
    pairs = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    n, unsettled = pairs.count(), True
    while n and unsettled:
        few = n <= BROADCAST_ROWS
        low = pairs.groupBy("u").agg(F.min("v").alias("m"))
        # Stored, joins are between plain shuffles: adaptive execution splits those where very many nodes meet one.
        low = low if few else cut(low)

        def pointed(rows: DataFrame, at: str, pointers: DataFrame, names: list[str], how: str = "left", few: bool = few) -> DataFrame:
            to = pointers.toDF(*names)
            return rows.join(F.broadcast(to) if few else to, rows[at] == to[names[0]], how)

        up = low.select("u", "m", F.col("m").alias("before"))
        for _ in range(JUMPS if few else 1):
            up = pointed(up, "m", low, ["_u", "_m"]).select("u", F.coalesce("_m", "m").alias("m"), F.col("m").alias("before"))
        # A node without a lower neighbour is a root; a pointer that stayed in its last step leads to one.
        up = up.select("u", "m", (F.col("m") != F.col("before")).alias("moves"))
        up = up if few else cut(up)
        ends = pointed(pointed(pairs, "u", up, ["_u", "a", "_a"], "inner"), "v", up, ["_v", "_m", "_b"])
        ends = ends.select("u", "a", F.coalesce("_m", "v").alias("b"), (F.col("_a") | F.coalesce("_b", F.lit(False))).alias("moves"))
        own = F.struct("u", F.col("a").alias("v"), F.col("moves").alias("open"))
        across = F.struct(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"), F.lit(True).alias("open"))
        found = ends.select(F.explode(F.array(own, across)).alias("e")).select("e.*").filter("u <> v")
        found = cut(found.groupBy("u", "v").agg(F.max("open").alias("open")))
        n, unsettled = found.agg(F.count("*"), F.max("open")).head()
        pairs = found.select("u", "v")
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _sets(n):
    """Rows of candidates with their text become rows with their sorted shingle set."""

    def run(batches):
        for batch in slices(batches, "text", 2 << 20):
            grams, owner, count, keys = shingles(batch.column("text"), n)
            bounds = np.searchsorted(owner, np.arange(len(count) + 1))
            same = (keys[0].view(np.int64) == batch.column("k1").to_numpy()) & (
                keys[1].view(np.int64) == batch.column("k2").to_numpy()
            )
            kept = np.flatnonzero(same)
            sets = [np.unique(grams[bounds[i] : bounds[i + 1]]).view(np.int64) for i in kept.tolist()]
            at = pa.array(kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(at) for c in ("rid", "comp", "nb")] + [pa.array(sets, pa.list_(pa.int64()))],
                ["rid", "comp", "nb", "grams"],
            )

    return run


def _links(values: np.ndarray, bounds: np.ndarray, left: int, cross: bool, threshold: float) -> np.ndarray:
    """Boolean matrix of the members' verified links; with ``cross`` only between the first ``left`` and the rest."""
    m = len(bounds) - 1
    size = np.diff(bounds)
    # similarity cannot exceed the ratio of the sizes
    todo = np.minimum(size[:, None], size[None, :]) >= threshold * np.maximum(size[:, None], size[None, :])
    todo &= np.triu(np.ones((m, m), bool), 1)
    if cross:
        todo[:left, :left] = todo[left:, left:] = False
    out = np.zeros((m, m), bool)
    if not todo.any():
        return out
    if int(todo.sum()) < 4 * m:
        for i, j in zip(*np.nonzero(todo), strict=True):
            a, b = values[bounds[i] : bounds[i + 1]], values[bounds[j] : bounds[j + 1]]
            common = len(a) + len(b) - len(np.union1d(a, b))
            out[i, j] = common >= threshold * (len(a) + len(b) - common) - 1e-9
    else:
        owner = np.repeat(np.arange(m), size)
        order = np.argsort(values, kind="stable")
        owner, ordered = owner[order], values[order]
        new = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(ordered) else np.empty(0, bool)
        column = np.cumsum(new) - 1
        shared = np.bincount(column)[column] > 1  # a shingle of one member cannot be common
        owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
        common = np.zeros((m, m), np.float32)
        width = 4096
        cuts = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else -1) + 1 + width, width))
        for k, (lo, hi) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
            has = np.zeros((m, width), np.float32)
            has[owner[lo:hi], column[lo:hi] - k * width] = 1
            common += has @ has.T
        union = size[:, None] + size[None, :] - common
        out = todo & (common >= threshold * union - 1e-6)
    return out | out.T


def _verify(threshold):
    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        rid = group.column("rid").to_numpy()
        _, keep = np.unique(rid, return_index=True)
        side = group.column("side").to_numpy()[keep]
        keep = keep[np.argsort(side, kind="stable")]
        rid, side = rid[keep], group.column("side").to_numpy()[keep]
        at = pa.array(keep)
        grams = group.column("grams").combine_chunks().take(at)
        size = pa.compute.list_value_length(grams).to_numpy(zero_copy_only=False)
        bounds = np.concatenate(([0], np.cumsum(size)))
        values = grams.flatten().to_numpy()
        cross = key[1].as_py() != key[2].as_py()
        linked = _links(values, bounds, int((side == 0).sum()), cross, threshold)
        number = linked.sum(axis=1)
        root = np.arange(len(rid))
        by_rid = np.argsort(rid, kind="stable")
        seen = np.zeros(len(rid), bool)
        for start in by_rid.tolist():  # flood from the least document on
            if seen[start] or not number[start]:
                continue
            front = np.zeros(len(rid), bool)
            front[start] = True
            reached = front.copy()
            while front.any():
                front = linked[front].any(axis=0) & ~reached
                reached |= front
            seen |= reached
            root[reached] = start
        some = number > 0
        return pa.table(
            {
                "rid": pa.array(rid[some], pa.int64()),
                "links": pa.array(number[some], pa.int64()),
                "root": pa.array(rid[root[some]], pa.int64()),
                "whole": pa.array(group.column("nb").to_numpy()[keep][some] == 1),
            }
        )

    return run


def _texts_of(docs: DataFrame, signed_docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``wanted`` (one a word sequence) with their text, each once.

    A row whose id no other row has finds its text by that id.  Null ids, and ids of several rows, say nothing of
    the text: those rows' word sequences are computed again, and one text of each wanted sequence is kept, so the work
    is linear however many rows share an id or repeat a row.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))
    few = wanted.count() <= BROADCAST_ROWS

    def bounded(rows: DataFrame) -> DataFrame:
        return F.broadcast(rows) if few else rows

    def having(rows: DataFrame, column: str, ids: DataFrame, how: str = "left_semi") -> DataFrame:
        return rows.join(bounded(ids), rows[column].eqNullSafe(ids["_id"]), how)

    ids = wanted.select(F.col("doc_id").alias("_id")).distinct()
    uses = having(signed_docs.select("doc_id"), "doc_id", ids).groupBy("doc_id").agg(F.count("*").alias("uses"))
    shared = cut(uses.filter("doc_id IS NULL OR uses > 1").select(F.col("doc_id").alias("_id")))
    found = []
    clashing = not shared.isEmpty()
    own = having(wanted, "doc_id", shared, "left_anti") if clashing else wanted
    own_ids = own.select(F.col("doc_id").alias("_id")) if clashing else ids
    mine = having(texts, "_id", own_ids)
    found.append(mine.join(own, mine["_id"].eqNullSafe(own["doc_id"])).drop("_id", "doc_id"))
    if clashing:
        keys = having(wanted, "doc_id", shared).drop("doc_id")
        keyed = extend(having(texts, "_id", shared).select("text"), _row_keys, "k1 long, k2 long")
        meant = keyed.join(bounded(keys.select("k1", "k2")), ["k1", "k2"], "left_semi")
        # Copies meet in the map-side aggregate, so a row repeated many times is one row a task.
        once = meant.groupBy("k1", "k2").agg(F.min("text").alias("text"))
        found.append(once.join(keys, ["k1", "k2"]).select(found[0].columns))
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def similar(
    docs: DataFrame,
    n: int = N,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    max_hashes: int = MAX_HASHES,
) -> DataFrame:
    """One row per document: ``doc_id, class_id, copy_id, n_copies, n_links``.

    ``copy_id`` is the least doc_id with the same word sequence and ``n_copies`` the number of such rows.
    ``n_links`` counts the other word sequences whose shingle set has similarity ``threshold`` or
    more.  ``class_id`` is the least doc_id connected through copies and links.

    Documents without words (null, empty, white space) are neither copies nor similar: class and copy are the
    document itself, with one copy and no links.  Repeated rows are copies.  Null doc_ids take part and
    report a null copy_id only if all copies have none.  An empty table gives no rows.
    """
    return _similar(docs, n, threshold, recall, max_hashes)


def _similar(
    docs: DataFrame,
    n: int = N,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    max_hashes: int = MAX_HASHES,
    by_row: bool = False,
) -> DataFrame:
    """``similar``; ``by_row`` adds ``k1, k2`` (the word sequence, null without words) and ``kept``: whether the row is the least of its class.

    The order is by doc_id, null last, then by word sequence; rows equal in both are kept or not together.
    """
    ship(docs.sparkSession)
    bands, rows = choose_bands(threshold, recall, max_hashes)
    signed_docs = cut(signatures(docs, n, bands, rows).withColumn("rid", F.monotonically_increasing_id()))
    worded = signed_docs.filter("n_words > 0")
    classes = cut(
        worded.groupBy("k1", "k2").agg(F.min("rid").alias("rep"), F.min("doc_id").alias("copy_id"), F.count("*").alias("n_copies"))
    )
    # unique row ids on both sides
    reps = worded.join(classes.select(F.col("rep").alias("rid")), "rid").select("rid", "doc_id", "k1", "k2", "n_grams", "bands")
    reps = cut(reps)

    # 2. buckets and their stars
    exploded = reps.select("rid", F.explode("bands").alias("band"))
    buckets = exploded.groupBy("band").agg(F.min("rid").alias("least"), F.count("*").alias("n")).filter("n > 1")
    stars = exploded.join(cut(buckets.select("band", "least")), "band").filter("rid <> least").select("rid", "least").distinct()
    gathered = components(stars, "rid", "least")

    # 3. verification in blocks
    members = gathered.join(reps.drop("bands"), gathered["node"] == reps["rid"]).drop("node").withColumnRenamed("root", "comp")
    members = cut(members)
    sizes = members.groupBy("comp").agg(F.count("*").alias("m"), F.sum("n_grams").alias("g"))
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(2 * F.col("g") / BLOCK_GRAMS), F.lit(1)).cast("int")
    wanted = members.join(cut(sizes.select("comp", blocks.alias("nb"))), "comp").select("rid", "doc_id", "k1", "k2", "comp", "nb")
    wanted = cut(wanted)
    candidates = _texts_of(docs, signed_docs, wanted)
    sets = arrow_map(candidates, _sets(n), "rid long, comp long, nb int, grams array<long>")
    own = F.pmod(F.xxhash64("rid"), F.col("nb")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda j: F.struct(F.least(j, own).alias("lo"), F.greatest(j, own).alias("hi"), (own > j).cast("int").alias("side")))
    dealt = sets.select("*", F.explode(pairs).alias("p")).select("rid", "comp", "nb", "grams", "p.lo", "p.hi", "p.side")
    found = cut(
        dealt.groupBy("comp", "lo", "hi").applyInArrow(_verify(threshold), "rid long, links long, root long, whole boolean")
    )

    # 4. classes of verified links: finished where the component was one block
    facts = found.groupBy("rid").agg(F.sum("links").alias("n_links"), F.min(F.when(F.col("whole"), F.col("root"))).alias("whole_root"))
    joined = found.filter("NOT whole").filter("rid <> root")
    merged = components(joined, "rid", "root").withColumnRenamed("root", "merged_root")
    place = F.struct(F.col("copy_id").isNull(), "copy_id", "k1", "k2")
    own, least, lead = ([place.alias("place")], [F.min("place").alias("first")], [(F.col("place") == F.col("first")).alias("lead")]) if by_row else ([], [], [])
    rep_class = classes.join(facts, F.col("rep") == F.col("rid"), "left").join(merged, F.col("rep") == F.col("node"), "left")
    root, n_links = F.coalesce("whole_root", "merged_root", "rep").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    rep_class = cut(rep_class.select("k1", "k2", "copy_id", "n_copies", n_links, root, *own))
    named = cut(rep_class.groupBy("root").agg(F.min("copy_id").alias("class_id"), *least))
    by_key = cut(rep_class.join(named, "root").select("k1", "k2", "copy_id", "n_copies", "class_id", "n_links", *lead))
    kept = [F.col("k1"), F.col("k2"), (F.col("lead") & F.col("doc_id").eqNullSafe(F.col("copy_id"))).alias("kept")] if by_row else []
    with_words = worded.join(by_key, ["k1", "k2"]).select("doc_id", "class_id", "copy_id", "n_copies", "n_links", *kept)
    alone = signed_docs.filter("n_words = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_id"), F.lit(1).cast("long").alias("n_copies"), F.lit(0).cast("long").alias("n_links"),
        *([F.lit(None).cast("long").alias("k1"), F.lit(None).cast("long").alias("k2"), F.lit(True).alias("kept")] if by_row else []),
    )
    return with_words.unionByName(alone)


def _row_keys(batch: pa.RecordBatch) -> list[pa.Array]:
    """``k1`` and ``k2`` of each text, null without words."""
    _, _, count, keys = shingles(batch.column("text"))
    return [pa.array(k.astype(np.uint64).view(np.int64), mask=count == 0) for k in keys]


def deduplicate(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with one row of each similarity class: the least by doc_id (null last), then by word sequence.

    Rows that share doc_id and words count once, as the least of them by text (then by the other columns), and so do
    rows without words that share a doc_id and text.  All other rows without words stay, and all of those without a doc_id.
    Only rows whose doc_id (null included) several rows have, some of them kept, are judged one by one.
    Only narrow rows are joined by shuffle unless the ids to remove outgrow ``BROADCAST_ROWS``.
    """
    found = _similar(docs, by_row=True, **parameters)
    per = cut(found.groupBy(F.col("doc_id").alias("_id")).agg(F.max("kept").alias("some"), F.count("*").alias("n")))
    shared = per.filter("some AND n > 1").select("_id")

    def bounded(ids: DataFrame) -> DataFrame:
        return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids

    def joined(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
        return rows.join(bounded(ids), rows["doc_id"].cast("long").eqNullSafe(ids["_id"]), how)

    if shared.isEmpty():
        return joined(docs, per.filter("NOT some").select("_id"), "left_anti")
    first = found.filter("kept AND k1 IS NOT NULL").select("doc_id", F.col("k1").alias("_w1"), F.col("k2").alias("_w2"))
    first = cut(joined(first, shared, "left_semi").withColumnRenamed("doc_id", "_d").distinct())

    def one_by_one(rows: DataFrame) -> DataFrame:
        keyed = extend(joined(rows, shared, "left_semi"), _row_keys, "_k1 long, _k2 long").withColumn("_id", F.col("doc_id").cast("long"))
        same = F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_k1") == F.col("_w1")) & (F.col("_k2") == F.col("_w2"))
        wordless = keyed.filter("_k1 IS NULL")
        repeats = keyed.join(first, same, "left_semi").unionByName(wordless.filter("_id IS NOT NULL"))
        # Maps have no order.
        order = F.struct("text", *[f.name for f in rows.schema if "map<" not in f.dataType.simpleString()])
        by = [F.col("_id"), F.col("_k1"), F.col("_k2"), F.when(F.col("_k1").isNull(), F.col("text")).alias("_t")]
        once = repeats.groupBy(*by).agg(F.min_by(F.struct(*rows.columns), order).alias("_row")).select("_row.*")
        return once.unionByName(wordless.filter("_id IS NULL").select(*rows.columns))

    whole = joined(docs, per.filter("NOT some OR n > 1").select("_id"), "left_anti")
    return whole.unionByName(filtered(docs, {"_id", "_k1", "_k2", "_d", "_w1", "_w2", "_t", "_row"}, one_by_one))
