"""Filter interaction audit: what each filter removes, alone and after others, for every order of the filters.

Method: each document's five failures are measured once and are five bits.  A part of the corpus is then a 2x2x2x2x2 tensor
of counts, one axis for each filter (0 passes, 1 fails), and so are its documents of good quality and its toxic ones.  All
figures are contractions of these tensors: along every axis a step selects ``pass`` = (1, 0), ``fail`` = (0, 1) or
``all`` = (1, 1), and ``einsum`` contracts the tensors with the selectors of all steps of all orders at once.  No order is ever
applied to the documents again.

The texts are read by one pass, which leaves a narrow row (id, part, four bits, hash of the text).  The duplicate filter needs the
smallest id of each text over the whole table: those come from an aggregate that combines before it
shuffles, so a text with millions of copies costs a row a task.  Only the one document that passes meets its rows again, by
text and id, and the others of its cell are the difference.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basket.llm.common import SPACE_BYTES, arrow_map, shared_folder, slices, utf8, word_spans

#: The filters in the order of the tensor's axes, the first in the lowest bit.  The last is the duplicate filter.
FILTERS = "ABCDE"
#: Measures of a cell: documents, those of good quality, toxic ones.
MEASURES = ("n", "good", "toxic")
_SELECT = {"pass": (1, 0), "fail": (0, 1), "all": (1, 1)}
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS)
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#$%&*|")] = True


def failures(column: pa.Array) -> np.ndarray:
    """Bits of the first four filters for each text (null: empty)."""
    data, offsets = utf8(column)
    docs = len(offsets) - 1
    start, end, doc = word_spans(data, offsets, SPACE_BYTES)
    words = np.bincount(doc, minlength=docs)
    cuts = np.concatenate(([0], np.cumsum(end - start))).astype(np.int64)
    letters = np.ascontiguousarray(data[SPACE_BYTES[data]])
    numbered = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(cuts), pa.py_buffer(letters)).dictionary_encode()
    pairs = np.unique((doc << 32) | numbered.indices.to_numpy())
    distinct = np.bincount(pairs >> 32, minlength=docs)

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags)))
        return total[offsets[1:]] - total[offsets[:-1]]

    capitals = per_text(data - np.uint8(65) < 26)
    points = per_text((data & 0xC0) != 0x80)
    failed = (words < 50, 100 * distinct < 65 * words, 100 * capitals > 5 * points, per_text(_SYMBOLS[data]) > 0)
    return sum(f.astype(np.int32) << i for i, f in enumerate(failed))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        columns = [batch.column("doc_id"), batch.column("part"), pa.array(failures(batch.column("text"))), batch.column("same")]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "bits", "same"])


def measure(docs: DataFrame) -> DataFrame:
    """One narrow row for each document: doc_id, part (null: empty), the bits of the first four filters, SHA-256 of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("same"),
        text.alias("text"),
    )
    return arrow_map(narrow, _measured, "doc_id long, part string, bits int, same binary")


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by (part, bits of all five filters): ``n``, ``good`` and ``toxic``; only cells that have some.

    A document counts as good (toxic) where any label row of its id says so.
    """
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    # Equal rows become one with their number before anything is joined, so a repeated row is no hot key.
    rows = measure(docs).groupBy("same", "doc_id", "part", "bits").agg(F.count("*").alias("n"))
    counted = [(F.coalesce(F.col(m), F.lit(0)) * F.col("n")).alias(m) for m in MEASURES[1:]]
    out = f"{shared_folder(docs.sparkSession, 'filter-audit')}/rows"
    rows.join(marks, "doc_id", "left").select("same", "doc_id", "part", "bits", "n", *counted).write.parquet(out)
    rows = docs.sparkSession.read.parquet(out)
    # No smaller id has the text: its smallest id (on every row that repeats it), or no id at all.
    first = rows.groupBy("same").agg(F.min("doc_id").alias("doc_id"))
    passing = rows.join(first, ["same", "doc_id"], "left_semi").unionByName(rows.filter("doc_id IS NULL"))
    duplicate = (F.col("bits") + (1 << len(FILTERS) - 1)).alias("bits")
    parts = [
        passing.select("part", "bits", *MEASURES),
        rows.select("part", duplicate, *MEASURES),
        passing.select("part", duplicate, *[(-F.col(m)).alias(m) for m in MEASURES]),
    ]
    sums = reduce(DataFrame.unionByName, parts).groupBy("part", "bits").agg(*[F.sum(m).alias(m) for m in MEASURES])
    return sums.filter("n > 0")


def steps() -> list[tuple[str, int]]:
    """(filter order, step) of all orders, sorted."""
    return [("".join(p), i + 1) for p in permutations(FILTERS) for i in range(len(FILTERS))]


def selectors() -> dict[str, np.ndarray]:
    """For each figure an array [step, axis, 2]: what every step of every order takes along each filter's axis."""
    out = {}
    for figure, own, before, after in (
        ("kept", "pass", "pass", "all"),
        ("removed", "fail", "pass", "all"),
        ("failing", "fail", "all", "all"),
        ("unique_fails", "fail", "pass", "pass"),
    ):
        rows = []
        for order, step in steps():
            place = {f: i + 1 for i, f in enumerate(order)}
            rows.append([_SELECT[own if place[f] == step else before if place[f] < step else after] for f in FILTERS])
        out[figure] = np.array(rows, np.int64)
    return out


def contract(tensors: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """[part, step] sums of ``tensors`` [part, 2, 2, 2, 2, 2] over what ``chosen`` selects along each axis."""
    # The lowest bit is the last axis of the reshaped counts.
    return np.einsum("pedcba,sa,sb,sc,sd,se->ps", tensors, *[chosen[:, i] for i in range(len(FILTERS))], optimize="greedy")


def _figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chosen, names = selectors(), steps()
    own = np.array([FILTERS.index(order[step - 1]) for order, step in names])
    for batch in batches:
        for lo in range(0, batch.num_rows, 64):
            part = batch.slice(lo, 64)
            tensors = {}
            for m in MEASURES:
                flat = pc.list_flatten(part.column(m)).to_numpy()
                tensors[m] = flat.reshape(part.num_rows, *[2] * len(FILTERS))
            kept, removed, failing, unique = (contract(tensors["n"], chosen[f]) for f in ("kept", "removed", "failing", "unique_fails"))
            shapley = np.stack([removed[:, own == i].sum(axis=1) for i in range(len(FILTERS))], axis=1)[:, own]
            lost = [contract(tensors[m], chosen["removed"]) for m in MEASURES[1:]]
            counts = [kept, removed, failing - removed, unique, *lost, shapley]
            orders = pa.array([o for o, _ in names] * part.num_rows)
            at = pa.array([s for _, s in names] * part.num_rows, pa.int32())
            which = pa.array(np.repeat(np.arange(part.num_rows), len(names)))
            columns = [part.column("part").take(which), orders, at, *[pa.array(c.ravel()) for c in counts]]
            yield pa.RecordBatch.from_arrays(columns, ["part", "filter_order", "step", *_COUNTS])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    The filters fail a text with under 50 words (A), with under 65 % different words (B), with over 5 % capitals A-Z (C), with any of
    ``#$%&*|`` (D), or identical to the text of a smaller doc_id anywhere in the table (E).  Null texts are empty, so they are
    identical; rows that repeat an id and its text fail E together or not at all; a null id is smaller than none and fails
    never.  Null and empty sources are one part.  An empty table gives no rows; columns other than doc_id, text
    and source (labels: doc_id, quality, toxic) are ignored.
    """
    cell = F.struct("bits", *MEASURES)
    size = 1 << len(FILTERS)
    # At most 32 cells a part come together.
    parts = cells(docs, labels).groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("bits", cell.alias("c")))).alias("m"))
    arrays = [F.expr(f"transform(sequence(0, {size - 1}), i -> coalesce(m[i].{m}, 0L))").alias(m) for m in MEASURES]
    return arrow_map(parts.select("part", *arrays), _figures, SCHEMA)
