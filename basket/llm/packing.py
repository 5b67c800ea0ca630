"""Bounded-space online best-fit packing of tokenized documents.

Method: each task streams its documents once.  A document becomes its ids plus an
end id; one longer than ``capacity`` is cut into ``capacity``-token pieces, the first
piece taking the remainder.  Pieces go online into the open sequence with the
least sufficient free space.  At most ``max_open`` sequences are open in a task; an integer with
one bit per free-space value (the bitset) finds the best fit with one shift, and when a
new sequence would exceed the bound the fullest open one closes.  Each Arrow batch is
placed longest piece first, a look-ahead that leaves small pieces to fill gaps.

There is no shuffle and no state beyond the open sequences' fill counts, so a lost
executor costs only its own tasks.  Sequence numbers are unique over the job: the
task's partition number in the high bits, the sequence's number within it in the low.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basket.llm.common import arrow_map, slices
from basket.llm.tokenize import KEEPS, encoder, with_end

SCHEMA = "doc_id long, piece int, start long, length long, sequence_id long, offset long, ids binary"
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("ids", pa.binary()),
    ]
)


class BestFit:
    """Open sequences keyed by free space; ``place`` returns (sequence number, offset)."""

    def __init__(self, capacity: int, max_open: int):
        self.capacity, self.max_open = capacity, max_open
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = 0  # bit f is set while some open sequence has f tokens free
        self.open = 0
        self.made = 0

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        seq = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.open -= 1
        return seq

    def place(self, size: int) -> tuple[int, int]:
        if not 0 < size <= self.capacity:
            raise ValueError(f"a piece has 1 to {self.capacity} tokens, not {size}")
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            seq = self._take(free)
        else:
            free, seq = self.capacity, self.made
            self.made += 1
        left = free - size
        if left:
            if self.open >= self.max_open:
                self._take((self.bits & -self.bits).bit_length() - 1)
            self.by_free[left].append(seq)
            self.bits |= 1 << left
            self.open += 1
        return seq, self.capacity - free


def pieces_of(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter than ``capacity``."""
    first = total % capacity or min(capacity, total)
    return [(0, first), *((s, capacity) for s in range(first, total, capacity))]


def _pack(path, pieces, end_id, capacity, max_open, remembered):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pieces, limit=remembered)
        base = TaskContext.get().partitionId() << 40
        bins = BestFit(capacity, max_open)
        for batch in slices(batches, "text", 2 << 20):
            ids, ends = with_end(*enc.encode(batch.column("text")), end_id)
            data, ends = ids.tobytes(), ends.tolist()
            rows = []
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), ends, ends[1:], strict=False):
                for piece, (start, length) in enumerate(pieces_of(b - a, capacity)):
                    rows.append((doc_id, piece, start, length, data[4 * (a + start) : 4 * (a + start + length)]))
            rows.sort(key=lambda r: -r[3])
            placed = [bins.place(r[3]) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int32()),
                    pa.array([r[2] for r in rows], pa.int64()),
                    pa.array([r[3] for r in rows], pa.int64()),
                    pa.array([base + p[0] for p in placed], pa.int64()),
                    pa.array([p[1] for p in placed], pa.int64()),
                    pa.array([r[4] for r in rows], pa.binary()),
                ],
                schema=_ARROW,
            )

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    pieces: str = "leading",
    end_id: int = 0,
    capacity: int = 2048,
    max_open: int = 4096,
    remembered: int = 600_000,
) -> DataFrame:
    """One row per piece with its ids (little-endian uint32), sequence and place in it.

    ``remembered`` bounds the pieces of text whose ids a Python worker keeps (memory against speed).

    Null text counts as empty (the document is its end id alone).  Null ``doc_id``
    stays null.  Repeated rows are packed once each.  An empty table gives no rows.  Other
    columns of ``docs`` are ignored.  Give it a stored table: the rows of a task
    must come in the same order when the task is run again.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(narrow, _pack(tokenizer, pieces, end_id, capacity, max_open, remembered), SCHEMA, keeps=KEEPS)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: one row each with its ids, built from the placed pieces.

    A sequence has at most ``capacity`` tokens, so each group is bounded.
    """
    ordered = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    return (
        packed.groupBy("sequence_id")
        .agg(ordered.alias("p"))
        .select(
            "sequence_id",
            F.expr("aggregate(p, CAST('' AS BINARY), (a, x) -> concat(a, x.ids))").alias("ids"),
            F.expr("transform(p, x -> struct(x.doc_id, x.piece, x.offset, x.length))").alias("pieces"),
        )
    )
