"""Harmonic packing: reciprocal-capacity classes, each filled on its own with a fixed number of pieces.

A piece of ``n`` tokens is of class ``j`` when ``capacity / (j + 1) < n <= capacity / j``, and ``j`` pieces of class
``j`` always fit into one sequence, whatever their lengths.  So packing needs no search and no order: each class
has one open sequence, which closes with its ``j``-th piece.

What such a class wastes is the distance of its pieces from ``capacity / j``.  Documents may be cut, so
a document is first cut where that distance would be large: a head of exactly ``capacity // (j + 1)`` tokens, the largest
length of the next class (or of one after it, where that would leave a crumb), and the rest again in the same way, until
what is left wastes less than a ``padding`` share of its document.  As with unit fractions, two or three cuts are enough.

Workers pack independently: each task has its own open sequences and shares nothing.  When a task's rows
end, the pieces in its unfinished sequences (less than one sequence for each class) are laid end to end and cut at the capacity,
and the last of that is dealt into the classes 1, 2, 4, 8 ... of one piece each, whose lengths are powers of two.
A lost executor costs its own tasks only.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basket.llm.common import arrow_map, slices
from basket.llm.tokenize import KEEPS, encoder, with_end

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("ids", pa.binary()),
    ]
)
# Rows of one output batch.
_ROWS = 4096


def class_of(length: int, capacity: int) -> int:
    """The most pieces of this length that one sequence holds."""
    return capacity // length


def lengths_of(total: int, capacity: int, padding: float = 1 / 256, shortest: int = 16) -> list[int]:
    """The lengths a document of ``total`` tokens is cut into: whole sequences first, then ever smaller classes.

    The last piece may miss its class's full length by a token or a ``padding`` share of the document; no piece is
    cut off that is shorter than ``shortest``.
    """
    out = [capacity] * (total // capacity)
    rest = total % capacity
    while rest:
        j = class_of(rest, capacity)
        # The class after the first whose head leaves enough: rest - shortest >= capacity // i.
        i = max(j + 1, capacity // max(rest - shortest + 1, 1) + 1)
        head = capacity // i
        if capacity / j - rest <= max(1, padding * total) or head < shortest or rest - head < shortest:
            out.append(rest)
            break
        out.append(head)
        rest -= head
    return out


def powers_of(total: int) -> list[int]:
    """``total`` as distinct powers of two, the largest first."""
    return [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]


class Harmonic:
    """Open sequences by class.

    A piece is (document, start, ids), its ids in ``width`` bytes each; results are (document, start, ids, sequence, offset).
    """

    def __init__(self, capacity: int, width: int = 4):
        self.capacity, self.width, self.made = capacity, width, 0
        self.open: dict[int, list[tuple]] = {}

    def _close(self, pieces: list[tuple]) -> list[tuple]:
        out, offset, sequence = [], 0, self.made
        self.made += 1
        for doc, start, ids in pieces:
            out.append((doc, start, ids, sequence, offset))
            offset += len(ids) // self.width
        return out

    def place(self, doc, start: int, ids: bytes) -> list[tuple]:
        """Add a piece to its class; the pieces of the sequence that this completes."""
        length = len(ids) // self.width
        if not 0 < length <= self.capacity:
            raise ValueError(f"a piece has 1 to {self.capacity} tokens, not {length}")
        j = class_of(length, self.capacity)
        own = self.open.setdefault(j, [])
        own.append((doc, start, ids))
        return self._close(self.open.pop(j)) if len(own) == j else []

    def finish(self) -> list[tuple]:
        """The pieces of all unfinished sequences, cut anew so that nothing is padded."""
        pieces = [p for j in sorted(self.open) for p in self.open.pop(j)]
        total = sum(len(ids) for *_, ids in pieces) // self.width
        out, taken, left = [], [], 0
        sizes = iter([self.capacity] * (total // self.capacity) + powers_of(total % self.capacity))
        for doc, start, ids in pieces:
            while ids:
                left = left or next(sizes)
                n = min(left, len(ids) // self.width)
                taken.append((doc, start, ids[: n * self.width]))
                start, ids, left = start + n, ids[n * self.width :], left - n
                if not left:
                    out += self._close(taken)
                    taken = []
        return out


def _rows(placed: list[tuple], base: int) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(placed), _ROWS):
        doc, start, ids, sequence, offset = zip(*placed[lo : lo + _ROWS], strict=True)
        columns = [
            [d for d, _ in doc],
            start,
            [len(x) // 4 for x in ids],
            [n for _, n in doc],
            [base + q for q in sequence],
            offset,
            ids,
        ]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def _pack(path, pieces, end_id, capacity, padding, shortest, remembered):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pieces, limit=remembered)
        base = TaskContext.get().partitionId() << 40
        bins = Harmonic(capacity)
        for batch in slices(batches, "text", 2 << 20):
            ids, ends = with_end(*enc.encode(batch.column("text")), end_id)
            data, ends, placed = ids.tobytes(), ends.tolist(), []
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), ends, ends[1:], strict=False):
                doc, at = (doc_id, b - a), a
                for length in lengths_of(b - a, capacity, padding, shortest):
                    placed += bins.place(doc, at - a, data[4 * at : 4 * (at + length)])
                    at += length
            yield from _rows(placed, base)
        yield from _rows(bins.finish(), base)

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    pieces: str = "dropped",
    end_id: int = 1,
    capacity: int = 2048,
    padding: float = 1 / 256,
    shortest: int = 16,
    remembered: int = 600_000,
) -> DataFrame:
    """One row per piece: its document, ``start`` and ``length`` there, ``doc_tokens``, sequence, ``offset`` and ids (uint32 bytes).

    ``padding`` and ``shortest`` steer the cuts (see :func:`lengths_of`); ``remembered`` bounds the pieces of text whose ids a
    Python worker keeps.  Full sequences lack at most a little of ``capacity``; the few others have a power of two of tokens.

    Null and empty texts are their end id alone.  Null ``doc_id`` stays null; rows that repeat an id, and repeated
    rows, are documents of their own.  An empty table gives no rows; other columns of ``docs`` are ignored.  A very
    long text is as many whole sequences and one rest.  Give it a stored table: a task that is run again must meet its rows in the same order.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    run = _pack(tokenizer, pieces, end_id, capacity, padding, shortest, remembered)
    return arrow_map(narrow, run, SCHEMA, keeps=KEEPS)


def padded_length(tokens: Column, capacity: int) -> Column:
    """Tokens a sequence takes in training: its own at a power of two, else ``capacity``."""
    return F.when(F.bit_count(tokens) == 1, tokens).otherwise(F.lit(capacity))


def report(packed: DataFrame, capacity: int = 2048) -> DataFrame:
    """One row: sequences, pieces, tokens, padded tokens and their share (null when nothing was packed)."""
    per = packed.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), F.count("*").alias("pieces"))
    padded = F.sum(padded_length(F.col("tokens"), capacity) - F.col("tokens"))
    return per.agg(
        F.count("*").alias("sequences"),
        F.coalesce(F.sum("pieces"), F.lit(0)).alias("pieces"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
        F.coalesce(padded, F.lit(0)).alias("padding"),
        (padded / (padded + F.sum("tokens"))).alias("padding_share"),
    )
