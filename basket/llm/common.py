"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import basket
from basket.session import ensure_checkpoint_dir, scratch_folder

_U64 = np.uint64
# Odd 64-bit base of the polynomial word hash and the constants of its finaliser.
_BASE = 0x9E3779B97F4A7C15
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

#: Words of the near-duplicate and rule operators: anything but ASCII white space.
SPACE_BYTES = np.ones(256, bool)
SPACE_BYTES[[9, 10, 11, 12, 13, 32]] = False


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the cluster's shared checkpoint folder, deleted when the application ends."""
    d = scratch_folder(spark, name)
    return d[len("file:") :] if d.startswith("file:/") and not d.startswith("file://") else d


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def text_crc(doc_id: Column) -> Column:
    """crc32 of the id's decimal digits (the contract's fold function)."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Re-cut record batches so that each holds about ``limit`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        cum = np.cumsum(size)
        lo = 0
        while lo < n:
            base = cum[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(cum, base + limit, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes in one array, and the n + 1 offsets (null: empty)."""
    arr = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """(start, end, document number) of every maximal run of word bytes within a document."""
    if not len(data):
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    inside = is_word[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | begins[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | begins[1:])) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    return start, end, doc


_powers: dict[str, np.ndarray] = {"p": np.ones(1, _U64), "i": np.ones(1, _U64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["p"]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        for key, base in (("p", _BASE), ("i", inverse)):
            t = np.full(n, _U64(base), _U64)
            t[0] = 1
            _powers[key] = np.cumprod(t, dtype=_U64)
    return _powers["p"], _powers["i"]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift-multiply)."""
    x = (x ^ (x >> _U64(30))) * _U64(_MIX[0])
    x = (x ^ (x >> _U64(27))) * _U64(_MIX[1])
    return x ^ (x >> _U64(31))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: a prefix-sum polynomial, then the finaliser."""
    if not len(start):
        return np.empty(0, _U64)
    power, inverse = _power_tables(len(data) + 1)
    prefix = np.zeros(len(data) + 1, _U64)
    np.cumsum((data.astype(_U64) + _U64(1)) * power[: len(data)], out=prefix[1:])
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(_U64))


def constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit constants derived from a seed."""
    return mix(np.arange(1, n + 1, dtype=_U64) * _U64(_BASE) + _U64(seed)) | _U64(1)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(_U64).view(np.int64))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    Nothing to do where the workers' PYTHONPATH already has it (a cluster install);
    otherwise the package's sources go out through Spark's own file distribution.
    """
    root = Path(basket.__file__).resolve().parent.parent
    app = spark.sparkContext.applicationId
    if app in _shipped or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    archive = Path(tempfile.mkdtemp(prefix="basket-code-")) / "basket_package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted((root / "basket").rglob("*.py")):
            z.write(source, source.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def release_memory() -> None:
    """Give freed memory back to the system: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


#: What operators keep in a Python worker from task to task: name -> how to drop it.
_kept: dict[str, Callable[[], None]] = {}


def keep_between_tasks(name: str, drop: Callable[[], None]) -> None:
    _kept[name] = drop


def _drop_powers() -> None:
    _powers.update({"p": np.ones(1, _U64), "i": np.ones(1, _U64)})


# Sixteen bytes for each byte of the longest slice; a task makes them anew in some milliseconds.
keep_between_tasks("powers", _drop_powers)


def begin_task(keeps: str) -> None:
    """Drop what another operator's tasks left in this worker."""
    for name, drop in _kept.items():
        if name != keeps:
            drop()
    release_memory()


def arrow_map(df: DataFrame, function, schema, keeps: str = "") -> DataFrame:
    """``mapInArrow`` with this package on the workers' path; tasks leave no freed memory behind.

    ``keeps`` names what the function remembers between tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task(keeps)
        try:
            yield from function(batches)
        finally:
            release_memory()

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def extend(df: DataFrame, function, ddl: str, limit: int = 4 << 20) -> DataFrame:
    """Add the columns of ``ddl``, which ``function(record_batch) -> list of arrays`` makes from each slice.

    All columns of ``df`` pass through; one whose name is also in ``ddl`` gives way to the new one.
    """
    new = T.StructType.fromDDL(ddl)
    taken = {f.name.lower() for f in new}
    kept = [f for f in df.schema if f.name.lower() not in taken]
    names = [f.name for f in kept] + [f.name for f in new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", limit):
            old = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays(old + function(batch), names)

    return arrow_map(df, run, T.StructType(kept + new.fields))


def filtered(docs: DataFrame, own: set[str], function) -> DataFrame:
    """``function(docs)`` with exactly the columns of ``docs``; those named like one in ``own`` stand aside meanwhile."""
    aside = {c: f"__{c}" if c.lower() in own else c for c in docs.columns}
    return function(docs.withColumnsRenamed(aside)).select(*[F.col(aside[c]).alias(c) for c in docs.columns])
