"""Length-delimited binary token records with an offset index.

A shard file is a run of frames, each: payload length (uint64), masked CRC-32 of those
eight bytes, the payload, masked CRC-32 of the payload (all little-endian).  The payload is a
flag byte (1: the document has an id), the id (int64) and the token ids, two bytes
each where every id fits and four otherwise.  A mask of rotate-by-15 plus a
constant keeps a checksum stored beside its own data from looking like one.

Writing: documents are range-partitioned and sorted by ``doc_id``; each task tokenizes
its range and streams one shard to the shared output folder, under a temporary name
until it is whole, then renamed.  A task that is run again writes the same bytes under the same name.
The offset index (document, shard, byte offset, number of tokens) is a separate
Parquet table, written by the same job, and is what shuffled reads use.

The checksum is CRC-32 as in zlib; files go through ``pyarrow.fs``, so the folder may be local,
S3, GCS or HDFS.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basket.llm.common import arrow_map, slices
from basket.llm.tokenize import KEEPS, encoder, with_end

_HEAD, _CRC, _ID = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<Bq")
_FRAME = _HEAD.size + 2 * _CRC.size
INDEX_SCHEMA = "doc_id long, shard int, offset long, n_tokens long"
READ_SCHEMA = "doc_id long, shard int, local_start long, n_tokens long, ids binary"


def masked(crc: int) -> int:
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = _HEAD.pack(len(payload))
    return b"".join((head, _CRC.pack(masked(zlib.crc32(head))), payload, _CRC.pack(masked(zlib.crc32(payload)))))


def read_frame(f) -> bytes | None:
    """The next payload, None at the end; a broken frame raises ValueError."""
    head = f.read(_HEAD.size)
    if not head:
        return None
    if len(head) < _HEAD.size or masked(zlib.crc32(head)) != _CRC.unpack(f.read(_CRC.size))[0]:
        raise ValueError("broken record length")
    payload = f.read(_HEAD.unpack(head)[0])
    if masked(zlib.crc32(payload)) != _CRC.unpack(f.read(_CRC.size))[0]:
        raise ValueError("broken record payload")
    return payload


def _payload(doc_id: int | None, ids: bytes) -> bytes:
    return _ID.pack(doc_id is not None, doc_id or 0) + ids


def _parse(payload: bytes) -> tuple[int | None, bytes]:
    has, doc_id = _ID.unpack_from(payload)
    return (doc_id if has else None), payload[_ID.size :]


def _folder(out: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(out)


def _name(shard: int) -> str:
    return f"part-{shard:06d}.rec"


_INDEX = pa.schema([("doc_id", pa.int64()), ("shard", pa.int32()), ("offset", pa.int64()), ("n_tokens", pa.int64())])


def _write(out, path, pieces, end_id, dtype):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, width = encoder(path, pieces, dtype), np.dtype(dtype).itemsize
        task = TaskContext.get()
        shard = task.partitionId()
        fs, folder = _folder(out)
        part, at, sink = f"{folder}/{_name(shard)}", 0, None
        for batch in slices(batches, "text", 2 << 20):
            if sink is None:
                fs.create_dir(folder, recursive=True)
                tmp = f"{part}.{task.taskAttemptId()}.tmp"
                sink = fs.open_output_stream(tmp)
            ids, ends = with_end(*enc.encode(batch.column("text")), end_id)
            data, cuts, places = ids.tobytes(), (ends * width).tolist(), []
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), cuts, cuts[1:], strict=False):
                framed = frame(_payload(doc_id, data[a:b]))
                sink.write(framed)
                places.append(at)
                at += len(framed)
            shards = np.full(len(places), shard, np.int32)
            # The index goes out slice by slice; a task that fails before the renaming has no output.
            columns = (batch.column("doc_id"), pa.array(shards), pa.array(places, pa.int64()), pa.array(np.diff(ends)))
            yield pa.RecordBatch.from_arrays(list(columns), schema=_INDEX)
        if sink is not None:
            sink.close()
            fs.move(tmp, part)

    return run


def write_records(
    docs: DataFrame, out: str, tokenizer: str, pieces: str = "dropped", end_id: int = 2, vocabulary: int = 1 << 16
) -> None:
    """Write ``docs`` (doc_id, text) below ``out``: shards in ``records/``, the index in ``index/``.

    Shards are in ascending doc_id order, within and among themselves (null first); rows
    that repeat an id stand together, ordered by text.  Null text counts as empty.  An empty
    table writes an empty index and no shard.  Other columns are ignored.  An id (or none) that many
    rows share is cut over shards by the beginnings of its texts.
    """
    dtype = "<u2" if vocabulary <= 1 << 16 else "<u4"
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The first characters of a text order as the text does, so a hot id is split without sampling whole texts.
    ordered = narrow.repartitionByRange("doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    index = arrow_map(ordered, _write(f"{out}/records", tokenizer, pieces, end_id, dtype), INDEX_SCHEMA, keeps=KEEPS)
    index.withColumn("bytes_per_id", F.lit(int(dtype[-1]))).write.parquet(f"{out}/index")


def read_index(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/index")


def _read(out, width):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _folder(out)
        for batch in batches:
            for shard in batch.column("shard").to_pylist():
                rows, size, start = [], 0, 0
                with fs.open_input_stream(f"{folder}/{_name(shard)}", buffer_size=1 << 20) as f:
                    while (payload := read_frame(f)) is not None:
                        doc_id, ids = _parse(payload)
                        n = len(ids) // width
                        rows.append((doc_id, shard, start, n, _wide(ids, width)))
                        start += n
                        size += 4 * n
                        if size > 4 << 20:
                            yield _rows(rows)
                            rows, size = [], 0
                if rows:
                    yield _rows(rows)

    return run


def _wide(ids: bytes, width: int) -> bytes:
    return np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes()


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
    names = ["doc_id", "shard", "local_start", "n_tokens", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def _width(index: DataFrame) -> int:
    row = index.select("bytes_per_id").head()
    return row[0] if row else 4


def read_records(spark: SparkSession, out: str) -> DataFrame:
    """Every record in file order, checksums verified: doc_id, start, n_tokens, ids (uint32 bytes).

    ``start`` counts the ids of all records before it.  Each shard is read by one task as a stream.
    """
    index = read_index(spark, out)
    # One row per shard: as many as write tasks, so one window over them is small.
    shards = index.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = shards.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    # An explicit number of partitions: adaptive execution would put these few rows into one task.
    files = shards.select("shard").repartitionByRange(max(1, shards.count()), "shard")
    records = arrow_map(files, _read(f"{out}/records", _width(index)), READ_SCHEMA)
    return records.join(F.broadcast(base), "shard").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids", "shard"
    )


def _seek(out, width):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _folder(out)
        for batch in slices(batches, "key", 1 << 16):
            rows = []
            wanted = sorted(zip(*(batch.column(c).to_pylist() for c in ("shard", "offset", "key")), strict=True))
            opened, f = None, None
            for shard, offset, key in wanted:
                if shard != opened:
                    if f is not None:
                        f.close()
                    f, opened = fs.open_input_file(f"{folder}/{_name(shard)}"), shard
                f.seek(offset)
                doc_id, ids = _parse(read_frame(f))
                rows.append((key, doc_id, _wide(ids, width)))
            if f is not None:
                f.close()
            rows.sort()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.binary()), strict=True)],
                ["key", "doc_id", "ids"],
            )

    return run


def read_shuffled(spark: SparkSession, out: str, seed: int) -> DataFrame:
    """Records in a seeded pseudo-random order, fetched through the offset index.

    Only index rows are shuffled; each task then seeks its own records.
    """
    index = read_index(spark, out)
    key = F.sha2(F.concat_ws("/", F.lit(seed), "shard", "offset"), 256)
    ordered = index.select("shard", "offset", key.alias("key")).repartitionByRange("key").sortWithinPartitions("key")
    return arrow_map(ordered, _seek(f"{out}/records", _width(index)), "key string, doc_id long, ids binary")
