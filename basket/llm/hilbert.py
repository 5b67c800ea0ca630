"""Sharding along a Hilbert curve over several metadata dimensions.

Method: each dimension is quantised to the same number of bits, the cell's index along the
Hilbert curve is computed by a small state machine (its tables follow from the curve's rule),
documents are sorted by curve index, and the sorted run is cut into shards of row counts at most one apart.
Neighbours on the curve are near in every dimension, so a file of a shard covers a small
box and min/max statistics prune it on any of them.  DataFrame expressions only.

Positions come from a range sort: a row's place in its partition plus the rows of the
partitions before it, so nothing is ranked in one task.  A hot cell is spread by the
tie-breakers (text checksum, doc_id) that follow the curve index in the sort key; copies
of a text with equal metadata stand side by side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basket.llm.common import cut

BITS = 8
_PLACE = (1 << 33) - 1  # the row number within its partition in monotonically_increasing_id()


def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """(next state, output digit) by state * 2**dims + input digit, from the curve's entry points and directions.

    A state is the entry corner and the direction of a sub-cube; digits have one bit
    per dimension.
    """
    n, size = dims, 1 << dims

    def rotate(x: int, by: int) -> int:  # to the left, n bits
        by %= n
        return ((x << by) | (x >> (n - by))) & (size - 1)

    def gray(i: int) -> int:
        return i ^ (i >> 1)

    def trailing_ones(i: int) -> int:
        return (~i & (i + 1)).bit_length() - 1

    rank = {gray(i): i for i in range(size)}
    following, digit = [], []
    for state in range(n * size):
        direction, entry = divmod(state, size)
        for given in range(size):
            w = rank[rotate(given ^ entry, n - direction - 1)]
            start = gray(2 * ((w - 1) // 2)) if w else 0
            turn = 0 if w == 0 else trailing_ones(w - 1 if w % 2 == 0 else w) % n
            new_entry = entry ^ rotate(start, direction + 1)
            following.append(((direction + turn + 1) % n) * size + new_entry)
            digit.append(w)
    return following, digit


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Curve index (long) of the cell with the given coordinates, each 0 to 2**bits - 1."""
    n = len(cells)
    following, digit = curve_tables(n)
    table = F.array(*[F.struct(F.lit(a).alias("s"), F.lit(b).alias("d")) for a, b in zip(following, digit, strict=True)])

    def level(b: Column) -> Column:
        out = F.lit(0)
        for j, cell in enumerate(cells):
            one = F.call_function("shiftright", cell.cast("int"), b).bitwiseAND(F.lit(1))
            out = out.bitwiseOR(F.shiftleft(one, j))
        return out

    def step(acc: Column, given: Column) -> Column:
        row = F.get(table, acc["s"] * (1 << n) + given)
        return F.struct(row["s"].alias("s"), F.shiftleft(acc["h"], n).bitwiseOR(row["d"].cast("long")).alias("h"))

    digits = F.transform(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), level)
    start = F.struct(F.lit(0).alias("s"), F.lit(0).cast("long").alias("h"))
    return F.aggregate(digits, start, step)["h"]


def quantised_name(column: str | Column, bits: int = BITS) -> Column:
    """A category's cell: a hash of its value, so equal values share a cell (null: 0)."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(1 << bits)), F.lit(0)).cast("int")


def quantised_size(column: str | Column, bits: int = BITS) -> Column:
    """A magnitude's cell: its logarithm in 2**bits steps up to 2**32 (null and less than 0: 0)."""
    c = F.col(column) if isinstance(column, str) else column
    cell = F.floor(F.log2(F.greatest(c, F.lit(0)).cast("double") + 1) * ((1 << bits) / 32))
    return F.coalesce(F.least(cell, F.lit((1 << bits) - 1)), F.lit(0)).cast("int")


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with size, text_crc32, lang_cell, source_cell, size_cell and the curve index."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumn("size", F.octet_length(text).cast("long") + 1).withColumn(
        "text_crc32", F.crc32(text.cast("binary"))
    )
    keyed = keyed.withColumns(
        {
            "lang_cell": quantised_name("lang"),
            "source_cell": quantised_name("source"),
            "size_cell": quantised_size("size"),
        }
    )
    return keyed.withColumn("curve", hilbert_index([F.col("lang_cell"), F.col("source_cell"), F.col("size_cell")]))


_KEY = ("curve", "text_crc32", "doc_id")


def assign(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, the cells, curve, shard and slot (place in the shard) of every row.

    Shards are runs of the curve of N / shards rows, rounded up or down.  Null texts have size 1 (no bytes,
    plus 1) and checksum 0; null lang or source take cell 0; null doc_ids sort first.  Repeated rows
    get a slot each.  An empty table gives no rows.  Other columns of ``docs`` are ignored.
    """
    narrow = _keyed(docs.select("doc_id", "text", "lang", "source")).drop("text", "lang", "source")
    # The texts are read once: the range sort samples and shuffles the checkpointed keys only.
    run = cut(narrow).repartitionByRange(*_KEY).sortWithinPartitions(*_KEY)
    placed = cut(run.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    # One row per partition of the sort: small, however many documents.
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(
        "_part",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_base"),
        F.sum("n").over(Window.partitionBy()).alias("_all"),
    )
    ranked = placed.withColumn("_part", part).join(F.broadcast(base), "_part")
    ranked = ranked.withColumn("_rank", F.col("_base") + F.col("_id").bitwiseAND(F.lit(_PLACE)))
    ranked = ranked.withColumn("shard", F.expr(f"CAST(_rank * {shards} DIV _all AS INT)"))
    ranked = ranked.withColumn("slot", F.expr(f"_rank - (shard * _all + {shards - 1}) DIV {shards}"))
    return ranked.drop("_part", "_base", "_all", "_id", "_rank")


def write_shards(docs: DataFrame, out: str, shards: int = 8) -> None:
    """Write ``docs`` as Parquet below ``out``, one ``shard=`` folder each, sorted along the curve.

    The shards' first keys come from ``assign`` (one row a shard reaches the driver); rows with
    one and the same key never part, so counts may differ by the repeats of a boundary row.
    """
    lowest = assign(docs, shards).groupBy("shard").agg(F.min(F.struct(*_KEY)).alias("first"))
    firsts = [r["first"] for r in lowest.orderBy("shard").collect()]
    keyed = _keyed(docs)
    key = F.struct(F.col("curve"), F.col("text_crc32"), F.col("doc_id"))
    shard = F.lit(-1)
    for first in firsts:
        at = F.struct(*[F.lit(first[c]).cast("long").alias(c) for c in _KEY])
        shard = shard + F.when(key >= at, 1).otherwise(0)
    ordered = keyed.withColumn("shard", F.greatest(shard, F.lit(0))).repartitionByRange("shard", *_KEY)
    ordered.sortWithinPartitions("shard", *_KEY).write.partitionBy("shard").parquet(out)


def manifest(written: DataFrame, columns: tuple[str, ...] = ("lang", "source", "size")) -> DataFrame:
    """Per file of a written output: rows, and the least and greatest value of each column."""
    stats = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return written.groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"), *stats)


def files_for(stats: DataFrame, **bounds: tuple) -> DataFrame:
    """The files that can hold rows with every ``column=(low, high)``."""
    for column, (low, high) in bounds.items():
        stats = stats.filter((F.col(f"max_{column}") >= low) & (F.col(f"min_{column}") <= high))
    return stats.select("file")
