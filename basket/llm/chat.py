r"""Chat formatting as a prefix tree of conversations.

Method: conversations that share their initial turns are merged.  Each distinct prefix of turns is one node of a tree;
its tokens (here: code points of the formatted turn) are emitted once, depth first.  A node carries its position ids
(where its tokens stand in each conversation through it), its place in the tree's depth-first sequence, its loss
spans, and the attention intervals of its ancestors: a token attends to those stretches of the sequence and, causally, to
its own node.

Template: a turn is ``### role: text</turn>\n``.  In roles and texts a backslash goes before every
backslash, ``###`` and ``</turn>``, and in roles before ``:`` too, so control strings inside texts never act and unescaping
gives the text back.  The loss mask covers the text of assistant turns.

Order without gathering a tree: distinct conversations are range-sorted by their array of prefix hashes and numbered
by partition and row.  A node is emitted by the least-numbered conversation through it, so a conversation emits
the suffix of turns that no earlier one has, and (conversation number, depth) is the depth-first preorder.  Sequence offsets are
running sums within a partition plus the sums of the tree's earlier partitions: a hot first turn
spreads over as many tasks as its conversations need.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basket.llm.common import arrow_map, cut

ASSISTANT = "assistant"
_END = "</turn>\n"
_BODY = r"((?:[^\\<]|\\.|<(?!/turn>))*)"
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): " + _BODY + r"</turn>\n", re.DOTALL)
_ESCAPE = re.compile(r"\\(\\|###|</turn>|:)")


def escaped(text: Column, role: bool = False) -> Column:
    out = F.regexp_replace(text, r"(\\|###|</turn>)", r"\\$1")
    return F.regexp_replace(out, ":", r"\\:") if role else out


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation; anything else raises ValueError."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def unescape(text: str) -> str:
    return _ESCAPE.sub(r"\1", text)


def _turns(rows: DataFrame) -> DataFrame:
    """One row per turn: ``conv_id, place`` (from 1), ``node`` (hash of the turns up to this one), ``formatted``,
    ``length``, ``position`` and ``head`` (where the loss span begins in the turn; null without loss).

    A prefix's hash is the sum of its turns' hashes (each of place, role and text), in four words modulo 2**32, so
    hashes and positions are running sums: time grows with the turns, and a window's rows spill to disk.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    role = F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role")
    inside = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    head = F.concat(F.lit("### "), escaped(F.col("role"), role=True), F.lit(": "))
    placed = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role, text).withColumn("place", F.row_number().over(inside))
    told = F.concat_ws(":", F.col("place").cast("string"), F.char_length("role").cast("string"), "role", "text")
    shaped = placed.select(
        "*",
        F.sha2(told, 256).alias("own"),
        F.concat(head, escaped(F.col("text")), F.lit(_END)).alias("formatted"),
        F.when(F.col("role") == ASSISTANT, F.char_length(head).cast("long")).alias("head"),
    ).withColumn("length", F.char_length("formatted").cast("long"))
    words = [F.conv(F.substring("own", 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    sums = [F.sum(w).over(so_far) for w in words]
    node = F.concat(*[F.lpad(F.hex(F.pmod(x, F.lit(1 << 32))), 8, "0") for x in sums])
    return shaped.select(
        "conv_id", "place", node.alias("node"), "formatted", "length", (F.sum("length").over(so_far) - F.col("length")).alias("position"), "head"
    )


def _paths(turns: DataFrame) -> DataFrame:
    """Per conversation: ``path`` (its nodes in order), ``lengths``, ``positions``, ``heads``; no texts."""
    turn = F.struct("place", "node", "length", "position", "head")
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    return grouped.select(
        "conv_id",
        F.try_element_at("t", F.lit(-1))["node"].alias("leaf"),
        F.col("t.node").alias("path"),
        F.col("t.length").alias("lengths"),
        F.col("t.position").alias("positions"),
        F.col("t.head").alias("heads"),
    )


class PrefixTrees:
    """The output: ``nodes`` (emitted once, in depth-first order) and ``members`` (conv_id, leaf node, path).

    ``nodes``: tree, node, parent, depth, formatted, length, position (of the first token, counted
    along the conversation), offset (in the tree's sequence), loss_start and loss_end (within the node; null
    where no loss), attends (list of [start, end) stretches of the sequence before the node itself).
    """

    def __init__(self, nodes: DataFrame, members: DataFrame):
        self.nodes, self.members = nodes, members

    def write(self, out: str) -> None:
        self.nodes.write.parquet(f"{out}/nodes")
        self.members.write.parquet(f"{out}/members")

    @staticmethod
    def read(spark, out: str) -> PrefixTrees:
        return PrefixTrees(spark.read.parquet(f"{out}/nodes"), spark.read.parquet(f"{out}/members"))


def build(rows: DataFrame) -> PrefixTrees:
    """The prefix trees of conversations given as rows (conv_id, turn, role, text).

    Null text and null role count as empty.  Rows of one turn number are ordered by role and text (null turn
    first), and repeated rows are turns of their own.  A null conv_id is a conversation like any other.
    An empty table gives empty trees.  Other columns are ignored.  Time and memory grow with the turns of a conversation,
    not their square; what is gathered of one is a hash and three numbers a turn, in one row.
    """
    turns = cut(_turns(rows))
    # from here on texts stay where they are; only hashes and lengths move
    slim = cut(_paths(turns))

    # distinct conversations, numbered in depth-first order
    distinct = slim.select("leaf", "path", "lengths", "positions", "heads").dropDuplicates(["leaf"])
    ordered = distinct.repartitionByRange("path").sortWithinPartitions("path")
    numbered = cut(ordered.withColumn("rank", F.monotonically_increasing_id()))

    # a node belongs to the least-numbered conversation through it
    prefixes = numbered.select("rank", F.explode("path").alias("node"))
    new = prefixes.groupBy("node").agg(F.min("rank").alias("rank")).groupBy("rank").agg(F.count("*").cast("int").alias("n_new"))
    sized = cut(
        numbered.join(new, "rank").select(
            F.shiftright("rank", 33).alias("part"),
            "rank",
            F.try_element_at("path", F.lit(1)).alias("tree"),
            "path",
            (F.size("path") - F.col("n_new")).alias("n_old"),
            "lengths",
            "positions",
            "heads",
            F.expr("positions[size(path) - 1] + lengths[size(path) - 1] - positions[size(path) - n_new]").alias("emits"),
        )
    )

    # where each conversation's own stretch begins in its tree's sequence
    inside = Window.partitionBy("part", "tree").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    local = sized.select("rank", "part", "tree", F.coalesce(F.sum("emits").over(inside), F.lit(0)).alias("local"))
    # a tree has one row for each partition that it reaches: few, however many conversations
    sums = sized.groupBy("part", "tree").agg(F.sum("emits").alias("emits"))
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("part", "tree", F.coalesce(F.sum("emits").over(earlier), F.lit(0)).alias("base"))
    starts = local.join(base, ["part", "tree"]).select("rank", (F.col("base") + F.col("local")).alias("begin"))

    each = F.posexplode(F.expr("slice(arrays_zip(path, lengths, positions, heads), n_old + 1, size(path))")).alias("i", "n")
    placed = cut(
        sized.join(starts, "rank")
        .select("tree", "rank", "path", "n_old", "begin", "positions", each)
        .select(
            "tree",
            "rank",
            "begin",
            F.col("n.path").alias("node"),
            F.expr("get(path, n_old + i - 1)").alias("parent"),
            (F.col("n_old") + F.col("i")).alias("depth"),
            F.col("n.lengths").alias("length"),
            F.col("n.positions").alias("position"),
            (F.col("begin") + F.col("n.positions") - F.expr("get(positions, n_old)")).alias("offset"),
            F.col("n.heads").alias("loss_start"),
            F.when(F.col("n.heads").isNotNull(), F.col("n.lengths") - len(_END)).alias("loss_end"),
        )
    )

    # ancestors that an earlier conversation emitted: one row for each shared prefix of each distinct conversation
    shared = sized.filter("n_old > 0").select("rank", F.explode(F.expr("slice(path, 1, n_old)")).alias("node"))
    stretch = F.struct(F.col("offset").alias("start"), (F.col("offset") + F.col("length")).alias("end"))
    before = shared.join(placed.select("node", stretch.alias("s")), "node")
    before = before.groupBy("rank").agg(_merged(F.sort_array(F.collect_list("s"))).alias("before"))
    # the conversation's own earlier nodes lie next to each other: one more stretch up to this node
    ahead = F.coalesce("before", F.array().cast("array<struct<start:bigint,end:bigint>>"))
    last = F.try_element_at(ahead, F.lit(-1))
    touches = F.coalesce(last["end"] == F.col("begin"), F.lit(False))
    own = F.array(F.struct(F.when(touches, last["start"]).otherwise(F.col("begin")).alias("start"), F.col("offset").alias("end")))
    kept = F.when(touches, F.slice(ahead, F.lit(1), F.greatest(F.size(ahead) - 1, F.lit(0)))).otherwise(ahead)
    raw = F.when(F.col("offset") > F.col("begin"), F.concat(kept, own)).otherwise(ahead)
    seen = placed.join(before, "rank", "left").withColumn("attends", raw)

    # each node's text once, combined before the shuffle
    texts = turns.groupBy("node").agg(F.first("formatted").alias("formatted"))
    nodes = seen.join(texts, "node").select(
        "tree", "node", "parent", "depth", "formatted", "length", "position", "offset", "loss_start", "loss_end", "attends"
    )
    return PrefixTrees(nodes, slim.select("conv_id", "leaf").join(numbered.select("leaf", "path"), "leaf"))


def _merged(stretches: Column) -> Column:
    """Sorted stretches with touching neighbours joined."""

    def first(s: Column, i: Column) -> Column:
        return (i == 0) | (s["start"] != F.get(stretches, i - 1)["end"])

    def final(s: Column, i: Column) -> Column:
        return (i == F.size(stretches) - 1) | (s["end"] != F.get(stretches, i + 1)["start"])

    starts = F.transform(F.filter(stretches, first), lambda s: s["start"])
    ends = F.transform(F.filter(stretches, final), lambda s: s["end"])
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), b.alias("end")))


def _read_back(trees: PrefixTrees) -> DataFrame:
    """Each distinct conversation from its nodes: ``leaf, formatted, loss_spans``."""
    distinct = trees.members.select("leaf", "path").dropDuplicates(["leaf"])
    parts = distinct.select("leaf", F.posexplode("path").alias("depth", "node")).join(
        trees.nodes.select("node", "formatted", "position", "loss_start", "loss_end"), "node"
    )
    span = F.when(
        F.col("loss_start").isNotNull(),
        F.struct((F.col("position") + F.col("loss_start")).alias("start"), (F.col("position") + F.col("loss_end")).alias("end")),
    )
    item = F.struct("depth", "formatted", span.alias("span"))
    whole = parts.groupBy("leaf").agg(F.sort_array(F.collect_list(item)).alias("p"))
    return whole.select(
        "leaf",
        F.array_join(F.transform("p", lambda x: x["formatted"]), "").alias("formatted"),
        F.filter(F.transform("p", lambda x: x["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def conversations(trees: PrefixTrees) -> DataFrame:
    """The conversations read back: ``conv_id, formatted, loss_spans`` (start and end in code points)."""
    return trees.members.select("conv_id", "leaf").join(_read_back(trees), "leaf").drop("leaf")


DIGEST = "leaf string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        columns = (batch.column(c).to_pylist() for c in ("leaf", "formatted", "loss_spans"))
        for leaf, formatted, spans in zip(*columns, strict=True):
            turns = parse(formatted)
            told = "".join(f"{role}\n{text}\n" for role, text in turns)
            loss = "".join(unescape(formatted[s["start"] : s["end"]]) for s in spans)
            sha = [hashlib.sha256(x.encode()).hexdigest() for x in (told, loss)]
            rows.append((leaf, len(turns), sha[0], len(loss), sha[1], len(formatted)))
        types = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ["leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def digests(trees: PrefixTrees) -> DataFrame:
    """Per conversation, from the formatted output alone: turns and loss text parsed back and hashed.

    Equal conversations are read back once; only the digests are joined to their ids.
    """
    found = cut(arrow_map(_read_back(trees), _digest, DIGEST))
    return trees.members.select("conv_id", "leaf").join(found, "leaf").drop("leaf")
