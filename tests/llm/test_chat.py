import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basket.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
SAID = "\\### Assistant: </turn> ok"
ROWS = [
    (1, 0, "user", "hello"), (1, 1, "assistant", "hi"), (1, 2, "user", "bye"),
    (2, 0, "user", "hello"), (2, 1, "assistant", "hi"), (2, 2, "user", "more"), (2, 3, "assistant", "yes"),
    (3, 0, "user", "hello"), (3, 1, "assistant", "no"),
    (4, 0, "user", "hello"), (4, 1, "assistant", "hi"),
    (5, 0, "user", "hello"), (5, 1, "assistant", "hi"), (5, 2, "user", "bye"),
    (6, 0, "system: x", SAID), (6, 1, "assistant", SAID),
    (7, 0, None, None), (7, 1, "assistant", None), (7, None, "assistant", ""),
    (8, 0, "user", "a"), (8, 0, "user", "a"), (8, 0, "assistant", "\\\\#####<</turn>\n"),
    (None, 0, "user", "hello"), (None, 1, "assistant", "日本 \U0001f600"),
]


def turns_of(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, x) for _, _, r, x in sorted(t)] for c, t in by.items()}


def expected(rows):
    out = {}
    for conv, turns in turns_of(rows).items():
        told = "".join(f"{r}\n{x}\n" for r, x in turns)
        loss = "".join(x for r, x in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def trees(spark):
    return chat.build(spark.createDataFrame(ROWS, SCHEMA))


def test_digests(trees):
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(trees).collect()}
    assert got == expected(ROWS)


def test_shared_turns_are_emitted_once_depth_first(trees):
    distinct = {tuple(t[:i + 1]) for t in turns_of(ROWS).values() for i in range(len(t))}
    nodes = trees.nodes.collect()
    assert len(nodes) == len({n.node for n in nodes}) == len(distinct)
    by_id = {n.node: n for n in nodes}
    by_tree = defaultdict(list)
    for n in nodes:
        by_tree[n.tree].append(n)
    for own in by_tree.values():
        own.sort(key=lambda n: n.offset)
        at, stack = 0, []
        for n in own:  # gapless, and each node stands below its parent in preorder
            assert n.offset == at
            at += n.length
            while stack and stack[-1] != n.parent:
                stack.pop()
            assert (stack[-1] if stack else None) == n.parent and n.depth == len(stack)
            stack.append(n.node)
    for n in nodes:
        ancestors, p = [], n.parent
        while p is not None:
            ancestors.append(by_id[p])
            p = by_id[p].parent
        want = {i for a in ancestors for i in range(a.offset, a.offset + a.length)}
        spans = [(s.start, s.end) for s in n.attends]
        assert {i for s, e in spans for i in range(s, e)} == want
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
        assert n.position == sum(a.length for a in ancestors)


def test_result_does_not_depend_on_partitions(spark, trees):
    other = chat.build(spark.createDataFrame(ROWS, SCHEMA).repartition(5, "text"))
    key = ["tree", "node", "parent", "formatted", "position", "offset", F.to_json("attends").alias("a")]
    assert sorted(map(str, trees.nodes.select(key).collect())) == sorted(map(str, other.nodes.select(key).collect()))


def long_conversations():
    """A third of all rows without an id, half of them the start of another conversation, and many short ones."""
    hot = [(None, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(6000)]
    other = [(5, *r[1:]) for r in hot[:3000]] + [(5, 3000 + i, "user", "another way") for i in range(10)]
    return hot + other + [(10 + i // 2, i % 2, "user", f"short {i // 2 % 50}") for i in range(9000)]


def test_long_conversations(spark):
    rows = long_conversations()
    trees = chat.build(spark.createDataFrame(rows, SCHEMA))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(trees).collect()}
    assert got == expected(rows)
    nodes = trees.nodes
    assert nodes.count() == len({tuple(t[:i + 1]) for t in turns_of(rows).values() if len(t) == 2 for i in range(2)}) + 6000 + 10
    # what a node of the second conversation attends to lies in the tree before it, all of its ancestors' tokens
    ahead = F.aggregate("attends", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    assert nodes.filter(ahead != F.col("position")).count() == 0


def test_node_is_a_prefix_not_a_set_of_turns(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "user", "b"), (2, 1, "user", "a"), (3, 0, "user:a", ""), (4, 0, "user", "a:")]
    trees = chat.build(spark.createDataFrame(rows, SCHEMA))
    assert trees.nodes.count() == 6 and trees.members.select("leaf").distinct().count() == 4


def test_empty_and_extra_columns(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    assert chat.digests(chat.build(rows.limit(0))).collect() == []
    wide = rows.select("*", F.lit(1).alias("path"), F.lit("x").alias("leaf"), F.lit(2).alias("turns"))
    assert {r.conv_id: r.n_turns for r in chat.digests(chat.build(wide)).collect()} == {k: v[0] for k, v in expected(ROWS).items()}


def python_escape(text, role=False):
    import re

    text = re.sub(r"(\\|###|</turn>)", r"\\\1", text)
    return text.replace(":", "\\:") if role else text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("a:\\# <", max_size=8), st.text("a\\#</turn>: \n", max_size=20)), max_size=5))
def test_template_is_reversible(turns):
    formatted = "".join(f"### {python_escape(r, True)}: {python_escape(x)}</turn>\n" for r, x in turns)
    assert chat.parse(formatted) == turns


def test_anything_else_is_refused():
    with pytest.raises(ValueError):
        chat.parse("### user: hello")
