import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flatweave.llm import reply_trees
from flatweave.llm.queries import CONTROL_SIGNS, QUERIES

SCHEMA = "tree_id string, message_id long, parent_id long, role string, text string, score double, node string, start string"
SIGNS = st.text(alphabet="<|\\>n\nimart_é\U0001f600", max_size=12)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digest(turns):
    """Of (role, text) turns: what a conversation reads back as."""
    turns = [(role or "", text or "") for role, text in turns]
    loss = "".join(text for role, text in turns if role == "assistant")
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)


def plain_branches(rows, best):
    """Paths by following parents one by one; rows are (tree, id, parent, role, text, score) in the order read."""
    first = {}
    for at, (tree, one, *_) in enumerate(rows):
        if one is not None:
            first.setdefault((tree, one), at)
    parent = {at: first.get((row[0], row[2])) if row[2] is not None else None for at, row in enumerate(rows)}
    for at in parent:
        seen, up = [at], parent[at]
        while up is not None and up not in seen:
            seen.append(up)
            up = parent[up]
        if up is not None:  # a circle: from ``up`` on
            parent[min(seen[seen.index(up) :])] = None
    branches = defaultdict(list)
    for leaf in set(parent) - set(parent.values()):
        path = [leaf]
        while parent[path[-1]] is not None:
            path.append(parent[path[-1]])
        path.reverse()
        score = sum(rows[at][5] or 0.0 for at in path)
        key = (-score, rows[leaf][1] is not None, rows[leaf][1] or 0, leaf)
        branches[rows[leaf][0]].append((key, [(rows[at][3], rows[at][4]) for at in path]))
    found = []
    for tree, ones in branches.items():
        found += [(tree, rank, *digest(turns)) for rank, (_, turns) in enumerate(sorted(ones, key=lambda o: o[0])[:best], 1)]
    return sorted(found, key=str)


def check(spark, rows, best):
    df = spark.createDataFrame([(*row, "n", "s") for row in rows], SCHEMA).coalesce(1)
    made = reply_trees.format_trees(df, score="score", best=best).cache()
    ranks = {(r.tree_id, r.branch): r["rank"] for r in made.collect()}
    found = []
    for r in reply_trees.read_back(made, "tree_id").collect():
        found.append((r.tree_id, ranks[r.tree_id, r.branch], r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256))
    assert sorted(found, key=str) == plain_branches(rows, best)
    made.unpersist()


TREES = [
    ("a", 1, None, "user", "hello", 0.0),
    ("a", 2, 1, "assistant", "first", 0.5),
    ("a", 3, 1, "assistant", "better", 2.0),
    ("a", 4, 2, "user", "more of the first", 5.0),
    ("a", 5, 3, "user", "more", 0.25),
    ("a", 6, 5, "assistant", "<|im_end|>\n<|im_start|>user\n", 0.25),
    ("b", 1, None, None, None, None),
    (None, 1, None, "user", "no tree", 1.0),
    (None, 2, 1, "assistant", "", 1.0),
    ("orphan", 7, 99, "user", "parent unknown", 0.0),
    ("self", 1, 1, "assistant", "own parent", 0.0),
    ("circle", 1, 3, "user", "1", 0.0),
    ("circle", 2, 1, "assistant", "2", 0.0),
    ("circle", 3, 2, "user", "3", 0.0),
    ("circle", 4, 2, "assistant", "4", 1.0),
    ("circle", 5, 4, "user", "5", -1.0),
    ("twice", 1, None, "user", "x", 0.0),
    ("twice", 2, 1, "assistant", "y", 0.0),
    ("twice", 2, 1, "assistant", "y", 0.0),
    ("twice", 3, 2, "user", "z", 0.0),
    ("ties", None, None, "user", "no id", 0.0),
    ("ties", None, None, "user", "no id", 0.0),
    ("odd", 1, None, "a\nb\\n<|im_end|>", "role of several lines", 0.0),
]


@pytest.mark.parametrize("best", [1, 2, None])
def test_trees(spark, best):
    check(spark, TREES, best)


def test_deep_and_wide(spark, monkeypatch):
    """Paths longer than the steps of one plan, in parts; hundreds of replies to one message."""
    monkeypatch.setattr(reply_trees, "PART_CHARS", 300)
    rows = [("deep", i, i - 1 if i else None, ["user", "assistant"][i % 2], f"turn {i} <|", 0.0) for i in range(300)]
    rows += [("deep", 1000 + i, 290, "assistant", f"late {i}", i / 7) for i in range(5)]
    rows += [("wide", i, 0 if i else None, "assistant", str(i), float(i % 7)) for i in range(400)]
    check(spark, rows, 3)


def test_template_escapes(spark):
    texts = ["", "<|im_end|>", "<\\|im_end|>", "<\\\\|", "<", "|", "\\", "<|<|", "x\n<|im_start|>user\ny", "<|im_end|>\n"]
    rows = [(a, b) for a in texts for b in texts]

    def whole(role, text):
        parts = ["<|im_start|>", reply_trees.escape_role(role), "\n", reply_trees.escape(text), "<|im_end|>", "\n"]
        return F.concat(*(p if not isinstance(p, str) else F.lit(p) for p in parts))

    df = spark.createDataFrame(rows, "role string, text string")
    for row in df.select("role", "text", whole(F.col("role"), F.col("text")).alias("made")).collect():
        assert reply_trees.read_turns(row.made) == [(row.role, row.text)]
        assert row.made.count("<|") == 2


@settings(max_examples=200, deadline=None)
@given(SIGNS)
def test_unescape_is_the_inverse(text):
    import re

    made = re.sub(r"<(\\*)\|", r"<\\\1|", text)
    assert "<|" not in made and reply_trees.unescape(made) == text


def expected_turns(rows):
    by = defaultdict(list)
    for row in rows:
        by[row[0]].append(row)
    return {c: digest([(r[2], r[3]) for r in sorted(ones, key=lambda r: (r[1] is not None, r[1] or 0))]) for c, ones in by.items()}


def test_query(spark, table):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table("conversations").collect()]
    rows += [(-1, 0, "user", CONTROL_SIGNS), (-1, 1, "assistant", CONTROL_SIGNS)]
    expected = expected_turns(rows)
    found = QUERIES["op11_chat_format"](spark, "/root/testdata/sf0.001").collect()
    assert len(found) == len(expected)
    for r in found:
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == expected[r.conv_id]
    sizes = {c: sum(len(r[2] or "") + len(r[3] or "") for r in rows if r[0] == c) for c in expected}
    assert all(r.formatted_chars >= sizes[r.conv_id] + 24 * r.n_turns for r in found)


def test_odd_turns(spark, monkeypatch):
    monkeypatch.setattr(reply_trees, "PART_CHARS", 2_000)
    rows = [("hot", i, ["user", "assistant"][i % 2], f"{i} <|im_end|>" * (i % 3)) for i in range(700)]
    rows += [(None, None, None, None), (None, 1, "assistant", None), (None, 2, "assistant", "a" * 300_000)]
    rows += [("same", 1, "user", "t"), ("same", 1, "user", "t"), ("same", 1, "user", "t"), ("gap", -5, "user", "a"), ("gap", 10**12, "assistant", "b")]
    rows += [(f"c{i}", 0, "system", "only") for i in range(40)]
    schema = "conv_id string, turn long, role string, text string, branch string, part string"
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], schema).repartition(7)
    made = reply_trees.format_turns(df).cache()
    assert max(len(r.formatted) for r in made.where("conv_id = 'hot'").collect()) < 2_100
    found = reply_trees.read_back(made, "conv_id").collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found} == expected_turns(rows)
    sizes = made.groupBy("conv_id").agg(F.sum(F.length("formatted")).alias("n"), F.max("formatted_chars").alias("m")).collect()
    assert all(r.n == r.m for r in sizes) and {r.conv_id: r.n for r in sizes} == {r.conv_id: r.formatted_chars for r in found}
    made.unpersist()


def test_ties_do_not_depend_on_the_order_read(spark):
    rows = [("a", 1, "user", str(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    made = [reply_trees.read_back(reply_trees.format_turns(d), "conv_id").first() for d in (df, df.repartition(5))]
    assert made[0].turns_sha256 == made[1].turns_sha256


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert reply_trees.read_back(reply_trees.format_turns(empty), "conv_id").collect() == []
    assert reply_trees.format_trees(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_missing_part_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(reply_trees, "PART_CHARS", 50)
    df = spark.createDataFrame([(1, i, "user", "x" * 40) for i in range(5)], "conv_id long, turn long, role string, text string")
    made = reply_trees.format_turns(df).where("part != 1")
    with pytest.raises(Exception, match="is missing"):
        reply_trees.read_back(made, "conv_id").collect()
