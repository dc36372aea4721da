"""Chat formatting of reply trees: each chosen path from a root to a leaf becomes one conversation.

Self-joins with doubling steps follow every message's replies upwards: after round k a message knows the sums over
its nearest 2^k ancestors (how many, their scores, their formatted characters) and the ancestor beyond them, so
paths of any length take as many rounds as their length has binary digits, and a message knows where in its conversation it
begins.  Leaves are ranked by the score of their path; chosen ones are spread over their ancestors by the same steps in
falling order.  A conversation is kept in parts of bounded length, so no task or row holds one of any length.

The template marks turns as ``<|im_start|>role\\ntext<|im_end|>\\n``.  In texts and roles, a ``<`` that backslashes and a ``|`` follow gets
one more backslash, so that a marker never comes from a text, and reading takes it away again.  A role has its backslashes and line ends
escaped as well.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flatweave.llm.common import ROW, small_batches, staged, with_row_ids

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLES = ("assistant",)
PART_CHARS = 1 << 20
# Steps between two written tables while paths are spread.
STEPS_IN_A_PLAN = 4

_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL)
_SLOT = 1 << 33  # monotonically_increasing_id() counts a partition's rows from a multiple of this
_TREE, _SCORE, _ROLE, _TEXT, _LOSS = "__llm_tree", "__llm_score", "__llm_role", "__llm_text", "__llm_loss"


# ---- Template ---------------------------------------------------------------------


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda sign: "\n" if sign[1] == "n" else sign[1], unescape(role), flags=re.DOTALL)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a part; an error if it is not made of whole turns."""
    turns, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if turn is None:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape_role(turn[1]), unescape(turn[2])))
        at = turn.end()
    return turns


# ---- Links ------------------------------------------------------------------------


def _messages(df: DataFrame, tree: str, role: str, text: str, loss_roles, **others: Column) -> DataFrame:
    """Numbered rows, written once, with role and text in the template's form."""
    plain = F.coalesce(F.col(role).cast("string"), F.lit(""))
    chosen = df.select(
        F.col(tree).alias(_TREE),
        escape_role(plain).alias(_ROLE),
        escape(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias(_TEXT),
        plain.isin(*loss_roles).alias(_LOSS),
        *(column.alias(name) for name, column in others.items()),
    )
    return with_row_ids(chosen, "messages")


def _reply_links(messages: DataFrame) -> DataFrame:
    """(node, parent) of messages that name the one they reply to; of several rows with one id the first counts."""
    first = messages.where("id IS NOT NULL").groupBy(F.col(_TREE).alias("t"), F.col("id").alias("i")).agg(F.min(ROW).alias("parent"))
    found = messages.select(_TREE, ROW, "reply_to").join(
        first, F.col(_TREE).eqNullSafe(F.col("t")) & (F.col("reply_to") == F.col("i")), "left"
    )
    return found.select(F.col(ROW).alias("node"), "parent")


def _turn_links(messages: DataFrame) -> DataFrame:
    """(node, parent) of messages that each reply to the one before in their tree.

    All rows are sorted in ranges, which may cut a tree anywhere; the last row of one range is handed to the next.
    """
    order = [_TREE, "turn", "tie", ROW]
    narrow = messages.select(_TREE, "turn", F.xxhash64(_ROLE, _TEXT).alias("tie"), ROW)
    ranges = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges = staged(ranges.select(_TREE, ROW, F.monotonically_increasing_id().alias("at")), "turns")
    ranges = ranges.withColumn("slot", F.floor(F.col("at") / _SLOT))
    own = F.struct(F.col(_TREE).alias("tree"), F.col(ROW).alias("node"))
    # A row for each range, of which there are as many as shuffle partitions.
    ends = ranges.groupBy("slot").agg(F.max_by(own, "at").alias("last"))
    ends = ends.select("slot", F.lag("last").over(Window.orderBy("slot")).alias("ended"))
    before = F.lag(own).over(Window.partitionBy("slot").orderBy("at"))
    rows = ranges.withColumn("before", before).join(ends, "slot")
    rows = rows.withColumn("before", F.coalesce("before", "ended"))
    same = F.col("before").isNotNull() & F.col("before.tree").eqNullSafe(F.col(_TREE))
    return rows.select(F.col(ROW).alias("node"), F.when(same, F.col("before.node")).alias("parent"))


# ---- Paths ------------------------------------------------------------------------


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], list[DataFrame], DataFrame | None]:
    """Doubling over (node, jump, messages, score, chars, least), where jump is the parent.

    Gives the tables of messages that have reached their root, one for each round, the table of (node, jump) for steps of each power of two, and the messages
    that go round in a circle, if there are any.
    """
    sums = ["messages", "score", "chars"]
    closed, open_ = [nodes.where("jump IS NULL")], nodes.where("jump IS NOT NULL")
    steps, most = [], nodes.count()
    while open_.head(1):
        if 1 << len(steps) > most:
            return closed, steps, open_
        steps.append(open_.select("node", "jump"))
        known = open_
        for part in closed:
            known = known.unionByName(part)
        known = known.select(F.col("node").alias("jump"), F.col("jump").alias("next"), *(F.col(c).alias(f"{c}_2") for c in (*sums, "least")))
        joined = open_.join(known, "jump").select(
            "node",
            F.col("next").alias("jump"),
            *((F.col(c) + F.col(f"{c}_2")).alias(c) for c in sums),
            F.least("least", "least_2").alias("least"),
        )
        joined = staged(joined.withColumn("closed", F.col("jump").isNull()), "climb")
        closed.append(joined.where("closed").drop("closed"))
        open_ = joined.where("NOT closed").drop("closed")
    return closed, steps, None


def _all(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _paths(messages: DataFrame, links: DataFrame, score: Column, best: int | None) -> DataFrame:
    """(branch, node, tree, rank, turns, all_chars, start) for each message of each chosen path; a branch is named by its leaf's row."""
    length = F.length(F.concat(F.lit(START), _ROLE, F.lit("\n"), _TEXT, F.lit(END), F.lit("\n"))).cast("long")
    own = messages.select(F.col(ROW).alias("node"), _TREE, "order", score.alias("score"), length.alias("chars"))
    nodes = own.join(links, "node").select(
        "node",
        F.col("parent").alias("jump"),
        F.lit(1).cast("long").alias("messages"),
        "score",
        "chars",
        F.col("node").alias("least"),
    )
    nodes = staged(nodes, "nodes")
    closed, steps, circling = _climb(nodes)
    if circling is not None:
        # By now each jump has gone round: they are the messages of the circles, and each knows the least of its own.
        cut = circling.join(circling.select(F.col("jump").alias("node")).distinct(), "node").where("node = least")
        cut = cut.select("node", F.lit(True).alias("cut"))
        nodes = nodes.join(cut, "node", "left").withColumn("jump", F.when(F.col("cut").isNull(), F.col("jump"))).drop("cut")
        nodes = staged(nodes, "nodes")
        closed, steps, _ = _climb(nodes)
    places = _all(closed).select("node", "messages", F.col("score").alias("path_score"), F.col("chars").alias("end"))

    leaves = nodes.select("node").join(nodes.select(F.col("jump").alias("node")), "node", "left_anti")
    leaves = leaves.join(places, "node").join(own.select("node", _TREE, "order"), "node")
    ranked = Window.partitionBy(_TREE).orderBy(F.desc("path_score"), "order", "node")
    leaves = leaves.withColumn("rank", F.row_number().over(ranked))
    if best is not None:
        leaves = leaves.where(F.col("rank") <= best)
    leaves = staged(leaves, "branches")

    paths = leaves.select(F.col("node").alias("branch"), "node")
    for number, step in enumerate(reversed(steps)):
        both = F.when(F.col("jump").isNull(), F.array("node")).otherwise(F.array("node", "jump"))
        paths = paths.join(step, "node", "left").select("branch", F.explode(both).alias("node"))
        if number % STEPS_IN_A_PLAN == STEPS_IN_A_PLAN - 1:
            paths = staged(paths, "paths")
    of_branch = leaves.select(
        F.col("node").alias("branch"), _TREE, "rank", F.col("messages").alias("turns"), F.col("end").alias("all_chars")
    )
    placed = places.join(own.select("node", "chars"), "node").select("node", (F.col("end") - F.col("chars")).alias("start"))
    return paths.join(of_branch, "branch").join(placed, "node")


# ---- Conversations ----------------------------------------------------------------


def _formatted(messages: DataFrame, paths: DataFrame, tree: str) -> DataFrame:
    texts = messages.select(F.col(ROW).alias("node"), _ROLE, _TEXT, _LOSS)
    pieces = paths.join(texts, "node").withColumn("part", F.floor(F.col("start") / PART_CHARS))
    piece = F.struct("start", F.col(_ROLE).alias("role"), F.col(_TEXT).alias("text"), F.col(_LOSS).alias("loss"))
    parts = pieces.groupBy(_TREE, "branch", "rank", "turns", "all_chars", "part").agg(
        F.sort_array(F.collect_list(piece)).alias("pieces")
    )

    def turn(one: Column) -> Column:
        return F.concat(F.lit(START), one["role"], F.lit("\n"), one["text"], F.lit(END), F.lit("\n"))

    def span(one: Column) -> Column:
        head = one["start"] + F.length(F.concat(F.lit(START), one["role"], F.lit("\n")))
        return F.struct(head.alias("start"), F.length(one["text"]).cast("long").alias("length"))

    return parts.select(
        F.col(_TREE).alias(tree),
        "branch",
        "rank",
        "turns",
        F.col("all_chars").alias("formatted_chars"),
        "part",
        F.col("pieces")[0]["start"].alias("start"),
        F.array_join(F.transform("pieces", turn), "").alias("formatted"),
        F.transform(F.filter("pieces", lambda one: one["loss"]), span).alias("loss_spans"),
    )


def format_trees(
    df: DataFrame,
    tree: str = "tree_id",
    message: str = "message_id",
    parent: str = "parent_id",
    role: str = "role",
    text: str = "text",
    score: str | None = None,
    best: int | None = 1,
    loss_roles: tuple[str, ...] = LOSS_ROLES,
) -> DataFrame:
    """The ``best`` branches of each tree (None: all), by the sum of their messages' scores; of equal ones that with the smallest leaf id.

    Columns: ``tree``, branch long (any number), rank int, turns and formatted_chars long (of the whole branch), part long, start long
    (characters of the branch before the part), formatted string, loss_spans array of start and length (characters of the whole branch).
    Parts are cut between turns, and numbers of parts may be left out; put one after the other they are the conversation.

    A null score is 0, a null role or text empty, a null tree a tree of its own.  A message whose parent is null, unknown or
    itself is a root.  Messages that reply to each other in a circle are cut at the row read first.  Of several rows with one id
    the one read first has the replies; the others are leaves.  A null id has no replies.  An empty table gives no rows; other
    columns are ignored, whatever their names.
    """
    value = F.lit(0.0) if score is None else F.coalesce(F.col(score).cast("double"), F.lit(0.0))
    messages = _messages(
        df, tree, role, text, loss_roles, id=F.col(message), reply_to=F.col(parent), order=F.col(message), **{_SCORE: value}
    )
    return _formatted(messages, _paths(messages, _reply_links(messages), F.col(_SCORE), best), tree)


def format_turns(
    df: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    loss_roles: tuple[str, ...] = LOSS_ROLES,
) -> DataFrame:
    """:func:`format_trees` of conversations in which each row replies to the one before by turn.

    Null turns come first; rows of one turn follow each other in an order that depends on their role and text only, and
    repeated rows are turns of their own.
    """
    messages = _messages(df, conversation, role, text, loss_roles, turn=F.col(turn), order=F.col(turn))
    paths = _paths(messages, _turn_links(messages), F.lit(0.0), None)
    return _formatted(messages, paths, conversation)


def _digest(batches: Iterator[pa.RecordBatch], width: int = 1_000) -> Iterator[pa.RecordBatch]:
    """Reads the parts of one branch after the other, in order; holds one part."""
    names = ["tree", "branch", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    ready: list[tuple] = []
    now = tree = None
    kind = None

    def made() -> tuple:
        return tree, now, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

    def flush() -> pa.RecordBatch:
        columns = list(zip(*ready))
        ready.clear()
        types = [kind, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    for batch in batches:
        kind = batch.schema.field(0).type
        for row in batch.to_pylist():
            if row["branch"] != now:
                if now is not None:
                    ready.append(made())
                tree, now = row["tree"], row["branch"]
                n_turns = loss_chars = chars = 0
                turns, loss = hashlib.sha256(), hashlib.sha256()
            if row["start"] != chars:
                raise ValueError(f"a part of branch {now} is missing before character {row['start']}")
            for role, text in read_turns(row["formatted"]):
                n_turns += 1
                turns.update(f"{role}\n{text}\n".encode())
            for span in row["loss_spans"]:
                first = span["start"] - row["start"]
                text = unescape(row["formatted"][first : first + span["length"]])
                loss_chars += len(text)
                loss.update(text.encode())
            chars += len(row["formatted"])
        if len(ready) >= width:
            yield flush()
    if now is not None:
        ready.append(made())
        yield flush()


def read_back(formatted: DataFrame, tree: str) -> DataFrame:
    """What the conversations say: a row for each branch with digests of its turns, and of the text under its loss mask.

    A conversation of one part is read where it lies.  The parts of longer ones are brought together and read one after the other:
    a digest takes its text in order.
    """
    small_batches(formatted.sparkSession)
    kind = formatted.schema[tree].dataType.simpleString()
    schema = (
        f"tree {kind}, branch long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    parts = formatted.select(F.col(tree).alias("tree"), "branch", "part", "start", "formatted", "loss_spans", "formatted_chars")
    whole = (F.col("part") == 0) & (F.length("formatted") == F.col("formatted_chars"))
    alone = parts.where(whole).drop("formatted_chars").mapInArrow(_digest, schema)
    several = parts.where(~whole).drop("formatted_chars").repartition("branch").sortWithinPartitions("branch", "part")
    return alone.unionByName(several.mapInArrow(_digest, schema)).withColumnRenamed("tree", tree)
