"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

A source's documents all get the same expected number of copies, target / size of the source.  Its whole part is
given outright; the fraction is rounded dependently: two documents with fractional probabilities pass mass
(probability times words) from one to the other until one is integral.  The direction is random
with the chances that keep both expectations, and no words appear or vanish.  Blocks of documents are folded this
way, each leaves at most one fractional document, and those go on to the next level of a
tree, until a source has one left, which is rounded by itself.  Documents that are long for
their source are rounded first, and the others share what those leave of the target, so that a source misses its target
by less than one of the shorter documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flatweave.llm.common import ROW, WORD, staged, uniform

WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3.0
BLOCK = 64
SEED = 20240229
# Documents above these shares of their source's words are rounded before the shorter ones.
LARGE_SHARES = (1 / 20, 1 / 100, 1 / 500)
_NEAR = 1e-9

_SIZE, _SOURCE, _KEY, _TARGET, _COPIES = "__llm_size", "__llm_source", "__llm_key", "__llm_target", "__llm_copies"


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """Adds ``target`` to (source, source_size): the shares of all words by weight, none above ``most`` times its size.

    Weights repeat over the sources in code point order, null last.  The excess of capped sources is
    shared by weight among the others until none is above.  One row a source.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(ordered) - 1) % len(weights)
    weighted = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))
    weighted = weighted.withColumn("cap", F.col("source_size") * F.lit(most))
    # With the sources in the order in which they reach their caps, one is capped if the level
    # that the caps before it leave to it and its successors is above its cap.
    filling = Window.orderBy((F.col("cap") / F.col("w")), F.col("source").asc_nulls_last())
    earlier, whole = filling.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))) / (
        F.sum("w").over(whole) - F.coalesce(F.sum("w").over(earlier), F.lit(0.0))
    )
    levels = weighted.withColumn("level", level).withColumn("free", F.col("level") * F.col("w") <= F.col("cap"))
    settled = F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("w"), F.col("level").alias("level")))).over(whole)
    target = F.when(F.col("free"), F.col("w") * settled["level"]).otherwise(F.col("cap"))
    return levels.select("source", "source_size", F.least(target, "cap").alias("target"))


def _fold() -> str:
    """SQL that folds ``items`` (row, size, p, key) of a block.

    Gives the decided ones and what is left (row null: nothing).  ``a`` is the document left so far, ``x`` the
    next.  Mass ``up`` may pass from x to a, ``down`` from a to x.
    """
    wa, wx = "greatest(CAST(a.size AS DOUBLE), 1e-6D)", "greatest(CAST(x.size AS DOUBLE), 1e-6D)"
    lift_a, drain_x = f"(1D - a.p) * {wa}", f"x.p * {wx}"
    drain_a, lift_x = f"a.p * {wa}", f"(1D - x.p) * {wx}"
    up, down = f"least({lift_a}, {drain_x})", f"least({drain_a}, {lift_x})"
    draw = f"shiftrightunsigned(xxhash64({SEED}L, a.key, x.key, a.p), 11) * {2.0**-53!r}D"
    to_a = f"({draw}) * ({up} + {down}) < {down}"

    def left(one: str, p: str) -> str:
        return f"named_struct('row', {one}.row, 'size', {one}.size, 'p', {p}, 'key', {one}.key"

    def decided(one: str, taken: str) -> str:
        return f"'done', concat(a.done, array(named_struct('row', {one}.row, 'up', {taken}))))"

    # Cases by direction and by which of the two becomes integral.
    return f"""aggregate(items,
      named_struct('row', CAST(NULL AS BIGINT), 'size', 0L, 'p', 0D, 'key', 0L,
                   'done', CAST(array() AS ARRAY<STRUCT<row: BIGINT, up: BOOLEAN>>)),
      (a, x) -> CASE
        WHEN a.row IS NULL THEN {left("x", "x.p")}, 'done', a.done)
        WHEN {to_a} THEN CASE
          WHEN {lift_a} <= {drain_x} THEN {left("x", f"x.p - ({lift_a}) / {wx}")}, {decided("a", "true")}
          ELSE {left("a", f"a.p + ({drain_x}) / {wa}")}, {decided("x", "false")} END
        ELSE CASE
          WHEN {drain_a} <= {lift_x} THEN {left("x", f"x.p + ({drain_a}) / {wx}")}, {decided("a", "false")}
          ELSE {left("a", f"a.p - ({lift_x}) / {wa}")}, {decided("x", "true")} END
      END)"""


def dependent_rounding(items: DataFrame, block: int = BLOCK) -> DataFrame:
    """(row, up) for items (grp, row, size, p, key): which probabilities become one, which zero.

    ``key`` decides blocks and draws, so equal input gives equal results.  A group of any size is
    cut into blocks of about ``block`` items, level by level.
    """
    counts = items.groupBy("grp").agg(F.count("*").alias("n"))
    counts = staged(counts, "mix-counts")
    largest = counts.agg(F.max("n")).first()[0] or 0
    decided, level, blocks = [], 0, largest
    while True:
        blocks = -(-blocks // block)
        number = F.pmod(F.xxhash64("key", F.lit(level)), F.ceil(F.col("n") / F.lit(float(block) ** (level + 1))))
        dealt = items.join(counts.withColumnRenamed("grp", "g"), F.col("grp").eqNullSafe(F.col("g"))).withColumn(
            "block", number
        )
        # Long documents first: they are settled against the many shorter ones, so what is left is short.
        order = F.sort_array(F.collect_list(F.struct("size", "key", "row", "p")), asc=False)
        folded = dealt.groupBy("grp", "block").agg(order.alias("items")).select("grp", F.expr(_fold()).alias("out"))
        folded = staged(folded, "mix-level")
        decided.append(folded.select(F.explode("out.done").alias("d")).select("d.row", "d.up"))
        rest = folded.where("out.row IS NOT NULL")
        items = rest.select("grp", *(F.col(f"out.{name}").alias(name) for name in ("row", "size", "p", "key")))
        level += 1
        if blocks <= 1:
            break
    last = items.select("row", (uniform(F.lit(SEED), "key", F.lit(level)) < F.col("p")).alias("up"))
    for one in decided:
        last = last.unionByName(one)
    return last


def _with_copies(rows: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """Adds the target and copies to rows (ROW, size, source, key)."""
    sizes = rows.groupBy(F.col(_SOURCE).alias("source")).agg(F.sum(_SIZE).alias("source_size"))
    targets = staged(source_targets(sizes, weights, most), "mix-targets")
    above = [(F.col(_SIZE) > F.col("source_size") * F.lit(share)).cast("int") for share in LARGE_SHARES]
    rated = rows.join(targets.withColumnRenamed("source", "s"), F.col(_SOURCE).eqNullSafe(F.col("s")), "left").drop("s")
    rated = rated.withColumn("tier", sum(above[1:], above[0]))

    def rounded(some: DataFrame, goal: str, words: str) -> DataFrame:
        """Copies of documents that are to take ``goal`` of their ``words`` words in all, a source at a time."""
        rate = F.when(F.col(words) > 0, F.greatest(F.lit(0.0), F.least(F.col(goal) / F.col(words), F.lit(most))))
        some = some.withColumn("rate", F.coalesce(rate, F.lit(0.0)))
        some = some.withColumn("whole", F.floor(F.col("rate") + F.lit(_NEAR)))
        some = some.withColumn("p", F.col("rate") - F.col("whole"))
        items = some.where(F.col("p") > _NEAR).select(
            F.col(_SOURCE).alias("grp"), F.col(ROW).alias("row"), F.col(_SIZE).alias("size"), "p", F.col(_KEY).alias("key")
        )
        raised = dependent_rounding(items).where("up").select(F.col("row").alias(ROW), F.lit(1).alias("up"))
        copies = (F.col("whole") + F.coalesce(F.col("up"), F.lit(0))).cast("int")
        return some.join(raised, ROW, "left").withColumn(_COPIES, copies).drop("rate", "whole", "p", "up")

    # What is left to take, and from how many words, once the longer documents are settled.
    left = targets.select(F.col("source").alias("s"), F.col("target").alias("goal"), F.col("source_size").alias("words"))
    made = None
    tiers = sorted((row["tier"] for row in rated.select("tier").distinct().collect()), reverse=True)
    for tier in tiers or [0]:  # as many as LARGE_SHARES has, and one
        some = rated.where(F.col("tier") == tier).join(left, F.col(_SOURCE).eqNullSafe(F.col("s")), "left").drop("s")
        some = rounded(some, "goal", "words").drop("goal", "words", "tier")
        if tier:
            some = staged(some, "mix-tier")
            spent = some.groupBy(F.col(_SOURCE).alias("t")).agg(
                F.sum(_SIZE).alias("gone"), F.sum(F.col(_SIZE) * F.col(_COPIES)).alias("spent")
            )
            left = left.join(spent, F.col("s").eqNullSafe(F.col("t")), "left").select(
                "s",
                (F.col("goal") - F.coalesce("spent", F.lit(0))).alias("goal"),
                (F.col("words") - F.coalesce("gone", F.lit(0))).alias("words"),
            )
            left = staged(left, "mix-left")
        made = some if made is None else made.unionByName(some)
    return made


def _measured(docs: DataFrame, id_column: str, source: str, text: str) -> DataFrame:
    """Rows without an id are told apart by their row number."""
    own = F.when(F.col(id_column).isNull(), F.col(ROW))
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    numbered = docs.withColumns(
        {ROW: F.monotonically_increasing_id(), _SIZE: size, _SOURCE: F.col(source)}
    )
    return numbered.withColumn(_KEY, F.xxhash64(F.lit(SEED), id_column, F.xxhash64(text), own))


def mix_plan(
    docs: DataFrame,
    id_column: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[float, ...] = WEIGHTS,
    most: float = MOST_COPIES,
) -> DataFrame:
    """How often each document enters the mix.

    (id, size, source_size, target, copies, taken): size counts words (null: 0), taken is copies times size.
    Rows that are equal in id and text are drawn by themselves.  An empty table or one without words
    takes nothing.
    """
    narrow = _measured(docs.select(id_column, source, text), id_column, source, text)
    narrow = staged(narrow.select(ROW, _SIZE, _SOURCE, _KEY, id_column), "mix-rows")
    made = _with_copies(narrow, weights, most)
    return made.select(
        id_column,
        F.col(_SIZE).alias("size"),
        "source_size",
        "target",
        F.col(_COPIES).alias("copies"),
        (F.col(_COPIES) * F.col(_SIZE)).alias("taken"),
    )


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[float, ...] = WEIGHTS,
    most: float = MOST_COPIES,
) -> DataFrame:
    """The documents of the mix, each as often as it was drawn, with the columns they came with."""
    rows = staged(_measured(docs, id_column, source, text), "mix-docs")
    plan = _with_copies(rows.select(ROW, _SIZE, _SOURCE, _KEY), weights, most)
    plan = plan.where(F.col(_COPIES) > 0).select(ROW, _COPIES)
    taken = rows.join(plan, ROW).withColumn("__llm_copy", F.explode(F.sequence(F.lit(1), F.col(_COPIES))))
    return taken.select(*docs.columns)
