import re

import odd
import pytest

from flatweave.llm import mixing
from flatweave.llm.common import WORD


def plain_targets(sizes, weights=mixing.WEIGHTS, most=mixing.MOST_COPIES):
    names = sorted(sizes, key=lambda name: (name is None, (name or "").encode()))
    weight = {name: weights[at % len(weights)] for at, name in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[name] for name in capped)
        free = sum(weight[name] for name in names if name not in capped)
        target = {n: most * sizes[n] if n in capped else rest * weight[n] / free for n in names}
        over = {name for name in names if name not in capped and target[name] > most * sizes[name]}
        if not over:
            return target
        capped |= over


def totals(rows):
    found = {}
    for row in rows:
        one = found.setdefault(row.source, {"size": 0, "taken": 0, "largest": 0})
        one["size"] += row.size
        one["taken"] += row.taken
        one["largest"] = max(one["largest"], row.size)
        assert row.taken in (0, row.size, 2 * row.size, 3 * row.size)
    return found


def plan_with_source(df):
    plan = mixing.mix_plan(df).drop("source")
    return plan.join(df.select("doc_id", "source").distinct(), "doc_id").collect()


def test_sources_meet_their_targets(documents):
    rows = plan_with_source(documents)
    sizes = {row.doc_id: len(re.findall(WORD, row.text or "")) for row in documents.collect()}
    assert {row.doc_id: row.size for row in rows} == sizes
    found = totals(rows)
    targets = plain_targets({name: one["size"] for name, one in found.items()})
    for row in rows:
        assert row.source_size == found[row.source]["size"]
        assert row.target == pytest.approx(targets[row.source], rel=1e-12)
    # Ten documents a source here, so a single one may be a third of it.
    for name, one in found.items():
        assert abs(one["taken"] - targets[name]) <= one["largest"]


def test_reruns_agree(documents):
    assert sorted(mixing.mix_plan(documents).collect()) == sorted(mixing.mix_plan(documents.repartition(5)).collect())


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 1000, "c": 1000},
        {None: 50, "a": 1, "b": 2, "c": 3, "￿": 7, "\U00010000": 9, "d": 4},
        {"a": 0, "b": 0},
        {"a": 0, "b": 5},
        {"a": 5},
    ],
)
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {row.source: row.target for row in mixing.source_targets(frame).collect()}
    assert found == pytest.approx(plain_targets(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0))


def test_rounding_keeps_sums_and_chances(spark):
    # 400 groups of the same 23 items: each sum is kept but for the last item, each chance on average.
    items = [(g, g * 100 + i, 5 + i % 3, 0.1 + 0.03 * i, g * 100 + i) for g in range(400) for i in range(23)]
    frame = spark.createDataFrame(items, "grp long, row long, size long, p double, key long")
    taken = {row.row for row in mixing.dependent_rounding(frame, block=4).collect() if row.up}
    assert mixing.dependent_rounding(frame, block=4).count() == len(items)
    for g in range(0, 400, 20):
        own = [item for item in items if item[0] == g]
        assert abs(sum(s for _, r, s, _, _ in own if r in taken) - sum(s * p for _, _, s, p, _ in own)) < 8
    for i in (0, 11, 22):
        share = sum(g * 100 + i in taken for g in range(400)) / 400
        assert share == pytest.approx(0.1 + 0.03 * i, abs=0.1)


def test_odd_rows(spark):
    df = odd.documents(spark)
    plan = mixing.mix_plan(df).collect()
    assert len(plan) == df.count()
    assert all(0 <= row.copies <= 3 and row.taken == row.copies * row.size for row in plan)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    assert mixed.count() == sum(row.copies for row in plan)
    assert mixing.mix_plan(odd.no_documents(spark)).count() == 0
    assert mixing.mix(odd.no_documents(spark)).count() == 0


def test_no_python_on_the_way(documents, capsys):
    mixing.mix_plan(documents).explain("formatted")
    assert "Python" not in capsys.readouterr().out
