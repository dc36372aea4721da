import re
from collections import Counter, defaultdict

import numpy as np
import odd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import compare, connect

from flatweave.llm import divergence
from flatweave.llm.queries import ORACLES, QUERIES

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_rows(docs, least=10, best=10):
    """Term by term, source by source, in Python integers."""
    counts, seen = defaultdict(Counter), defaultdict(Counter)
    groups = set()
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = plain_terms(text)
        counts[lang, source].update(terms)
        seen[lang].update(set(terms))
    rows = []
    for lang in {lang for lang, _ in groups}:
        kept = [t for t, n in seen[lang].items() if n >= least]
        sources = [s for one, s in groups if one == lang]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        own = {s: shares(counts[lang, s]) for s in sources}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        for s in sources:
            pairs = [(-sum(f(own[s][t], own[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(-f(own[s][t], whole[t]), t.encode(), t) for t in kept if counts[lang, s][t] and own[s][t] > whole[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:best])):
                rows += [(lang, s, part, item, -value, rank) for rank, (value, _, item) in enumerate(found, 1)]
    return sorted(rows)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aZ[`{@ \n\x00\x7f\x80é")), max_size=60))
def test_terms(text):
    assert [t.decode() for t in divergence.terms_of(text.encode())] == plain_terms(text)


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 40).flatmap(lambda n: st.tuples(*[st.lists(st.integers(1, 4), min_size=n, max_size=n)] * 2)))
def test_runs_and_boundaries(columns):
    size = len(columns[0])
    coded = []
    for column in columns:
        places = np.flatnonzero(column)
        starts, counts = divergence.runs(places, np.array(column)[places], size)
        assert np.repeat(counts, np.diff(starts, append=size)).tolist() == column
        coded.append((starts, counts * 1000))
    expected = sum((1000 * (a - b)) ** 2 // (1000 * (a + b)) for a, b in zip(*columns))
    assert divergence.divergence(*coded, size) == expected


def test_shares_of_large_counts(spark):
    counts = [0, 5, 2**33, 2**62]
    df = spark.createDataFrame([(c, 2**62 + 7, 3) for c in counts], "c long, t long, v long")
    found = [r[0] for r in df.select(divergence.scaled_share(df.c, df.t, df.v)).collect()]
    assert found == [1 + 10**9 * (c + 2) // (2**62 + 13) for c in counts]
    assert divergence._shares(np.array(counts), 2**62 + 7, 3).tolist() == found


def test_query(spark):
    duck = connect("/root/testdata/sf0.001")
    expected, actual, missing, extra = compare(
        duck, QUERIES["op12_source_divergence"](spark, "/root/testdata/sf0.001"), ORACLES["op12_source_divergence"]
    )
    assert expected == actual and not missing and not extra and actual > 0


@pytest.mark.parametrize("least", [1, 2, 50])
def test_odd_rows(spark, least):
    df = odd.documents(spark)
    docs = [(r.text, r.lang, r.source) for r in df.collect()]
    found = sorted(map(tuple, divergence.source_divergence(df, least_docs=least).collect()))
    assert found == plain_rows(docs, least)


def test_empty_table(spark):
    found = divergence.source_divergence(odd.no_documents(spark))
    assert found.collect() == [] and found.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_partial_counts_are_handed_on(monkeypatch):
    monkeypatch.setattr(divergence, "HELD_BYTES", 6)
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 4), pa.array(["a", "b", "a", "a"]), pa.array(["x yy x", "x", "", "Yy zzzz"])], ["l", "s", "t"])
    found = list(divergence._partial_counts(iter([batch, batch.slice(0, 0), batch])))
    assert len(found) > 2
    sums = Counter()
    for part in found:
        for row in part.to_pylist():
            sums[row["source"], row["term"]] += row["count"] + 1000 * row["docs"]
    assert sums == {("a", "x"): 2004, ("a", "yy"): 4004, ("a", "zzzz"): 2002, ("b", "x"): 2002}


def test_many_sources_and_blocks(spark, monkeypatch):
    """Several tiles and blocks; one source with a third of all rows, ties of pairs and terms."""
    monkeypatch.setattr(divergence, "TILE_SOURCES", 3)
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 4)
    rng = np.random.default_rng(5)
    docs = []
    for i in range(240):
        source = "hot" if i % 3 == 0 else f"s{i % 11}"
        words = [f"w{chr(97 + int(k))}" for k in rng.zipf(1.5, 12) % 26] + ["Always", "ÉTÉ"]
        docs.append((" ".join(words), ["en", None][i % 2], source))
    docs += [("", "en", "bare"), (None, "xx", "a"), ("rare", "xx", "b"), ("alone", "yy", None)]
    df = spark.createDataFrame(docs, "text string, lang string, source string").repartition(7)
    found = sorted(map(tuple, divergence.source_divergence(df).collect()))
    assert found == plain_rows(docs)
