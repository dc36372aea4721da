import numpy as np
import odd
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from flatweave.llm import simhash
from flatweave.llm.components import connected_components


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
        {n: " " for n in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=4):
    """Index of the first print that each can reach."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aBÉ ß\n\t\x1cz漢", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def expected(rows):
    prints = [plain_fingerprint(text) for _, text in rows]
    roots = plain_components(prints)
    least = {}
    for (doc_id, _), root in zip(rows, roots):
        if doc_id is not None:
            least[root] = min(least.get(root, doc_id), doc_id)
    return [(doc_id, f"{p:016x}", least.get(root)) for (doc_id, _), p, root in zip(rows, prints, roots)]


def key(row):
    return tuple((value is None, value) for value in row)


@pytest.mark.parametrize("source", ["documents", "odd"])
def test_near_duplicates(spark, documents, source):
    df = documents if source == "documents" else odd.documents(spark)
    found = simhash.near_duplicates(df).select("doc_id", "fingerprint", "component_id").collect()
    rows = [(row.doc_id, row.text) for row in df.select("doc_id", "text").collect()]
    assert sorted(map(tuple, found), key=key) == sorted(expected(rows), key=key)


def test_empty(spark):
    assert simhash.near_duplicates(odd.no_documents(spark)).count() == 0
    assert simhash.keep_one(odd.no_documents(spark)).count() == 0


def test_keep_one_keeps_each_component_once(spark):
    df = odd.documents(spark)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    groups = {}
    for doc_id, _, component in expected([(row.doc_id, row.text) for row in df.collect()]):
        groups.setdefault(component, []).append(doc_id)
    assert sorted(row.doc_id for row in kept.collect()) == sorted(groups)


@pytest.mark.parametrize("shard_rows", [7, 20_000])
def test_links_are_exact_whatever_the_shard_size(spark, shard_rows):
    random = np.random.default_rng(5)
    centres = random.integers(0, 1 << 64, 6, np.uint64)
    prints = set()
    for centre in centres:
        for _ in range(120):
            flips = random.choice(64, random.integers(0, 9), replace=False)
            prints.add(int(centre) ^ sum(1 << int(bit) for bit in flips))
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = simhash.fingerprint_links(frame, shard_rows=shard_rows)
    found = {row.node: row.component for row in connected_components(links).collect()}
    same = {}
    for p, root in zip(signed, plain_components(prints)):
        same.setdefault(root, set()).add(found.get(p, p))
    assert all(len(names) == 1 for names in same.values())
    assert len({next(iter(names)) for names in same.values()}) == len(same)


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(7, 7)]
    frame = spark.createDataFrame(links, "a long, b long")
    found = {row.node: row.component for row in connected_components(frame).collect()}
    assert {found[i] for i in range(301)} == {0}
    assert {found[1000 + i] for i in range(400)} == {1000}
    assert connected_components(frame.where("false")).count() == 0
