import random

import numpy as np
import pytest
import xxhash

from clientele.llm import gray_index
from clientele.llm.components import connected_components
from clientele.llm.gray_index import block_links, chained, fingerprint_links, keep_one_of_each, near_duplicates, simhash
from tests.helpers import settings
from tests.llm.data import awkward, groups, nothing, shingles


def plain_simhash(text):
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles(text, 4)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \n", "One", "a b c", "a b c d", "A b C d e f a b c d", "é à\x0bü " * 50, "x " * 999])
def test_simhash(text):
    assert simhash(text.encode()) == plain_simhash(text)


def clustered(n, seed):
    """Fingerprints in clusters of a few changed bits, some of them large, and lone ones."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(n // 40 + 1)]
    out = set()
    while len(out) < n:
        x = centres[0] if rng.random() < 0.3 else rng.choice(centres)
        for _ in range(rng.randrange(7)):
            x ^= 1 << rng.randrange(64)
        out.add(x if rng.random() < 0.9 else rng.getrandbits(64))
    return np.array(sorted(out), dtype=np.uint64)


def pairs(x, y):
    return {(a, b) for a in range(len(x)) for b in np.flatnonzero(np.bitwise_count(y ^ x[a]) <= 4).tolist()}


def test_block_links_are_all_links():
    x, y = clustered(700, 1), clustered(333, 2)
    y[:100] = x[:100] ^ np.uint64(5)
    a, b = block_links(x)
    assert set(zip(a.tolist(), b.tolist())) == {(p, q) for p, q in pairs(x, x) if p < q}
    a, b = block_links(x, y)
    assert set(zip(a.tolist(), b.tolist())) == pairs(x, y)


def test_chains_keep_components():
    a, b = np.array([5, 1, 1, 3, 8]), np.array([1, 2, 5, 4, 3])
    x, y = chained(a, b, 10)
    linked = set(zip(x.tolist(), y.tolist()))
    plain = set(zip(a.tolist(), b.tolist()))
    assert groups(10, lambda p, q: (p, q) in linked) == groups(10, lambda p, q: {(p, q), (q, p)} & plain)


@pytest.mark.parametrize("block", [2048, 16])
def test_components_of_large_nodes_cut_anywhere(spark, monkeypatch, block):
    x = clustered(1500, 3)
    signed = x.view(np.int64).tolist()
    monkeypatch.setattr(gray_index, "BLOCK", block)
    df = spark.createDataFrame([(v,) for v in signed], "fp bigint").repartition(6)
    with settings(spark, spark_sql_adaptive_enabled="false", spark_sql_shuffle_partitions="13"):
        links = fingerprint_links(df)
        found = {r["node"]: r["component"] for r in connected_components(links).collect()}
    near = {(a, b) for a, b in pairs(x, x) if a != b}
    root = groups(len(x), lambda a, b: (a, b) in near)
    expected = {}
    for i, r in enumerate(root):
        expected.setdefault(r, []).append(signed[i])
    assert {v: min(g) for g in expected.values() if len(g) > 1 for v in g} == found


def test_long_chain_and_no_links(spark):
    chain = spark.range(0, 300).selectExpr("id AS a", "id + 1 AS b")
    assert {r["component"] for r in connected_components(chain).collect()} == {0}
    assert connected_components(chain.limit(0)).collect() == []


def test_awkward_documents(spark):
    docs = awkward(spark)
    rows = docs.collect()
    prints = [plain_simhash(r["text"]) if r["doc_id"] != 7 else simhash(r["text"].encode()) for r in rows]
    known = sorted({(r["doc_id"], p) for r, p in zip(rows, prints) if r["doc_id"] is not None})
    root = groups(len(known), lambda a, b: (known[a][1] ^ known[b][1]).bit_count() <= 4)
    group = {k: known[r][0] for k, r in zip(known, root)}
    expected = [(r["doc_id"], p, group.get((r["doc_id"], p))) for r, p in zip(rows, prints)]
    found = near_duplicates(docs).collect()
    assert sorted(str(tuple(r)) for r in found) == sorted(str((i, f"{p:016x}", g)) for i, p, g in expected)
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    left = sorted(str((r["doc_id"], r["text"])) for r in kept.collect())
    assert left == sorted(str((r["doc_id"], r["text"])) for r, (i, _, g) in zip(rows, expected) if i == g)


def test_empty_table(spark):
    assert near_duplicates(nothing(spark)).collect() == []
    assert keep_one_of_each(nothing(spark)).collect() == []


@pytest.mark.parametrize("layout", gray_index.LAYOUTS)
def test_all_layouts_link_the_same(spark, monkeypatch, layout):
    x = clustered(600, 9)
    monkeypatch.setattr(gray_index, "BLOCK", 64)
    assert sum(layout.widths) == 64
    for table in range(len(layout.tables)):
        y = np.array([sum((int(v) >> a & (1 << w) - 1) << b for a, b, w in layout.moves(table)) for v in x], np.uint64)
        assert (gray_index._moved_back(y, layout, table).view(np.uint64) == x).all()
    df = spark.createDataFrame([(v,) for v in x.view(np.int64).tolist()], "fp bigint")
    links = {(r["a"], r["b"]) for r in fingerprint_links(df, layout).collect()}
    index = {v: i for i, v in enumerate(x.view(np.int64).tolist())}
    linked = {(index[a], index[b]) for a, b in links} | {(index[b], index[a]) for a, b in links}
    near = {(a, b) for a, b in pairs(x, x) if a != b}
    assert groups(len(x), lambda a, b: (a, b) in linked) == groups(len(x), lambda a, b: (a, b) in near)


def test_nodes_do_not_grow_with_the_corpus():
    rng = np.random.default_rng(2)
    for n in (10**5, 10**6, 10**7):
        layout = gray_index.layout_for(n)
        bits = layout.prefix(0)
        sizes = np.unique(rng.integers(0, 1 << 63, n, np.uint64) >> np.uint64(63 - bits), return_counts=True)[1]
        # Fingerprints that one is held against in a table, at most about a block.
        assert (sizes.astype(float) ** 2).sum() / n < 1.5 * gray_index.BLOCK
    assert [len(gray_index.layout_for(n).widths) for n in (10**5, 10**7, 10**9, 10**11, 10**13)] == [5, 6, 6, 7, 8]
