import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clientele.llm.suffix_dedup import (
    common_prefixes, drop_repeats, repeat_report, repeated_windows, smaller_than_next, suffix_order,
)
from tests import helpers
from tests.llm.data import awkward, nothing


def plain(rows, length):
    """Flags of removed bytes of each (order of the document, bytes)."""
    first = {}
    for order, data in rows:
        for i in range(len(data) - length + 1):
            w = data[i : i + length]
            first[w] = min(first.get(w, (order, i)), (order, i))
    out = []
    for order, data in rows:
        gone = [False] * len(data)
        for i in range(len(data) - length + 1):
            if first[data[i : i + length]] < (order, i):
                gone[i : i + length] = [True] * length
        out.append(gone)
    return out


def check(spark, rows, length=100, **options):
    """Rows of distinct ids."""
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in repeat_report(docs, length=length, **options).collect()}
    assert len(found) == len(rows)
    data = [(i, (t or "").encode()) for i, t in rows]
    lost = 0
    for (i, text), gone in zip(data, plain(data, length)):
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        expected = (i, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest())
        assert tuple(found[i]) == expected, (i, text)
        lost += sum(gone)
    return lost


def corpus(seed, n=60):
    """Texts that share passages of about 100 bytes, whole copies, near copies and loops."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["alpha", "βήτα", "gamma", "δ", "x", "of", "the", "a"]) + str(rng.randrange(300))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(k) for k in (12, 14, 16, 17, 18, 30, 60)]
    texts = []
    for i in range(n):
        text = prose(rng.randrange(40))
        for _ in range(rng.randrange(3)):
            text += rng.choice(["", " ", "\n"]) + rng.choice(passages) + rng.choice(["", " ", "\n"]) + prose(rng.randrange(9))
        texts.append(text)
    texts += [texts[3], texts[3], texts[7][:120], texts[7][1:], "ab" * 300, "a" * 500, "ba" * 90, "", None, "é" * 99]
    near = passages[-1].split(" ")
    for i in range(20):
        near[rng.randrange(len(near))] = word()
        texts.append(" ".join(near))
    ids = rng.sample(range(-500, 500), len(texts))
    return list(zip(ids, texts))


@pytest.mark.parametrize("seed", range(2))
def test_texts(spark, seed):
    assert check(spark, corpus(seed)) > 5000


def test_anchors_with_many_stretches(spark):
    # Every anchor with two stretches counts as too many for one task; all are cut to the end.
    assert check(spark, corpus(5), most=1) > 5000
    assert check(spark, corpus(6, 30), length=40, gram=8, most=3) > 5000


def test_parts_that_cut_stretches(spark):
    with helpers.settings(spark, spark_sql_shuffle_partitions="40", spark_sql_adaptive_enabled="false"):
        passage = " ".join(f"p{i}" for i in range(60))
        check(spark, [(i, f"own{i} {passage} tail{i * i}") for i in range(300)])


def test_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    rows = docs.select("doc_id", "text").collect()
    found = drop_repeats(docs).collect()
    assert len(found) == len(rows)
    by_id = {}
    for r in found:
        by_id.setdefault(r["doc_id"], []).append(r)
    text = {r["doc_id"]: (r["text"] or "").encode() for r in rows}
    assert by_id[1][0]["kept"] == text[1] and not by_id[1][0]["spans"]
    # Two rows of one id and text, wholly copied from the first; and one with another text.
    assert sorted(len(r["kept"]) for r in by_id[2])[:2] == [0, 0] and len(by_id[2]) == 3
    assert [r["kept"] for r in by_id[3] + by_id[4]] == [b"", b""]
    assert by_id[7][0]["n_bytes"] == len(text[7]) and len(by_id[None]) == 2
    assert repeat_report(nothing(spark)).collect() == []


def test_rows_of_one_id(spark):
    rng = random.Random(1)
    text = " ".join(str(rng.random()) for _ in range(20))
    rows = [(4, text), (4, text), (4, "other " + text), (None, text), (None, text + "!")]
    found = drop_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    whole = [r for r in found if not r["spans"]]
    # One document stays as it is: two rows of it, or one, by the order of the hashes.
    assert {r["doc_id"] for r in whole} == {4} and len({bytes(r["kept"]) for r in whole}) == 1
    assert all(not r["kept"] or len(r["kept"]) < 10 for r in found if r["spans"])


@settings(deadline=None, max_examples=200)
@given(st.text(st.sampled_from("abcd"), min_size=1, max_size=80))
def test_suffixes_are_sorted(text):
    data = text.encode()
    small = smaller_than_next(np.frombuffer(data, np.uint8)).tolist()
    assert small == [data[i:] < data[i + 1 :] for i in range(len(data))]
    order = suffix_order(data, len(data)).tolist()
    assert order == sorted(range(len(data)), key=lambda i: data[i:])
    shared = common_prefixes(data, np.array(order), 16).tolist()
    for k, (a, b) in enumerate(zip(order, order[1:])):
        n = 0
        while b + n < len(data) and a + n < len(data) and data[a + n] == data[b + n]:
            n += 1
        assert shared[k + 1] == n or n >= 16 and shared[k + 1] == 16 or shared[k + 1] >= n and min(len(data) - a, len(data) - b) == n


@settings(deadline=None, max_examples=100)
@given(st.lists(st.text(st.sampled_from("ab"), min_size=5, max_size=30), min_size=1, max_size=6))
def test_windows_that_start_earlier(texts):
    data = [x.encode() for x in texts]
    places = np.array([[k // 2, 1000 * (k % 2)] for k in range(len(data))])
    found = {tuple(x) for x in repeated_windows(data, places, 5).tolist()}
    first = {}
    windows = [(k, i, x[i : i + 5]) for k, x in enumerate(data) for i in range(len(x) - 4)]
    for k, i, w in windows:
        at = (*places[k] + [0, i],)
        first[w] = min(first.get(w, at), at)
    assert found == {(k, i) for k, i, w in windows if first[w] < (*places[k] + [0, i],)}
