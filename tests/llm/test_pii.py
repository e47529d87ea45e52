import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clientele.llm import pii
from clientele.llm.bilstm_crf import Tagger
from clientele.llm.pii import CARD, EMAIL, IP, KINDS, PHONE, Training, base_spans, find_personal_data, labelled_windows, luhn, train_tagger
from tests.llm.data import CLASHES, SF_DIR, awkward, nothing


def plain_base(text):
    digits = lambda x: re.sub("[^0-9]", "", x)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(len(x.lstrip("0")) < 4 and int(x[-4:]) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


@given(st.text(alphabet="a1@.+- 0()_é%\n", max_size=60))
@settings(max_examples=400, deadline=None)
def test_base_spans(text):
    assert base_spans(text) == plain_base(text)


@pytest.mark.parametrize("text", ["a@b@c.d x@y.z", "@@a@b.c", "a@b.c@d.e", "+1 (2) 345-6789 +12345678", "1.2.3.4.5.6.7.8 256.1.1.1 007.0000255.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "𝒹@é a%b@c-d.e. " * 3, "1" * 5000 + "." + "2" * 5000 + ".3.4"])
def test_base_spans_of_hard_texts(text):
    assert base_spans(text) == plain_base(text)


def test_gradients():
    rng = np.random.default_rng(0)
    tagger = Tagger.new(7, 4, 3, seed=1)
    tagger.parameters = {k: v.astype(np.float64) for k, v in tagger.parameters.items()}
    x, y = rng.integers(0, 7, (5, 3)), rng.integers(0, 4, (5, 3))
    _, grads = tagger.gradients(x, y)
    for name, values in tagger.parameters.items():
        for at in list(np.ndindex(values.shape))[:: max(1, values.size // 6)]:
            before, step = values[at], 1e-3
            values[at] = before + step
            up = tagger.gradients(x, y)[0]
            values[at] = before - step
            down = tagger.gradients(x, y)[0]
            values[at] = before
            assert abs((up - down) / (2 * step) - grads[name][at]) < 2e-3, (name, at)


def test_decode_is_the_best_of_all_sequences():
    from itertools import product

    tagger = Tagger.new(5, 3, 4, seed=2)
    x = np.random.default_rng(1).integers(0, 5, (4, 6))
    scores, move = tagger.scores(x), tagger.parameters["move"]
    found = tagger.decode(x)
    for b in range(6):
        total = lambda tags: sum(scores[t, b, k] for t, k in enumerate(tags)) + sum(move[i, j] for i, j in zip(tags, tags[1:]))
        assert tuple(found[:, b]) == max(product(range(3), repeat=4), key=total)


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    return [r["text"] for r in rows]


@pytest.fixture(scope="module")
def tagger(texts):
    return train_tagger(texts[:120])


def test_held_out_accuracy(texts, tagger):
    x, y = labelled_windows(texts[120:], Training(windows=600), seed=99)
    found = tagger.decode(x)
    assert (found == y).mean() > 0.97
    assert (found == y)[y > 0].mean() > 0.9
    assert (found > 0)[y == 0].mean() < 0.02


def test_window_starts_cover_every_trigger():
    for text in ("", "x" * 500, "x" * 300 + "7" + "x" * 300, "7" * 200, "a@" + "b " * 100 + "9", "x" * 63 + "1", "x" * 97 + "(at)"):
        starts = pii._window_starts(text)
        last = max(0, -(-(len(text) - pii.WINDOW) // pii.STRIDE)) * pii.STRIDE
        wanted = [s for s in range(0, last + 1, pii.STRIDE) if pii._TRIGGER.search(text[s : s + pii.WINDOW + 3]) and any(
            s <= m.start() < s + pii.WINDOW for m in pii._TRIGGER.finditer(text))]
        assert starts == wanted, text


def test_spans_are_added_across_windows_and_never_touch_the_base(texts, tagger):
    filler = "Thonsh ores to edat of herein scum onea "
    said = "(555) 123-4567"
    hits = 0
    for shift in range(0, 64, 4):
        text = filler * 2 + "x" * shift + " call " + said + " now. " + filler * 2
        tags = {}
        for s in pii._window_starts(text):
            window = np.full(pii.WINDOW, 1, np.uint8)
            piece = pii.symbols(text[s : s + pii.WINDOW])
            window[: len(piece)] = piece
            tags[s] = tagger.decode(window[:, None])[:, 0]
        found = pii.added_spans(text, tags, base_spans(text))
        start = text.index(said)
        hits += ("phone", start, start + len(said)) in found
        assert pii.added_spans(text, tags, [("card", start + 3, start + 6)]) == []
    assert hits >= 12


def test_documents(spark):
    docs = spark.createDataFrame(
        [
            (1, "mail jo.doe@mail7.example.com, +1 (017) 555-7713 or 161.17.88.162", *["x"] * len(CLASHES)),
            (2, None, *["x"] * len(CLASHES)),
            (None, "4929348385146306 is a card? 4111 1111 1111 1111 is", *["x"] * len(CLASHES)),
        ],
        "doc_id bigint, text string, " + ", ".join(f"{c} string" for c in CLASHES),
    )
    small = Training(documents=3, windows=300, rounds=1, hidden=4)
    rows = {r["doc_id"]: r for r in find_personal_data(docs.union(docs.where("doc_id = 1")), training=small).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for i, row in rows.items():
        own = base_spans(texts[i])
        assert [row[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in own) for k in KINDS]
        assert row["base_sha256"] == hashlib.sha256(pii.joined(own).encode()).hexdigest()
        assert set(pii.joined(own).split(",")) <= set(row["spans"].split(","))
    assert find_personal_data(awkward(spark), training=small).count() == awkward(spark).count()
    assert find_personal_data(nothing(spark), training=small).collect() == []


def test_disguised_data_in_whole_documents(spark):
    """Data that no pattern sees, put anywhere into each document of a table."""
    rng = np.random.default_rng(5)
    docs, planted = [], {}
    for row in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect():
        text, kind = row["text"], KINDS[row["doc_id"] % len(KINDS)]
        put, cut = pii._disguised(kind, rng), int(rng.integers(0, max(1, len(text))))
        while cut and text[cut - 1].strip():
            cut -= 1
        docs.append((row["doc_id"], text[:cut] + put + " " + text[cut:]))
        planted[row["doc_id"]] = kind, cut, cut + len(put)
    hits = dict.fromkeys(KINDS, 0)
    added = right = 0
    texts = dict(docs)
    for row in find_personal_data(spark.createDataFrame(docs, "doc_id bigint, text string")).collect():
        base = set(pii.joined(base_spans(texts[row["doc_id"]])).split(","))
        every = [x for x in row["spans"].split(",") if x]
        kind, start, end = planted[row["doc_id"]]
        hits[kind] += f"{kind}:{start}:{end}" in every
        for x in (x.split(":") for x in every if x not in base):
            added += 1
            right += int(x[1]) < end and int(x[2]) > start
    assert sum(hits.values()) >= 0.9 * len(docs) and min(hits.values()) >= 0.85 * len(docs) / 4
    assert right >= 0.98 * added


def test_windows_are_read_on_while_a_span_goes_on():
    text = "x" * 400
    tags = {96: np.zeros(pii.WINDOW, np.int8), 128: np.zeros(pii.WINDOW, np.int8)}
    assert pii.open_ends(text, tags) == []
    tags[128][-5:] = 2
    assert pii.open_ends(text, tags) == [160]
    tags[96][0] = 2
    assert pii.open_ends(text, tags) == [64, 160]
    # The last window of a text has none behind it.
    assert pii.open_ends("x" * 192, {128: np.full(pii.WINDOW, 2, np.int8)}) == [96]
