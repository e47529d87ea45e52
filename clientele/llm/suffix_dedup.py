"""Removal of repeated byte strings by two-stage suffix sorting.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier. Strings are
brought together by content, and sorted where they are few:

1. A window of ``LENGTH`` bytes has an anchor, the ``GRAM`` bytes in it with the least hash,
   the first of equals. Equal windows have equal anchors at equal places. Neighbouring
   windows with one anchor are a run; a run's stretch is the bytes of all its windows.
2. Runs are range-partitioned and sorted by anchor, stretch and place. Of equal stretches
   the first stays and stands for all; in the later ones every window has started before.
   Batches do the same before the shuffle. A stretch whose anchor no other has is done.
3. The bytes of the stretches that are left are cut out of their texts. All stretches of an
   anchor go to one task, which sorts their suffixes in two stages: those smaller than their
   successors directly, the rest by scans of the buckets, from the smallest on. Neighbours
   with a common prefix of ``LENGTH`` bytes are the same window; all but the earliest go.
4. An anchor with more stretches than ``MOST`` is not sorted in one task. The windows of
   its stretches are cut in two, by how far into them the anchor lies; the longer string
   that the windows of a half share is their anchor in a further pass of 2 and 3.

Hashes of 64 bits of the anchor and the whole stretch together stand for a stretch in step 2.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.arrow import slices
from clientele.llm.scratch import stored, text_key

#: Bytes of a string that may not come twice, and of an anchor, a power of two.
LENGTH, GRAM = 100, 32
#: Stretches of one anchor that a task sorts at once.
MOST = 2000
#: Bytes that are hashed or sorted at once. They bound memory only.
BLOCK = 1_000_000
_MASK = (1 << 64) - 1
_PLACE = np.uint64(0xFFFFFFFF)


# --- runs of windows with one anchor -----------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """The bits of 64-bit integers, mixed."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window its anchor's place, and for each place the hash of the bytes there."""
    x, base, size = _LETTERS[data], 0x2545F4914F6CDD1D, 1
    while size < gram:
        x = x[:-size] * np.uint64(base) + x[size:]
        base, size = base * base & _MASK, 2 * size
    x = mixed(x)
    least = (x & ~_PLACE) | np.arange(len(x), dtype=np.uint64)
    places, size = length - gram + 1, 1
    while 2 * size <= places:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    if size < places:
        least = np.minimum(least[: size - places], least[places - size :])
    return (least & _PLACE).astype(np.int64), x.view(np.int64)


def _blocks(texts: list[bytes], length: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts joined, up to ``BLOCK`` bytes: the bytes, and for each part of them its text, its
    begin in the block, and its begin in the text. Parts of a longer text overlap, so that
    each window is in one."""
    own: list[tuple[int, int, int]] = []
    parts: list[bytes] = []
    size = 0
    for k, text in enumerate(texts):
        if len(text) < length:
            continue
        for at in range(0, len(text) - length + 1, BLOCK):
            part = text[at : at + BLOCK + length - 1]
            if size + len(part) > BLOCK and parts:
                yield b"".join(parts), *np.array(own, np.int64).T
                own, parts, size = [], [], 0
            own.append((k, size, at))
            parts.append(part)
            size += len(part)
    if parts:
        yield b"".join(parts), *np.array(own, np.int64).T


def block_runs(data: bytes, begins: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of the joined parts: part, first and last window, anchor, hash of the anchor."""
    places, hashes = anchors(np.frombuffer(data, np.uint8), length, gram)
    ends = np.append(begins[1:], len(data))
    inside = np.zeros(len(places) + 1, np.int64)
    np.add.at(inside, begins, 1)
    np.add.at(inside, ends - length + 1, -1)
    windows = np.flatnonzero(np.cumsum(inside[:-1]))
    own = places[windows]
    first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    last = np.append(first[1:], len(own)) - 1
    lo, hi, anchor = windows[first], windows[last], own[first]
    return np.searchsorted(begins, lo, "right") - 1, lo, hi, anchor, hashes[anchor]


#: Rows of step 2: runs; bytes that go, from ``lo`` to the one before ``hi``; runs that go;
#: runs of the stretch that a part begins with; first runs at a part's ends.
RUN, GOES, LATER, OPEN, EDGE = range(5)
_KEYS = ["h", "own", "doc_id", "text_key", "lo"]
_RUN = "kind int, h bigint, own bigint, doc_id bigint, text_key bigint, lo bigint, hi bigint, anchor bigint"
_RUN_TYPES = [pa.int32(), *[pa.int64()] * 7]
_RUN_NAMES = ["kind", *_KEYS, "hi", "anchor"]


def merged(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals, sorted by begin, that touch or overlap, as one."""
    if not len(begins):
        return begins, ends
    reach = np.maximum.accumulate(ends)
    new = np.append(True, begins[1:] > reach[:-1])
    last = np.append(np.flatnonzero(new)[1:], len(begins)) - 1
    return begins[new], reach[last]


def _runs(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            # Rows of one id and text are one document.
            documents, document = np.unique(np.stack([ids, keys], 1), axis=0, return_inverse=True)
            document = document.ravel()
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            for data, text, begins, bases in _blocks(texts, length):
                part, lo, hi, anchor, h = block_runs(data, begins, length, gram)
                digest = xxhash.xxh3_64_intdigest
                stretches = [digest(data[a:b]) for a, b in zip(lo.tolist(), (hi + length).tolist())]
                own = np.array(stretches, np.uint64).view(np.int64)
                shift, doc = (bases - begins)[part], document[text[part]]
                lo, hi, anchor = lo + shift, hi + shift, anchor + shift
                order = np.lexsort((lo, doc, own, h))
                part, lo, hi, anchor, h, own, doc = (x[order] for x in (part, lo, hi, anchor, h, own, doc))
                new = np.append(True, (h[1:] != h[:-1]) | (own[1:] != own[:-1]))
                first = np.flatnonzero(new)[np.cumsum(new) - 1]
                later = ~new & ((doc != doc[first]) | (lo != lo[first]))
                yield _run_batch(RUN, documents, *(x[new] for x in (h, own, doc, lo, hi, anchor)))
                goes = np.flatnonzero(later)[np.lexsort((lo[later], doc[later]))]
                # One line for all documents of the block, so that they are merged at once.
                line = doc[goes] << 32
                a, b = merged(line + lo[goes], line + hi[goes] + length)
                spread = mixed(a.astype(np.uint64)).view(np.int64)
                yield _run_batch(GOES, documents, spread, spread, a >> 32, a & 0xFFFFFFFF, b & 0xFFFFFFFF, a * 0)

    return docs.mapInArrow(rows, _RUN)


def _run_batch(kind, documents, h, own, doc, lo, hi, anchor) -> pa.RecordBatch:
    ids = documents[doc]
    columns = [np.full(len(h), kind), h, own, ids[:, 0], ids[:, 1], lo, hi, anchor]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _RUN_TYPES)], _RUN_NAMES)


# --- equal stretches ---------------------------------------------------------


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted runs the first of each stretch whose anchor another stretch has, or may have
    in another part, and as rows that go the stretches of the others. The rows of the stretch
    that the part begins with may all be later ones; they come as they are."""

    def told(batch: pa.RecordBatch, at: np.ndarray, kind: int) -> pa.RecordBatch:
        took = batch.take(pa.array(at, pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind), pa.int32()), *took.columns[1:]], took.schema.names)

    held = None  # the first run of the stretch at hand
    opening = shared = True  # whether the part begins with it; whether its anchor has others
    one = np.zeros(1, np.int64)
    for batch in batches:
        runs = batch.column(0).to_numpy() == RUN
        if not runs.all():
            yield told(batch, np.flatnonzero(~runs), GOES)
            batch = batch.filter(pa.array(runs))
        if not len(batch):
            continue
        if held is None:
            yield told(batch, one, EDGE)
        else:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        h, own, doc, key, lo = (batch.column(i).to_numpy() for i in range(1, 6))
        other = h[1:] != h[:-1]
        new = np.append(True, other | (own[1:] != own[:-1]))
        group = np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        first = heads[group]
        later = (doc != doc[first]) | (key != key[first]) | (lo != lo[first])
        if opening:
            yield told(batch, np.flatnonzero(later & (group == 0)), OPEN)
            later &= group > 0
        yield told(batch, np.flatnonzero(later), LATER)
        # A head is shared if the one before or behind has its anchor.
        beside = h[heads[1:]] == h[heads[:-1]]
        before, behind = np.append(shared, beside), np.append(beside, False)
        done = heads[:-1][(before | behind)[:-1]]
        if opening and len(heads) > 1:
            yield told(batch, one, OPEN)
            done, opening = done[done > 0], False
        yield told(batch, done, RUN)
        held, shared = batch.slice(int(heads[-1]), 1), bool(before[-1])
    if held is not None:
        yield told(held, one, OPEN if opening else RUN)
        yield told(held, one, EDGE)


def _settled(rows: DataFrame, schema: str, length: int, label: str) -> tuple[DataFrame, DataFrame]:
    """First runs of stretches whose anchor has several, and intervals that go."""
    ordered = rows.repartitionByRange(*_KEYS).sortWithinPartitions(*_KEYS)
    found = stored(ordered.mapInArrow(_settle, schema), label)
    # Two rows for each part at most, so they can be broadcast.
    firsts = found.where(F.col("kind") == EDGE).groupBy("h", "own").agg(
        F.min(F.struct("doc_id", "text_key", "lo")).alias("first")
    )
    opened = found.where(F.col("kind") == OPEN).join(F.broadcast(firsts), ["h", "own"])
    is_first = F.struct("doc_id", "text_key", "lo") == F.col("first")
    names = found.columns[1:]
    runs = found.where(F.col("kind") == RUN).select(*names).union(opened.where(is_first).select(*names))
    end = F.when(F.col("kind") == GOES, F.col("hi")).otherwise(F.col("hi") + length).alias("end")
    interval = ["doc_id", "text_key", "lo", end]
    goes = found.where(F.col("kind").isin(GOES, LATER)).select(*interval)
    return runs, goes.union(opened.where(~is_first).select(*interval))


# --- two-stage suffix sorting ------------------------------------------------


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one that follows; the last one is not."""
    step = np.sign(np.diff(text.astype(np.int16)))
    at = np.where(step != 0, np.arange(len(step)), len(step))
    # The next place at which neighbours differ.
    at = np.minimum.accumulate(at[::-1])[::-1]
    return np.append(np.append(step, -1)[at] > 0, False)


def suffix_order(text: bytes, depth: int) -> np.ndarray:
    """All suffixes in the order of their first ``depth`` bytes, at least."""
    data = np.frombuffer(text, np.uint8)
    n = len(data)
    small = smaller_than_next(data)
    # First stage: a direct sort.
    direct = np.flatnonzero(small)
    keys = [text[i : i + depth] for i in direct.tolist()]
    direct = direct[np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)]
    del keys
    sizes = np.bincount(data, minlength=256)
    ends = np.cumsum(sizes)
    # In a bucket the suffixes larger than their successors come first.
    larger = np.bincount(data[~small], minlength=256)
    order = np.full(n, -1, np.int64)
    heads = ends - sizes
    where = data[direct].astype(np.int64)
    rank = np.arange(len(direct)) - (np.cumsum(sizes - larger) - (sizes - larger))[where]
    order[(heads + larger)[where] + rank] = direct
    # Second stage: each suffix in order places the one before it, if that is larger.
    head = heads.copy()

    def place(block: np.ndarray) -> None:
        before = block[block > 0] - 1
        before = before[~small[before]]
        first = data[before]
        before = before[np.argsort(first, kind="stable")]
        for c, many in zip(*(x.tolist() for x in np.unique(first, return_counts=True))):
            order[head[c] : head[c] + many] = before[:many]
            head[c] += many
            before = before[many:]

    # The last suffix is larger than its successor, the empty one, and first in its bucket.
    order[head[data[-1]]] = n - 1
    head[data[-1]] += 1
    for c in np.flatnonzero(sizes).tolist():
        at = heads[c]
        while at < head[c]:  # also those that it places in its own bucket
            at, block = head[c], order[at : head[c]]
            place(block)
        place(order[heads[c] + larger[c] : ends[c]])
    return order


#: A word below the i-th of these begins with over i zero bytes.
_BYTES = np.array([1 << 64 - 8 * i for i in range(1, 8)], np.uint64)


def common_prefixes(text: bytes, order: np.ndarray, most: int) -> np.ndarray:
    """For each suffix in the order the bytes that it shares with the one before, up to a
    multiple of 8 that is ``most`` or more."""
    most = -(-most // 8) * 8
    data = np.frombuffer(text + bytes(most + 8), np.uint8)
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 8)).view(">u8").ravel()
    shared = np.zeros(len(order), np.int64)
    open_ = np.arange(1, len(order))
    for at in range(0, most, 8):
        differ = (words[order[open_] + at] ^ words[order[open_ - 1] + at]).astype("<u8")
        same = differ == 0
        found = open_[~same]
        # The leading zero bytes of what differs.
        shared[found] = at + (differ[~same, None] < _BYTES).sum(1)
        open_ = open_[same]
    shared[open_] = most
    return shared


def repeated_windows(stretches: list[bytes], places: np.ndarray, length: int) -> np.ndarray:
    """Pairs of stretch and offset, sorted, of the windows that also start earlier;
    ``places`` are two columns by which stretches are ordered, documents and offsets."""
    # Zero ends a stretch; UTF-8 has no 0xFF, so all its bytes can go up by one.
    text = b"\0".join(x.translate(_UP) for x in stretches)
    sizes = np.fromiter(map(len, stretches), np.int64, len(stretches))
    begins = np.cumsum(sizes + 1) - sizes - 1
    order = suffix_order(text, length + 1)
    stretch = np.searchsorted(begins, order, "right") - 1
    offset = order - begins[stretch]
    full = offset + length <= sizes[stretch]
    order, stretch, offset = order[full], stretch[full], offset[full]
    if not len(order):
        return np.zeros((0, 2), np.int64)
    first = np.flatnonzero(common_prefixes(text, order, length) < length)
    _, document = np.unique(places[:, 0], return_inverse=True)
    place = (document.ravel()[stretch] << 32) + places[stretch, 1] + offset
    earliest = np.repeat(np.minimum.reduceat(place, first), np.diff(np.append(first, len(order))))
    later = place > earliest
    found = np.stack([stretch[later], offset[later]], 1)
    return found[np.lexsort((found[:, 1], found[:, 0]))]


_UP = bytes(min(i + 1, 255) for i in range(256))


def _sort_stretches(length: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # one row for each stretch of the anchors at hand
        size, last = 0, None
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in ("h", "doc_id", "text_key", "lo", "data")]
            for row in zip(*columns):
                if row[:4] == last:
                    continue  # a repeated row
                if size > BLOCK and row[0] != last[0]:
                    yield _gone(held, length)
                    held, size = [], 0
                held.append(row)
                size, last = size + len(row[4]), row[:4]
        yield _gone(held, length)

    return rows


def _gone(held: list[tuple], length: int) -> pa.RecordBatch:
    """Intervals that go of stretches with the same anchor; those that stand alone have none."""
    rows = [
        x for i, x in enumerate(held)
        if i and held[i - 1][0] == x[0] or i + 1 < len(held) and held[i + 1][0] == x[0]
    ]
    out = np.zeros((0, 4), np.int64)
    if rows:
        ids = np.array([x[1:3] for x in rows], np.int64)
        _, document = np.unique(ids, axis=0, return_inverse=True)
        lo = np.array([x[3] for x in rows], np.int64)
        found = repeated_windows([x[4] for x in rows], np.stack([document.ravel(), lo], 1), length)
        # A line for each stretch, apart, so that all intervals are merged at once.
        line = found[:, 0] << 32
        a, b = merged(line + found[:, 1], line + found[:, 1] + length)
        stretch, size = a >> 32, b - a
        begin = lo[stretch] + (a & 0xFFFFFFFF)
        out = np.column_stack([ids[stretch], begin, begin + size])
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out.T], _GOES_NAMES)


_GOES = "doc_id bigint, text_key bigint, lo bigint, end bigint"
_GOES_NAMES = ["doc_id", "text_key", "lo", "end"]


# --- stretches and their bytes -----------------------------------------------

_STRETCH = f"{_RUN}, low int, high int, data binary"
_STRETCH_TYPES = [*_RUN_TYPES, pa.int32(), pa.int32(), pa.binary()]
_STRETCH_NAMES = [*_RUN_NAMES, "low", "high", "data"]


def _stretch_batch(out: list[tuple]) -> pa.RecordBatch:
    columns = zip(*out) if out else [()] * len(_STRETCH_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _STRETCH_TYPES)], _STRETCH_NAMES)


def _cut_out(docs: DataFrame, runs: DataFrame, length: int, gram: int) -> DataFrame:
    """The runs with the bytes of their stretches; ``low`` and ``high`` bound how far into a
    window the anchor lies."""
    names = ["h", "own", "lo", "hi", "anchor"]
    by_doc = runs.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct(*names)).alias("runs"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            for doc_id, key, text, runs in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, batch.column(3).to_pylist()
            ):
                out = []
                for x in runs:
                    head = RUN, x["h"], x["own"], doc_id, key, x["lo"], x["hi"], x["anchor"]
                    out.append((*head, 0, length - gram, text[x["lo"] : x["hi"] + length]))
                yield _stretch_batch(out)

    return docs.join(by_doc, ["doc_id", "text_key"]).select("doc_id", "text_key", "text", "runs").mapInArrow(
        rows, _STRETCH
    )


def _halves(length: int):
    """Each stretch as up to two, by how far into its windows the anchor lies. What the
    windows of a half all cover is the anchor of the half."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                _, h, _, doc_id, key, lo, hi, anchor, low, high, data = row
                middle = (low + high) // 2
                for a, b in ((low, middle), (middle + 1, high)):
                    # Windows from anchor - b to anchor - a.
                    first, last = max(lo, anchor - b), min(hi, anchor - a)
                    if first > last:
                        continue
                    part = data[first - lo : last - lo + length]
                    core = data[anchor - a - lo : anchor - b + length - lo]
                    new = xxhash.xxh3_64_intdigest(core, seed=h & 0xFFFF_FFFF ^ a << 8 ^ b)
                    own = xxhash.xxh3_64_intdigest(part)
                    new, own = (x - (x >> 63 << 64) for x in (new, own))
                    out.append((RUN, new, own, doc_id, key, first, last, anchor, a, b, part))
            yield _stretch_batch(out)

    return rows


def repeated_intervals(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = MOST
) -> DataFrame:
    """``doc_id, text_key, spans`` of ``doc_id, text_key, text``: for documents that lose bytes
    the merged spans, as a binary of 64-bit pairs of begin and end."""
    runs, goes = _settled(_runs(docs, length, gram), _RUN, length, "runs")
    level = stored(_cut_out(docs, runs, length, gram), "stretches")
    while True:
        hot = stored(level.groupBy("h").count().where(F.col("count") > most).select("h"), "hot_anchors")
        few = level.join(hot, "h", "left_anti").select("h", "doc_id", "text_key", "lo", "data")
        few = few.repartition("h").sortWithinPartitions("h", "doc_id", "text_key", "lo")
        goes = goes.union(stored(few.mapInArrow(_sort_stretches(length), _GOES), "sorted"))
        if hot.isEmpty():
            break
        halves = level.join(hot, "h", "left_semi").where("low < high").select(*_STRETCH_NAMES)
        runs, later = _settled(halves.mapInArrow(_halves(length), _STRETCH), _STRETCH, length, "halves")
        goes = goes.union(later)
        level = stored(runs.withColumn("kind", F.lit(RUN)).select(*_STRETCH_NAMES), "stretches")
    by_doc = goes.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("lo", "end")).alias("goes"))

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lists = batch.column(2)
            begins, ends = (lists.flatten().field(i).to_numpy() for i in (0, 1))
            at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            out = []
            for a, b in zip(at.tolist(), at[1:].tolist()):
                order = np.argsort(begins[a:b], kind="stable")
                out.append(np.column_stack(merged(begins[a:b][order], ends[a:b][order])).astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["doc_id", "text_key", "spans"]
            )

    return by_doc.mapInArrow(spans, "doc_id bigint, text_key bigint, spans binary")


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text_key, text``; the key is 0 unless several rows have the id or none."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    own = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text.alias("text"))
    none = F.col("doc_id").isNull()
    key = F.when(none, text_key(F.col("text"))).otherwise(0)
    twice = own.where(~none).groupBy("doc_id").count().where("count > 1").select("doc_id")
    twice = stored(twice.withColumn("twice", F.lit(True)), "repeated_ids")
    if not twice.isEmpty():
        own = own.join(twice, "doc_id", "left")
        key = F.when(none | F.col("twice"), text_key(F.col("text"))).otherwise(0)
    return own.select(
        F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc_id"), key.cast("bigint").alias("text_key"), "text",
        none.alias("nameless"),
    )


def kept_bytes(text: bytes, spans: np.ndarray) -> bytes:
    """The bytes outside the spans, rows of begin and end."""
    edges = [0, *spans.ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def drop_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    most: int = MOST,
) -> DataFrame:
    """Per row ``doc_id, n_bytes, spans, kept``: the spans of the text's UTF-8 bytes that go,
    as pairs of begin and end, and the bytes that stay, which need not be UTF-8.

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a
    document with a smaller id, or earlier in the same one. Strings do not cross documents.
    Rows of one id and one text are one document and get the same result. Rows of one id
    and different texts are documents in the order of the texts' hashes; rows without an id
    are the last documents, in the same order. Null texts are empty. Other columns are not
    looked at.
    """
    own = _documents(docs, id_col, text_col)
    found = repeated_intervals(own.drop("nameless"), length, gram, most)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            spans = [np.frombuffer(x or b"", "<i8").reshape(-1, 2) for x in batch.column(2).to_pylist()]
            kept = [kept_bytes(t, s) for t, s in zip(texts, spans)]
            lists = [[{"begin": a, "end": b} for a, b in s.tolist()] for s in spans]
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            sizes = pa.array(map(len, texts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(lists, kind), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"],
            )

    real = F.when(~F.col("nameless"), F.col("doc_id")).alias("doc_id")
    joined = own.join(found, ["doc_id", "text_key"], "left").select(real, "text", "spans")
    return joined.mapInArrow(
        rows, "doc_id bigint, n_bytes bigint, spans array<struct<begin:bigint,end:bigint>>, kept binary"
    )


def repeat_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of ``drop_repeats``."""
    return drop_repeats(docs, id_col, text_col, **options).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
