"""Near duplicates by SimHash, with a hierarchical index in Gray order.

Fingerprints within ``RADIUS`` = 4 bits agree on at least one of five segments, on two of six,
on three of seven. For each such choice of segments the fingerprints' bits are moved so that
these come first, and sorted by Gray rank, where neighbours differ in few bits. The more
fingerprints there are, the more segments are chosen and the longer is what a node's
members share (``layout_for``), so that nodes do not grow with the corpus. The levels of the index are

* nodes: all fingerprints with the same bits in these segments, the mask of the top level;
* blocks of at most ``BLOCK`` neighbours of a node, with the mask of the bits that all of
  them share and the pattern there;
* groups of ``GROUP`` neighbours of a block, with a mask and pattern of their own.

Two subtrees are compared only if their patterns differ in at most four of the bits that
both masks hold. Nodes do not have to fit into a task: the sort cuts them anywhere, and
the blocks of cut or large nodes are paired by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.arrow import slices
from clientele.llm.components import connected_components
from clientele.llm.scratch import stored, text_key

RADIUS, BLOCK, GROUP = 4, 2048, 32
_SIGN = np.uint64(1 << 63)


@dataclass(frozen=True)
class Layout:
    """Segments of the 64 bits, from the highest on. A table for each choice of all but
    ``RADIUS`` of them has their bits first, then the others'."""

    widths: tuple[int, ...]

    @property
    def tables(self) -> list[tuple[int, ...]]:
        return list(combinations(range(len(self.widths)), len(self.widths) - RADIUS))

    def prefix(self, table: int) -> int:
        """The number of bits that a node of the table shares."""
        return sum(self.widths[i] for i in self.tables[table])

    def moves(self, table: int) -> list[tuple[int, int, int]]:
        """For each segment the places of its lowest bit before and after, and its width."""
        chosen = self.tables[table]
        out, to = [], 64
        for i in (*chosen, *(i for i in range(len(self.widths)) if i not in chosen)):
            to -= self.widths[i]
            out.append((64 - sum(self.widths[: i + 1]), to, self.widths[i]))
        return out


LAYOUTS = tuple(
    Layout(tuple(64 // n + (i < 64 % n) for i in range(n))) for n in range(RADIUS + 1, RADIUS + 5)
)


def layout_for(n: int) -> Layout:
    """The fewest segments at which ``n`` fingerprints fill nodes of a block on average."""
    for layout in LAYOUTS:
        if n >> min(map(layout.prefix, range(len(layout.tables)))) < BLOCK:
            return layout
    return LAYOUTS[-1]


# --- fingerprints ------------------------------------------------------------


def simhash(text: bytes, words: int = 4, seed: int = 42) -> int:
    """The fingerprint: a bit is set if it is set in over half of the shingles' XXH64."""
    found = text.lower().split()
    if not found:
        return 0
    if len(found) < words:
        shingles: Iterator[bytes] = iter([b" ".join(found)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words))))
        n = len(found) - words + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), "<u8", n)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, seed: int = 42
) -> DataFrame:
    """``doc_id, text_key, fp``: a hash that tells texts apart, and the 64 bits as a signed
    number. A null or wordless text has 0."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            found = np.fromiter((simhash(t or b"", words, seed) for t in texts), "<u8", len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found.view(np.int64))],
                ["doc_id", "text_key", "fp"],
            )

    chosen = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        text_key(F.col(text_col)).alias("text_key"),
        F.col(text_col).alias("text"),
    )
    return chosen.mapInArrow(hashed, "doc_id bigint, text_key bigint, fp bigint")


# --- the index ---------------------------------------------------------------


def _gray_rank(bits: Column) -> Column:
    """The place of the bits in the sequence of Gray codes, to be sorted as a signed number."""
    for by in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, by))
    return bits.bitwiseXOR(F.lit(-(1 << 63)))


def _moved(bits: Column, layout: Layout, table: int) -> Column:
    out = F.lit(0).cast("bigint")
    for before, after, width in layout.moves(table):
        part = F.shiftrightunsigned(bits, before).bitwiseAND((1 << width) - 1)
        out = out.bitwiseOR(F.shiftleft(part, after))
    return out


def shared_bits(groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mask and pattern of the bits that all fingerprints of a row agree on."""
    ones = np.bitwise_and.reduce(groups, axis=-1)
    zeros = np.bitwise_and.reduce(~groups, axis=-1)
    return ones | zeros, ones


def _grouped(x: np.ndarray) -> np.ndarray:
    """In rows of ``GROUP``; the last fingerprint fills up the last row."""
    rows = -(-len(x) // GROUP)
    return np.concatenate([x, np.full(rows * GROUP - len(x), x[-1])]).reshape(rows, GROUP)


def block_links(x: np.ndarray, y: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of fingerprints at most ``RADIUS`` bits apart, between two blocks or
    within one."""
    own = y is None
    y = x if own else y
    gx = _grouped(x)
    gy = gx if own else _grouped(y)
    (mx, px), (my, py) = shared_bits(gx), shared_bits(gy)
    apart = np.bitwise_count((px[:, None] ^ py[None]) & mx[:, None] & my[None])
    near = apart <= RADIUS
    if own:
        near &= np.tri(len(gx), dtype=bool).T
    left, right, found_a, found_b = *np.nonzero(near), [], []
    for at in range(0, len(left), 1024):
        i, j = left[at : at + 1024], right[at : at + 1024]
        close = np.bitwise_count(gx[i][:, :, None] ^ gy[j][:, None, :]) <= RADIUS
        k, a, b = np.nonzero(close)
        a, b = i[k] * GROUP + a, j[k] * GROUP + b
        keep = (a < len(x)) & (b < len(y))
        if own:
            keep &= a < b
        found_a.append(a[keep])
        found_b.append(b[keep])
    if not found_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


def chained(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Fewer links between the same ``n`` points with the same components: each point with the
    next one of its component, so that none has many."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    order = np.argsort(label, kind="stable")
    same = label[order][1:] == label[order][:-1]
    return order[:-1][same], order[1:][same]


_OUT = pa.schema(
    [
        ("a", pa.int64()),
        ("b", pa.int64()),
        ("segment", pa.int32()),
        ("node", pa.int64()),
        ("block", pa.int64()),
        ("mask", pa.int64()),
        ("pattern", pa.int64()),
        ("data", pa.binary()),
    ]
)
_OUT_SQL = (
    "a bigint, b bigint, segment int, node bigint, block bigint, mask bigint, pattern bigint,"
    " data binary"
)


def _moved_back(x: np.ndarray, layout: Layout, table: int) -> np.ndarray:
    out = np.zeros(len(x), np.uint64)
    for before, after, width in layout.moves(table):
        out |= (x >> np.uint64(after) & np.uint64((1 << width) - 1)) << np.uint64(before)
    return out.view(np.int64)


class _Writer:
    """Collects links and blocks of one task."""

    def __init__(self, layout: Layout) -> None:
        self.layout = layout
        self.links: list[np.ndarray] = []
        self.blocks: list[tuple] = []

    def add(self, ranks: np.ndarray, segment: int, node: int, outer: bool) -> None:
        x = ranks ^ (ranks >> np.uint64(1))
        if len(x) > 1:
            a, b = block_links(x)
            if len(a):
                a, b = chained(a, b, len(x))
                self.links.append(np.stack([_moved_back(y, self.layout, segment) for y in (x[a], x[b])]))
        if outer:
            mask, pattern = (int(v.view(np.int64)) for v in shared_bits(x))
            first = int((ranks[:1] ^ _SIGN).view(np.int64)[0])
            self.blocks.append((segment, node, first, mask, pattern, x.tobytes()))

    def batches(self) -> Iterator[pa.RecordBatch]:
        if self.links:
            a, b = np.concatenate(self.links, axis=1)
            rest = [pa.nulls(len(a), f.type) for f in list(_OUT)[2:]]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *rest], schema=_OUT)
        if self.blocks:
            n = len(self.blocks)
            columns = [pa.array(c, f.type) for c, f in zip(zip(*self.blocks), list(_OUT)[2:])]
            nulls = [pa.nulls(n, pa.int64())] * 2
            yield pa.RecordBatch.from_arrays([*nulls, *columns], schema=_OUT)
        self.links, self.blocks = [], []


def _build(layout: Layout, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the sorted ranks of a part into nodes and blocks; links within blocks, and the
    blocks that have others of their node."""
    out = _Writer(layout)
    prefixes = np.array([layout.prefix(i) for i in range(len(layout.tables))], np.uint64)
    now: tuple[int, int] | None = None
    held, outer = np.empty(0, np.uint64), True

    for batch in batches:
        segments = batch.column(0).to_numpy()
        ranks = batch.column(1).to_numpy().view(np.uint64) ^ _SIGN
        widths = prefixes[segments]
        nodes = (ranks >> (np.uint64(64) - widths)).astype(np.int64)
        starts = np.flatnonzero(
            np.concatenate([[True], (nodes[1:] != nodes[:-1]) | (segments[1:] != segments[:-1])])
        )
        for begin, end in zip(starts, [*starts[1:], len(nodes)]):
            key = int(segments[begin]), int(nodes[begin])
            if key != now:
                if now is not None:
                    out.add(held, *now, outer)
                    # Only the first and the last node of a part can go on in others.
                    outer = False
                now, held = key, held[:0]
            held = np.concatenate([held, ranks[begin:end]])
            while len(held) > BLOCK:
                outer = True
                out.add(held[:BLOCK], *now, True)
                held = held[BLOCK:]
        yield from out.batches()
    if now is not None:
        out.add(held, *now, True)
    yield from out.batches()


def _compare(layout: Layout, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for segment, left, right in zip(*(c.to_pylist() for c in batch.columns)):
            x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
            a, b = block_links(x, y)
            if len(a):
                a, b = chained(a, b + len(x), len(x) + len(y))
                both = _moved_back(np.concatenate([x, y]), layout, segment)
                found.append(np.stack([both[a], both[b]]))
        a, b = np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def fingerprint_links(distinct: DataFrame, layout: Layout | None = None) -> DataFrame:
    """Links (``a``, ``b``) between the distinct fingerprints of column ``fp`` that connect
    all those at most ``RADIUS`` bits apart, directly or through others as near."""
    layout = layout or layout_for(distinct.count())
    tables = [
        F.struct(F.lit(table).alias("segment"), _moved(F.col("fp"), layout, table).alias("moved"))
        for table in range(len(layout.tables))
    ]
    # The rank names its bits many times over; they are a column by then.
    moved = distinct.select(F.inline(F.array(*tables)))
    ranks = moved.select("segment", _gray_rank(F.col("moved")).alias("rank"))
    ordered = ranks.repartitionByRange("segment", "rank").sortWithinPartitions("segment", "rank")
    index = stored(ordered.mapInArrow(partial(_build, layout), _OUT_SQL), "index")
    blocks = index.where("data IS NOT NULL").drop("a", "b")
    left = blocks.select(*[F.col(c).alias(f"l_{c}") for c in blocks.columns])
    apart = F.bit_count(
        F.col("pattern").bitwiseXOR(F.col("l_pattern"))
        .bitwiseAND(F.col("mask")).bitwiseAND(F.col("l_mask"))
    )
    pairs = left.join(
        blocks,
        (F.col("l_segment") == F.col("segment"))
        & (F.col("l_node") == F.col("node"))
        & (F.col("l_block") < F.col("block"))
        & (apart <= RADIUS),
    ).select("segment", "l_data", "data")
    width = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    across = pairs.repartition(width).mapInArrow(partial(_compare, layout), "a bigint, b bigint")
    return index.where("a IS NOT NULL").select("a", "b").union(across)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, seed: int = 42
) -> DataFrame:
    """Per document ``doc_id, fingerprint, component_id``: 16 hexadecimal digits, and the
    smallest id that links of at most ``RADIUS`` bits lead to, its own included.

    Null and wordless texts have fingerprint 0 and link like any other. Rows that repeat an
    id each follow their own text. A row without an id has its fingerprint, no component,
    and links nothing. Other columns are not looked at; an empty table gives no rows.
    """
    return _with_components(docs, id_col, text_col, words, seed).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _with_components(docs: DataFrame, id_col: str, text_col: str, words: int = 4, seed: int = 42) -> DataFrame:
    hashed = stored(fingerprints(docs, id_col, text_col, words, seed), "fingerprints")
    known = hashed.where("doc_id IS NOT NULL")
    # From here on, a fingerprint goes by the smallest id that has it.
    first = stored(
        known.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct_fingerprints"
    )
    links = stored(fingerprint_links(first), "fingerprint_links")
    named = links
    for end in ("a", "b"):
        own = first.select(F.col("fp").alias("own_fp"), F.col("first_id").alias(f"id_{end}"))
        named = named.join(own, F.col(end) == F.col("own_fp")).drop("own_fp")
    components = connected_components(named.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")))
    by_fp = first.join(components, F.col("first_id") == F.col("node"), "left").select(
        F.col("fp").alias("of_fp"), F.coalesce("component", "first_id").alias("component_id")
    )
    joined = hashed.join(by_fp, F.col("fp") == F.col("of_fp"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return joined.select("doc_id", "text_key", "fp", component.alias("component_id"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kwargs) -> DataFrame:
    """The documents that name their group, all columns as they were. Documents without an
    id stay; rows that repeat an id and a text are that document, and stay or go together."""
    found = _with_components(docs, id_col, text_col, **kwargs)
    # Stored, so that Spark knows how many there are when it chooses the join.
    gone = stored(
        found.where("doc_id <> component_id").select("doc_id", "text_key").distinct(), "copies"
    )
    same = (docs[id_col].cast("bigint") == gone["doc_id"]) & (text_key(docs[text_col]) == gone["text_key"])
    return docs.join(gone, same, "left_anti")
