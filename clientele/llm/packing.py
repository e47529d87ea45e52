"""Best-fit decreasing packing of token sequences.

Documents of one length can stand in for each other, so what best-fit decreasing does
depends only on how many pieces of each length there are: a histogram of at most
``capacity`` numbers. The plan is made from it, length by length, with a segment tree over
remaining capacities that finds the tightest open bin in logarithmic time; runs of equal
pieces going into equal bins are one step. The rows then look up their place by length
and rank; neither the documents nor the bins go through the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.scratch import stored
from clientele.llm.tokens import END_ID, encoder

CAPACITY = 1024
#: Counts of one length in one part that are broadcast, at most.
BROADCAST_ROWS = 200_000
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_RANKED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("part", pa.int32()),
        ("nth", pa.int64()),
    ]
)
_PLACED = pa.schema([*list(_RANKED)[:5], ("sequence_id", pa.int64()), ("offset", pa.int64())])
_RANK_BITS = 46


class OpenBins:
    """Groups of equal open bins by remaining capacity, under a segment tree whose nodes
    count the groups below them."""

    def __init__(self, capacity: int):
        self._width = 1 << capacity.bit_length()
        self._count = [0] * (2 * self._width)
        self._groups: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _add(self, remaining: int, by: int) -> None:
        node = self._width + remaining
        while node:
            self._count[node] += by
            node >>= 1

    def push(self, remaining: int, first_bin: int, bins: int) -> None:
        if bins and remaining:
            self._groups[remaining].append((first_bin, bins))
            self._add(remaining, 1)

    def pop(self, remaining: int) -> tuple[int, int]:
        self._add(remaining, -1)
        return self._groups[remaining].pop()

    def tightest(self, length: int) -> int | None:
        """The smallest remaining capacity of at least ``length`` with an open bin."""
        node = self._width + length
        if not self._count[node]:
            while node > 1 and (node & 1 or not self._count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self._width:
                node = 2 * node if self._count[2 * node] else 2 * node + 1
        return node - self._width


def best_fit_plan(histogram: Iterable[tuple[int, int]], capacity: int = CAPACITY) -> np.ndarray:
    """Where best-fit decreasing puts the pieces, as rows (length, first rank, first bin,
    pieces per bin, offset in the bin), by length and rank: from that rank on, pieces of
    that length fill one bin after the other. Its size depends on the capacity, not on the
    number of pieces."""
    bins, steps, n_bins = OpenBins(capacity), [], 0
    for length, n in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"A piece of length {length} does not fit into {capacity}.")
        rank = 0
        while rank < n:
            remaining = bins.tightest(length)
            if remaining is None:
                remaining, each = capacity, capacity // length
                first, count = n_bins, -(-(n - rank) // each)
                n_bins += count
            else:
                each = remaining // length
                first, count = bins.pop(remaining)
            full = min(count, (n - rank) // each)
            if full:
                steps.append((length, rank, first, each, capacity - remaining))
                bins.push(remaining - each * length, first, full)
                rank += full * each
            if full < count:
                if rest := min(each - 1, n - rank):
                    steps.append((length, rank, first + full, rest, capacity - remaining))
                    bins.push(remaining - rest * length, first + full, 1)
                    rank += rest
                    full += 1
                bins.push(remaining, first + full, count - full)
    return np.array(sorted(steps), dtype=np.int64).reshape(-1, 5)


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "byte_bpe_50k.json",
    words: bool = False,
    capacity: int = CAPACITY,
) -> DataFrame:
    """The token pieces of each document, stored, with the number of earlier pieces of the
    same length in the same stored part."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        tool, end = encoder(vocabulary, words), np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            rows: list[tuple[int, ...]] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), tool.encode(batch.column(1))):
                data, n = ids.tobytes() + end, len(ids) + 1
                at, length = 0, n % capacity or capacity
                piece = 0
                while at < n:
                    crc = zlib.crc32(data[4 * at : 4 * (at + length)])
                    rows.append((doc_id, piece, at, length, crc, part, seen[length]))
                    seen[length] += 1
                    at, piece, length = at + length, piece + 1, capacity
            columns = list(zip(*rows)) or [()] * len(_RANKED)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _RANKED)], schema=_RANKED
            )
        pa.default_memory_pool().release_unused()

    chosen = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")
    )
    return stored(chosen.mapInArrow(cut, f"{PIECES}, part int, nth bigint"), "pieces")


def pack(pieces: DataFrame, capacity: int = CAPACITY, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Place the pieces of ``token_pieces`` in sequences of at most ``capacity`` tokens.

    Up to ``broadcast_rows`` counts of a length in a part are broadcast, so that pieces do
    not move; more are joined by a sort of the pieces by length and part.
    """
    by_part = pieces.groupBy("length", "part").count()
    by_part = stored(by_part, "lengths")
    histogram = by_part.groupBy("length").agg(F.sum("count").alias("n"), F.count("*").alias("parts")).collect()
    plan = best_fit_plan([(r["length"], r["n"]) for r in histogram], capacity)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select(
        F.col("length").alias("of_length"),
        F.col("part").alias("of_part"),
        F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"),
    )
    # The counts are known by now, so the join need not go by the size of a compressed file.
    few = sum(r["parts"] for r in histogram) <= broadcast_rows
    before = F.broadcast(before) if few else before.hint("merge")
    joined = pieces.join(
        before, (F.col("length") == F.col("of_length")) & (F.col("part") == F.col("of_part"))
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = (plan[:, 0] << _RANK_BITS) | plan[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            step = plan[np.searchsorted(keys, (length << _RANK_BITS) | rank, "right") - 1]
            nth, each = rank - step[:, 1], step[:, 3]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:5],
                    pa.array(step[:, 2] + nth // each),
                    pa.array(step[:, 4] + nth % each * length),
                ],
                schema=_PLACED,
            )

    ranked = joined.select(*_RANKED.names[:5], (F.col("before") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(place, f"{PIECES}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kwargs) -> DataFrame:
    """Pack all documents: one row per piece with its sequence and its place there.

    A document is its token ids and the end id. Only longer ones than the capacity are
    cut, into full pieces after a first one that may be shorter. A null text is an empty
    text and gives a piece with the end id alone; a null id stays null; repeated rows are
    packed each; other columns are not looked at; an empty table gives no rows.
    """
    capacity = kwargs.get("capacity", CAPACITY)
    return pack(token_pieces(docs, id_col, text_col, **kwargs), capacity)
