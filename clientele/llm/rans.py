"""Token ids in files coded with a static range asymmetric numeral system.

A corpus is a folder with two tables:

``frequencies`` (token, freq)
    The frequency table that all blocks share; ``freq`` sums to ``2 ** scale_bits``.
``segments`` (part, first_token, n_tokens, scale_bits, doc_ids, sizes, data)
    Runs of whole documents in ascending order of id. ``data`` holds the ids as independent
    blocks of ``BLOCK`` tokens. A block's tokens are dealt in turn to ``LANES`` coders whose
    words are interleaved. In front of the words there is for each block where its words
    begin, the CRC-32 of its ids, and the state of each lane to start from: a checkpoint,
    from which any block can be decoded without the others.

The coder keeps 64-bit states of at least ``2 ** 31`` and moves 32-bit words (Duda 2013);
all lanes of all blocks of a segment take a step at once.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clientele.llm.scratch import stored
from clientele.llm.tokens import END_ID, encoder

BLOCK, LANES = 16384, 32
#: Tokens after which a segment ends with the document, and tokens for one output part.
SEGMENT, PART = 1 << 20, 8_000_000
#: Rows of the parts' sizes that are broadcast, at most.
BROADCAST_ROWS = 200_000
_LOW = np.uint64(1 << 31)
_HEAD = struct.Struct("<4sQIII")
_SEGMENTS = pa.schema(
    [
        ("part", pa.int32()),
        ("first_token", pa.int64()),
        ("n_tokens", pa.int64()),
        ("scale_bits", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int64())),
        ("data", pa.binary()),
    ]
)
_READ = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)


class Frequencies:
    """A frequency table scaled to a power of two; every token that occurs keeps a share."""

    def __init__(self, tokens: np.ndarray, freq: np.ndarray, scale_bits: int):
        self.scale_bits = scale_bits
        self.tokens, self.small = tokens.astype(np.int64), freq.astype(np.int64)
        width = int(tokens.max()) + 1 if len(tokens) else 1
        self.freq = np.zeros(width, np.uint64)
        self.freq[self.tokens] = self.small
        self.begin = np.cumsum(self.freq, dtype=np.uint64) - self.freq
        self._slots: np.ndarray | None = None

    @classmethod
    def from_counts(cls, tokens: np.ndarray, counts: np.ndarray) -> Frequencies:
        order = np.argsort(tokens)
        tokens, counts = tokens[order], counts[order].astype(object)
        bits = max(16, int(len(tokens)).bit_length() + 4)
        total = int(counts.sum()) or 1
        freq = np.array([max(1, int(c) * (1 << bits) // total) for c in counts], dtype=np.int64)
        # What rounding left over or took too much goes to the most frequent ones.
        over = int(freq.sum()) - (1 << bits)
        for i in np.argsort(-freq, kind="stable"):
            if len(freq) and over:
                step = min(over, int(freq[i]) - 1) if over > 0 else over
                freq[i] -= step
                over -= step
        return cls(tokens, freq, bits)

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(self.tokens, self.small).astype(np.uint32)
        return self._slots


def encode_blocks(ids: np.ndarray, table: Frequencies) -> bytes:
    """The ids as a header, the blocks' checkpoints and their words."""
    n = len(ids)
    steps = -(-min(n, BLOCK) // LANES)
    size = steps * LANES
    n_blocks = -(-n // size) if n else 0
    if not n:
        return _HEAD.pack(b"RNS1", 0, 0, LANES, 0)
    padded = np.full(n_blocks * size, table.tokens[int(table.small.argmax())], dtype=np.int64)
    padded[:n] = ids
    symbols = padded.reshape(n_blocks, steps, LANES)
    freq, begin = table.freq[symbols], table.begin[symbols]
    bits, word = np.uint64(table.scale_bits), np.uint64(32)
    limit = freq << np.uint64(63 - table.scale_bits)
    state = np.full((n_blocks, LANES), _LOW, dtype=np.uint64)
    words = np.empty((n_blocks, steps, LANES), dtype=np.uint32)
    sent = np.empty((n_blocks, steps, LANES), dtype=bool)
    for t in range(steps - 1, -1, -1):
        full = state >= limit[:, t]
        sent[:, t], words[:, t] = full, state.astype(np.uint32)
        state = np.where(full, state >> word, state)
        f = freq[:, t]
        whole = state // f
        state = (whole << bits) + (state - whole * f) + begin[:, t]
    stream = words[sent]
    n_words = sent.sum(axis=(1, 2), dtype=np.int64)
    crc = [zlib.crc32(ids[i : i + size].astype("<u4").tobytes()) for i in range(0, n, size)]
    return b"".join(
        [
            _HEAD.pack(b"RNS1", n, size, LANES, table.scale_bits),
            (np.cumsum(n_words) - n_words).astype("<u4").tobytes(),
            np.array(crc, dtype="<u4").tobytes(),
            state.astype("<u8").tobytes(),
            stream.astype("<u4").tobytes(),
        ]
    )


def decode_blocks(data: bytes, table: Frequencies, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of the blocks from ``first`` up to ``last``; raises if a checksum differs."""
    magic, n, size, lanes, scale_bits = _HEAD.unpack_from(data)
    if magic != b"RNS1" or n and scale_bits != table.scale_bits:
        raise ValueError("This is no data of this format and frequency table.")
    if not n:
        return np.empty(0, np.uint32)
    n_blocks, steps = -(-n // size), size // lanes
    last = n_blocks if last is None else last
    at = _HEAD.size
    starts = np.frombuffer(data, "<u4", n_blocks, at)[first:last].astype(np.int64)
    crc = np.frombuffer(data, "<u4", n_blocks, at + 4 * n_blocks)[first:last]
    states = np.frombuffer(data, "<u8", n_blocks * lanes, at + 8 * n_blocks)
    stream = np.frombuffer(data, "<u4", offset=at + 8 * n_blocks * (1 + lanes)).astype(np.uint64)
    state = states.reshape(n_blocks, lanes)[first:last].astype(np.uint64)
    stream = np.concatenate([stream, np.zeros(1, np.uint64)])
    next_word = starts.reshape(-1, 1)
    mask, bits, word = np.uint64((1 << scale_bits) - 1), np.uint64(scale_bits), np.uint64(32)
    out = np.empty((len(state), steps, lanes), dtype=np.uint32)
    for t in range(steps):
        slot = state & mask
        symbol = table.slots[slot]
        out[:, t] = symbol
        state = table.freq[symbol] * (state >> bits) + slot - table.begin[symbol]
        low = state < _LOW
        took = np.cumsum(low, axis=1)
        where = np.where(low, next_word + took - 1, len(stream) - 1)
        state = np.where(low, (state << word) | stream[where], state)
        next_word = next_word + took[:, -1:]
    ids = out.reshape(-1)[: n - first * size]
    for i, expected in enumerate(crc.tolist()):
        if zlib.crc32(ids[i * size : (i + 1) * size].astype("<u4").tobytes()) != expected:
            raise ValueError(f"The checksum of block {first + i} differs.")
    return ids


def encode_documents(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "word_bpe_49k.json",
    words: bool = True,
) -> None:
    """Write the token ids of all documents, each with the end id, to a new corpus at ``path``.

    Documents come in ascending order of id, those without an id last; documents with one id
    in an order that depends on their ids. A null text is an empty one, so it holds the end id
    alone. Other columns are not looked at. An empty table gives an empty corpus.
    """

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, end = encoder(vocabulary, words), np.array([END_ID], dtype="<u4")
        for batch in batches:
            ids = [np.concatenate([x, end]) for x in tool.encode(batch.column(1))]
            small = [x.astype("<u2").tobytes() if x.max() < 65536 else x.tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(map(len, ids)), pa.int64()), pa.array(small, pa.binary())],
                ["doc_id", "n", "ids"],
            )
        pa.default_memory_pool().release_unused()

    spark = docs.sparkSession
    chosen = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    coded = stored(chosen.mapInArrow(tokenise, "doc_id bigint, n bigint, ids binary"), "tokens")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            ids = np.concatenate([np.zeros(0, "<u2"), *_ids(batch)])
            found = np.bincount(ids, minlength=len(total))
            found[: len(total)] += total
            total = found
        tokens = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(total[tokens])], ["token", "n"])

    # No more rows than the vocabulary has tokens reach the driver.
    counts = coded.mapInArrow(count, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    rows = counts.collect()
    table = Frequencies.from_counts(
        np.array([r["token"] for r in rows], dtype=np.int64), np.array([r["n"] for r in rows], dtype=object)
    )
    bits = table.scale_bits
    spark.createDataFrame(
        [(int(t), int(f)) for t, f in zip(table.tokens, table.small)], "token bigint, freq bigint"
    ).coalesce(1).write.parquet(f"{path}/frequencies")
    shared = spark.sparkContext.broadcast((table.tokens, table.small, bits))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first = TaskContext.get().partitionId(), 0
        own = Frequencies(*shared.value)
        doc_ids: list[int | None] = []
        held: list[np.ndarray] = []

        def segment() -> pa.RecordBatch:
            nonlocal first
            ids = np.concatenate(held)
            row = part, first, len(ids), bits, list(doc_ids), list(map(len, held)), encode_blocks(ids, own)
            first += len(ids)
            doc_ids.clear()
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([x], f.type) for x, f in zip(row, _SEGMENTS)], schema=_SEGMENTS
            )

        size = 0
        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), _ids(batch)):
                doc_ids.append(doc_id)
                held.append(ids)
                size += len(ids)
                if size >= SEGMENT:
                    yield segment()
                    size = 0
        if held:
            yield segment()

    parts = max(1, -(-sum(r["n"] for r in rows) // PART))
    # The hash only orders rows of one id; the ids themselves would weigh down the sort.
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("ids")]
    ordered = coded.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ordered.mapInArrow(
        encode,
        "part int, first_token bigint, n_tokens bigint, scale_bits int,"
        " doc_ids array<bigint>, sizes array<bigint>, data binary",
    ).write.option("compression", "uncompressed").parquet(f"{path}/segments")


def read_documents(spark: SparkSession, path: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Per document of a corpus: its id, the number of ids before it, its own number of ids,
    and their CRC-32, all from the decoded and checked blocks."""
    rows = spark.read.parquet(f"{path}/frequencies").collect()
    segments = spark.read.parquet(f"{path}/segments")
    # One row for each 8 million tokens, so that one task can sort them. Up to ``broadcast_rows``
    # they are broadcast, and segments stay where they are; more are joined by part.
    by_part = stored(segments.groupBy("part").agg(F.sum("n_tokens").alias("n")), "parts")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    table = sorted((r["token"], r["freq"]) for r in rows)
    tokens, freq = (np.array(x, dtype=np.int64) for x in (zip(*table) if table else ((), ())))
    bits = max(int(freq.sum()).bit_length() - 1, 0)
    shared = spark.sparkContext.broadcast((tokens, freq, bits))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Frequencies(*shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_blocks(row["data"], own).astype("<u4")
                ends = np.cumsum(row["sizes"])
                starts = ends - row["sizes"]
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]
                columns = row["doc_ids"], starts + row["start"], row["sizes"], crc
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], schema=_READ
                )

    before = F.broadcast(before) if by_part.count() <= broadcast_rows else before.hint("merge")
    placed = segments.join(before, "part").select(
        (F.col("before") + F.col("first_token")).alias("start"), "doc_ids", "sizes", "data"
    )
    return placed.mapInArrow(decode, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _ids(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for n, data in zip(batch.column("n").to_pylist(), batch.column("ids").to_pylist()):
        yield np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4")
