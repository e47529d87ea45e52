"""Benchmark items inside documents: MinHash containment search, then exact containment.

A short item inside a long document is nothing like the document as a whole. Items are
therefore partitioned by size (their number of distinct shingles, in powers of two), and
for each size class the documents are read as overlapping windows of twice the class's
largest size, so that the containment sought means a similarity that MinHash finds
(after Zhu et al. 2016, LSH Ensemble). Signatures are one-permutation MinHashes (Li, Owen,
Zhang 2012): the smallest hash in each of ``BINS`` bins. An item is a candidate for a
document if one bin of one window has the item's value.

Items of fewer than ``SHORT`` shingles are a class of their own: too few of their values
would be the smallest of a bin in each window. All their shingles are their signature, and
all shingles of a document are looked up, so that none of these items is missed.

Items' bin values go to the tasks as a Bloom filter of fixed size, so that of the windows
only the values that some item may have are shuffled. So do all their shingles, so that
candidates carry those of the document that some item may have. Candidates are then
confirmed over the whole document: the share of the item's distinct shingles that it has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.arrow import slices
from clientele.llm.scratch import stored, text_key

WORDS, THRESHOLD, BINS = 5, 0.8, 64
#: The smallest class holds items of up to this many shingles; each further class twice as many.
SMALLEST_CLASS = 16
#: Items of fewer shingles are in this class, of which documents are not read in windows.
SHORT, SHORT_CLASS = 8, -1
#: Bits of the Bloom filter: 4 MB, whatever the number of items.
FILTER_BITS = 1 << 25
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: bytes, words: int = WORDS) -> np.ndarray:
    """Hashes of the shingles in order: runs of ``words`` words in lower case (A-Z); a
    shorter text is one shingle, a text without words none."""
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    n = max(len(found) - words + 1, 1)
    shingles = map(b" ".join, zip(*(found[i : i + n] for i in range(min(words, len(found))))))
    return np.fromiter(map(xxhash.xxh3_64_intdigest, shingles), np.uint64, n)


def size_class(size: int) -> int:
    """The class of items of that many distinct shingles."""
    if size < SHORT:
        return SHORT_CLASS
    return max(0, int(np.ceil(np.log2(max(size, 1) / SMALLEST_CLASS))))


def _bin(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * _MIX) >> np.uint64(58)).astype(np.int64)


def _keys(kind: int, hashes: np.ndarray) -> np.ndarray:
    """What item and window must share: the class and the value; the value has the bin."""
    return (hashes ^ np.uint64(kind * 0xD6E8FEB86659FD93 % (1 << 64))).view(np.int64)


def item_keys(hashes: np.ndarray) -> tuple[int, np.ndarray]:
    """The class of an item and its signature's values, at most one for each bin."""
    own = np.unique(hashes)
    kind = size_class(len(own))
    if kind == SHORT_CLASS:
        return kind, own
    bins = _bin(own)
    _, first = np.unique(bins, return_index=True)  # own is sorted: the smallest of a bin
    return kind, own[first]


def window_values(hashes: np.ndarray, kind: int) -> np.ndarray:
    """The distinct signature values of all windows of a document for a size class."""
    if kind == SHORT_CLASS:
        return np.unique(hashes)
    half = SMALLEST_CLASS << kind
    blocks = -(-len(hashes) // half)
    lowest = np.full((blocks + 1, BINS), np.iinfo(np.uint64).max, np.uint64)
    at = np.arange(len(hashes)) // half * BINS + _bin(hashes)
    np.minimum.at(lowest.reshape(-1), at, hashes)
    # A window is a block and the next one.
    return np.unique(np.minimum(lowest[:-1], lowest[1:]))


def _positions(keys: np.ndarray) -> np.ndarray:
    """Three bits of the filter for each key."""
    mixed = keys.view(np.uint64) * _MIX
    shifts = np.array([39, 18, 0], np.uint64)
    return ((mixed[:, None] >> shifts) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def _items(benchmark: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for item_id, text in zip(batch.column(0).to_pylist(), texts):
                hashes = np.unique(shingle_hashes(text or b"", words))
                if item_id is None or not len(hashes):
                    continue
                kind, values = item_keys(hashes)
                out.append((item_id, kind, _keys(kind, values), hashes.view(np.int64)))
            columns = list(zip(*out)) or [()] * 4
            types = pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["item_id", "kind", "keys", "shingles"]
            )

    chosen = benchmark.select(F.col(id_col).cast("bigint"), F.col(text_col))
    return chosen.mapInArrow(rows, "item_id bigint, kind int, keys array<bigint>, shingles array<bigint>")


def _bloom_filter(items: DataFrame, column: str) -> np.ndarray:
    """The filter over all values in the column's lists. Words of it are combined by Spark; its size is fixed."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS // 64, np.uint64)
        for batch in batches:
            at = _positions(batch.column(0).to_numpy()).reshape(-1)
            np.bitwise_or.at(bits, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        used = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(bits[used].view(np.int64))], ["at", "bits"]
        )

    keys = items.select(F.explode(column).alias("key"))
    combined = keys.mapInArrow(words, "at bigint, bits bigint").groupBy("at").agg(
        F.bit_or("bits").alias("bits")
    )
    found = combined.toPandas()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[found["at"].to_numpy()] = found["bits"].to_numpy()
    return out.view(np.uint64)


def _inside(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The keys that the filter may hold."""
    at = _positions(keys)
    found = bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)
    return keys[found.all(axis=1)]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    words: int = WORDS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id, text_key, item_id, n_shared, n_shingles`` of each document and benchmark item
    of which the document has at least ``threshold`` of the distinct shingles.

    Shingles are runs of ``words`` words, A-Z in lower case; a shorter text is one shingle.
    Null and wordless texts have none and match nothing, neither do items without an id; a
    document without an id is reported under a null id. Rows with the same id and text are
    reported once, as are items that repeat an id and a text. Other columns are not looked
    at; an empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    items = stored(_items(benchmark, item_col, item_text_col, words), "items")
    kinds = sorted(r["kind"] for r in items.select("kind").distinct().collect())
    shared = spark.sparkContext.broadcast([_bloom_filter(items, x) for x in ("keys", "shingles")])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some_key, some_shingle = shared.value
        for batch in slices(batches):
            rows, keys, all_shingles = [], [], []
            for i, text in enumerate(batch.column(2).cast(pa.binary()).to_pylist()):
                hashes = shingle_hashes(text or b"", words)
                if not len(hashes):
                    continue
                near = np.concatenate([_keys(k, window_values(hashes, k)) for k in kinds])
                near = _inside(some_key, near)
                if len(near):
                    rows.append(i)
                    keys.append(near)
                    all_shingles.append(np.unique(_inside(some_shingle, hashes.view(np.int64))))
            took = batch.take(pa.array(rows, pa.int64()))
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (keys, all_shingles)]
            yield pa.RecordBatch.from_arrays(
                [took.column(0), took.column(1), *lists], ["doc_id", "text_key", "keys", "shingles"]
            )

    if not kinds:
        search_in = docs.where("false")
    else:
        search_in = docs
    own = search_in.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        text_key(F.col(text_col)).alias("text_key"),
        F.col(text_col),
    )
    found = stored(
        own.mapInArrow(
            search, "doc_id bigint, text_key bigint, keys array<bigint>, shingles array<bigint>"
        ),
        "windows",
    )
    by_key = items.select(F.explode("keys").alias("item_key"), "item_id").distinct()
    candidates = (
        found.select("doc_id", "text_key", F.explode("keys").alias("key"))
        .join(by_key, F.col("key") == F.col("item_key"))
        .select("doc_id", "text_key", "item_id")
        .distinct()
    )
    same = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_key") == F.col("own_key"))
    pairs = (
        candidates.join(
            found.select(
                F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key"), "shingles"
            ).dropDuplicates(["own_id", "own_key"]),
            same,
        )
        .select("doc_id", "text_key", "item_id", "shingles")
        .join(
            items.select(F.col("item_id").alias("of_item"), F.col("shingles").alias("item_shingles")).distinct(),
            F.col("item_id") == F.col("of_item"),
        )
    )
    n_shared = F.size(F.array_intersect("item_shingles", "shingles")).cast("bigint")
    return (
        pairs.select(
            "doc_id",
            "text_key",
            "item_id",
            n_shared.alias("n_shared"),
            F.size("item_shingles").cast("bigint").alias("n_shingles"),
        )
        .where(F.col("n_shared") >= threshold * F.col("n_shingles"))
        .groupBy("doc_id", "text_key", "item_id")
        .agg(F.max_by(F.struct("n_shared", "n_shingles"), F.col("n_shared") / F.col("n_shingles")).alias("best"))
        .select("doc_id", "text_key", "item_id", "best.*")
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kwargs
) -> DataFrame:
    """The documents that hold no benchmark item, all columns as they were."""
    found = contaminated(docs, benchmark, id_col, text_col, **kwargs)
    # Stored, so that Spark knows how many there are when it chooses the join.
    gone = stored(found.select("doc_id", "text_key").distinct(), "contaminated")
    same = docs[id_col].cast("bigint").eqNullSafe(gone["doc_id"]) & (
        text_key(docs[text_col]) == gone["text_key"]
    )
    return docs.join(gone, same, "left_anti")
