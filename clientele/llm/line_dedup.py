"""Removal of lines that occur in several documents, by sorted line hashes.

1. Each document gives one row per distinct line key: the key's 128-bit hash, the document,
   and the positions of its lines, without the texts.
2. The rows are range-partitioned by hash, then document, and sorted; a key that very many
   documents hold is cut between documents. Each task streams its rows and passes on all
   but the first document of a key. The key that a part begins with may have begun in the
   part before; its rows are settled with the first rows of all parts.
3. The positions that were passed on become one compressed bitmap per document. Only whoever
   asks for texts joins them with these, which shuffles the texts once if there are many.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.arrow import slices
from clientele.llm.scratch import stored, text_key

MIN_CHARS = 10
_WHITE = b" \t\n\x0b\x0c\r"
_LINES = pa.schema(
    [("hash", pa.binary()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("positions", pa.binary())]
)


def _line_rows(docs: DataFrame, min_chars: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in slices(batches):
            out: list[tuple] = []
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            for doc_id, own, text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts
            ):
                found: dict[bytes, list[int]] = {}
                for at, line in enumerate(text.split(b"\n")):
                    key = line.strip(_WHITE).lower()
                    n = len(key)
                    if n >= 4 * min_chars or n >= min_chars and len(key.decode()) >= min_chars:
                        found.setdefault(digest(key), []).append(at)
                for key, at in found.items():
                    out.append((key, doc_id, own, np.array(at, dtype="<u4").tobytes()))
            columns = list(zip(*out)) or [()] * len(_LINES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _LINES)], schema=_LINES
            )

    return docs.mapInArrow(rows, "hash binary, doc_id bigint, text_key bigint, positions binary")


#: Rows that go, rows of the key that a part begins with, and first documents at a part's ends.
_GOES, _OPEN, _EDGE = 0, 1, 2


def _later_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of all but a key's first document. Of the key that the part begins with, all
    rows come; for that key and the one that the part ends with, also its first document."""
    key = first_doc = last = None
    opening = True
    for batch in batches:
        keep, kinds, edges = [], [], []
        columns = [batch.column(name).to_pylist() for name in ("hash", "doc_id", "text_key")]
        for i, row in enumerate(zip(*columns)):
            if row[0] != key:
                opening = key is None
                key, first_doc = row[:2]
                if opening:
                    edges.append((key, first_doc))
            elif row == last:
                continue  # a repeated row
            if opening or row[1] != first_doc:
                keep.append(i)
                kinds.append(_OPEN if opening else _GOES)
            last = row
        took = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), *took.columns], _KIND_NAMES)
        yield _edges(edges)
    if key is not None:
        yield _edges([(key, first_doc)])


_KIND_NAMES = ["kind", *_LINES.names]
_KIND_SCHEMA = "kind int, hash binary, doc_id bigint, text_key bigint, positions binary"


def _edges(found: list[tuple[bytes, int | None]]) -> pa.RecordBatch:
    n = len(found)
    columns = [_EDGE] * n, [x[0] for x in found], [x[1] for x in found], [None] * n, [None] * n
    types = pa.int32(), *(f.type for f in _LINES)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], _KIND_NAMES
    )


def line_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS
) -> DataFrame:
    """One row for each document that loses lines: ``doc_id, text_key, n_dropped, keep``.

    ``keep`` is a zlib-compressed bitmap of the lines, least significant bit first, up to
    the last that goes; a cleared bit drops the line. A line goes if its key has at least
    ``min_chars`` code points and a document with a smaller id holds it. Rows without an id
    are one document that comes last; rows that repeat an id are that one document, and
    those among them that repeat the text, too, share one bitmap. A null text is one empty
    line. Other columns are not looked at.
    """
    own = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        text_key(F.col(text_col)).alias("text_key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    lines = stored(_line_rows(own, min_chars), "lines")
    order = [F.col("hash"), F.col("doc_id").asc_nulls_last(), F.col("text_key")]
    ordered = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    later = stored(ordered.mapInArrow(_later_rows, _KIND_SCHEMA), "later_lines")
    # Two rows for each part at most, so they can be broadcast.
    firsts = (
        later.where(F.col("kind") == _EDGE)
        .groupBy(F.col("hash").alias("edge_hash"))
        .agg(F.min("doc_id").alias("first_doc"))
    )
    settled = later.where(F.col("kind") == _OPEN).join(
        F.broadcast(firsts),
        (F.col("hash") == F.col("edge_hash")) & ~F.col("doc_id").eqNullSafe(F.col("first_doc")),
    )
    names = ["doc_id", "text_key", "positions"]
    goes = later.where(F.col("kind") == _GOES).select(*names).union(settled.select(*names))
    by_doc = goes.groupBy("doc_id", "text_key").agg(F.collect_list("positions").alias("positions"))
    return by_doc.mapInArrow(_bitmaps, "doc_id bigint, text_key bigint, n_dropped bigint, keep binary")


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, maps = [], []
        for parts in batch.column("positions").to_pylist():
            gone = np.unique(np.frombuffer(b"".join(parts), "<u4"))
            bits = np.ones(int(gone[-1]) // 8 * 8 + 8, dtype=bool)
            bits[gone] = False
            counts.append(len(gone))
            maps.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(maps, pa.binary())],
            ["doc_id", "text_key", "n_dropped", "keep"],
        )


def kept_lines(text: str | None, keep: bytes | None) -> list[str]:
    """The lines of a text that its bitmap keeps; without a bitmap, all."""
    lines = (text or "").split("\n")
    if keep is None:
        return lines
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")
    return [x for x, bit in zip(lines, bits[: len(lines)]) if bit] + lines[len(bits) :]


def with_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Each row of ``docs`` as the struct ``row``, with its ``n_dropped`` and ``keep``, which
    are null for documents that lose nothing."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).cast("bigint").alias("own_id"),
        text_key(F.col(text_col)).alias("own_key"),
    )
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_key") == F.col("text_key"))
    return rows.join(bitmaps, same, "left").select("row", "n_dropped", "keep")


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS
) -> DataFrame:
    """The documents without the lines that ``line_bitmaps`` drops, all columns as they were."""
    marked = with_bitmaps(docs, line_bitmaps(docs, id_col, text_col, min_chars), id_col, text_col)

    @F.arrow_udf("string")
    def kept(texts: pa.Array, keeps: pa.Array) -> pa.Array:
        pairs = zip(texts, keeps)  # row by row, so that no batch is there twice
        return pa.array(
            (None if not k.is_valid else "\n".join(kept_lines(t.as_py(), k.as_py())) for t, k in pairs),
            pa.string(),
        )

    text = F.when(F.col("keep").isNull(), F.col(f"row.`{text_col}`")).otherwise(
        kept(F.col(f"row.`{text_col}`"), "keep")
    )
    return marked.select(
        *[text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    )


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``doc_id, n_lines, n_dropped, kept_sha256``, the last over the lines that
    stay, joined by newlines."""
    marked = with_bitmaps(docs, line_bitmaps(docs, id_col, text_col), id_col, text_col)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, sums = [], []
            for text, keep in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                counts.append((text or "").count("\n") + 1)
                kept = "\n".join(kept_lines(text, keep))
                sums.append(hashlib.sha256(kept.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), batch.column(2), pa.array(sums, pa.string())],
                ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    return marked.select(
        F.col(f"row.`{id_col}`").cast("bigint").alias("doc_id"),
        F.col(f"row.`{text_col}`").alias("text"),
        F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
        "keep",
    ).mapInArrow(report, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string")
