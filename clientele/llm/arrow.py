"""Arrow batches in tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

#: Bytes that a task turns into Python objects at once, but for a single longer row.
SLICE_BYTES = 4_000_000


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts that take little memory once they are Python objects; at the end,
    what Arrow holds in reserve goes back to the system, as workers live on."""
    for batch in batches:
        rows = max(1, len(batch) * SLICE_BYTES // max(batch.nbytes, 1))
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()
