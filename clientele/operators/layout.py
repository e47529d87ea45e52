"""Partition layout, mostly for the number and size of written files."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from typing import Union

from pyspark.sql import DataFrame

from clientele.operators.plan_text import keeps_whole_files

Layout = Union[None, int, str]


def arrange(df: DataFrame, layout: Layout = None) -> DataFrame:
    """Lay a frame out for writing.

    ``None``
        Leave it. A scan and projection then writes straight from the scan
        tasks, with no shuffle; the best choice for large tables.
    ``"compact"``
        As few partitions as the session's advisory partition size allows:
        one for a small table, many for a large one. Rows are dealt over
        ``spark.sql.shuffle.partitions`` partitions, and adaptive execution
        merges or splits those; it must be on.
    ``n`` (2 or more)
        Exactly ``n`` partitions of equal row count, by a full shuffle.
    """
    if layout is None:
        return df
    if layout == "compact":
        if df.sparkSession.conf.get("spark.sql.adaptive.enabled").lower() != "true":
            raise ValueError("layout='compact' needs spark.sql.adaptive.enabled.")
        return df.hint("rebalance")
    if isinstance(layout, bool) or not isinstance(layout, int) or layout < 2:
        # One partition would pass the whole table through one task.
        raise ValueError(f"layout must be None, 'compact' or a number from 2 up, not {layout!r}.")
    return df.repartition(layout)


@contextlib.contextmanager
def laid_out(df: DataFrame, layout: Layout = None) -> Iterator[DataFrame]:
    """The frame to write while the context lasts.

    As ``arrange`` has it, but that a ``"compact"`` projection of whole files is not
    shuffled. Its scan is split by the advisory partition size instead, small files
    together, so that each task writes one file of about that size.
    """
    arranged = arrange(df, layout)
    if layout != "compact" or not keeps_whole_files(df):
        yield arranged
        return
    conf = df.sparkSession.conf
    splits = {
        "spark.sql.files.maxPartitionBytes": conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"),
        "spark.sql.files.minPartitionNum": "1",
        "spark.sql.files.openCostInBytes": "4096",
    }
    before = {name: conf.get(name, None) for name in splits}
    for name, value in splits.items():
        conf.set(name, value)
    try:
        yield df
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)
