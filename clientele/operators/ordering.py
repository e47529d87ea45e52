"""Ordering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.operators.naming import free_name, row_hash


#: Rows looked at for each partition of the sort, and at most.
_SAMPLED, _MOST_SAMPLED = 20, 100_000


def sort_rows(df: DataFrame, *keys: Column | str, cut_ties: bool | None = None) -> DataFrame:
    """The frame in order of ``keys``, or of all its columns; nulls first.

    A range partitioner cannot cut between rows with equal keys, so a key that
    holds much of the data would land in one task. Such ties are therefore
    ordered by a hash of the row and its partition, which lets Spark cut inside a
    tie, copies of one row included, and does not change the order of the keys.

    That column costs time, so by default a sample of the keys decides: ties are
    cut if one key has more of its rows than a partition of the sort should get.
    It takes a count and a scan of the key columns. ``cut_ties`` says so at once.
    """
    order = keys or tuple(F.col(f"`{c}`") for c in df.columns)
    if cut_ties is None:
        cut_ties = _has_heavy_key(df, order)
    if not cut_ties:
        return df.orderBy(*order)
    tie = free_name("__tie", df)
    # Partitions are ranges of key and tie; within them the order of the keys is enough.
    return df.withColumn(tie, row_hash(df)).repartitionByRange(*order, tie).sortWithinPartitions(*order).drop(tie)


def _has_heavy_key(df: DataFrame, order: tuple[Column | str, ...]) -> bool:
    """Whether a key has more than its share of a sample: twice what a partition holds if all
    are equal."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = min(_SAMPLED * parts + 1000, _MOST_SAMPLED)
    total = df.count()
    if total <= size:
        return False  # one task can hold it
    # A sample of bounded size, so that its ranks may come from one task.
    some = df.sample(min(1.0, 1.5 * size / total), seed=1).limit(2 * size)
    rank = free_name("__rank", df)
    ranks = some.withColumn(rank, F.rank().over(Window.orderBy(*order)))
    counts = ranks.groupBy(rank).agg(F.count("*").alias("n"))
    most, seen = counts.agg(F.max("n"), F.sum("n")).first()
    return bool(seen) and most > max(2 * seen / parts, 20)


def first_row(df: DataFrame, *keys: Column | str) -> DataFrame:
    """The first row in order of ``keys``. Each task keeps one row, so this
    needs no sort of the frame."""
    return df.orderBy(*keys).limit(1)
