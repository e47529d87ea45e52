"""Frame comparison, ignoring row and column order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.operators.naming import free_name


def frame_diff(left: DataFrame, right: DataFrame, digests: int | None = None) -> DataFrame:
    """The rows by which two frames differ as multisets, columns in name order.

    Adds ``side`` (``left`` or ``right``, where the surplus is) and ``copies``
    (how many more). Nulls equal nulls. Holds what ``exceptAll`` in both
    directions would, from one scan of each side and one shuffle: left rows
    weigh +1 and right rows -1, and equal rows are summed up per task before
    they move, so that many copies of one row travel as a few partial sums
    and are never written out again one by one.

    ``digests`` is for frames that are nearly equal. Rows fall into that many
    buckets by their hash, each side's buckets are summed up to digests of 128
    bits, and only rows of buckets that differ are shuffled. Both sides are
    scanned twice, and rows with a map column cannot be hashed.

    Types have to agree, but a number may have another width on the other side.
    """
    names = sorted(left.columns)
    if names != sorted(right.columns):
        raise ValueError(f"Column names differ: {names} and {sorted(right.columns)}.")
    if unlike := _unlike_types(left, right):
        raise ValueError(f"Column types differ: {unlike}.")
    if {"side", "copies"} & {name.lower() for name in names}:
        raise ValueError("The names 'side' and 'copies' are taken by the result.")
    columns = [F.col(f"`{name}`") for name in names]  # names may hold dots
    if digests is not None:
        left, right = _unlike_buckets(left, right, names, digests)
    weight = free_name("__weight", left)
    plus, minus = (F.lit(n).cast("bigint").alias(weight) for n in (1, -1))
    weighed = left.select(*columns, plus).unionByName(right.select(*columns, minus))
    surplus = weighed.groupBy(*columns).agg(F.sum(weight).alias(weight))
    return surplus.where(F.col(weight) != 0).select(
        *columns,
        F.when(F.col(weight) > 0, "left").otherwise("right").alias("side"),
        F.abs(weight).alias("copies"),
    )


def frames_equal(left: DataFrame, right: DataFrame) -> bool:
    """Whether two frames hold the same columns and the same rows. Columns of different
    types make frames unequal, unless both are numbers."""
    if sorted(left.columns) != sorted(right.columns) or _unlike_types(left, right):
        return False
    return frame_diff(left, right).isEmpty()


def bucket_digests(df: DataFrame, buckets: int, schema: T.StructType | None = None) -> DataFrame:
    """``bucket, digest``: rows in buckets by the hash of all their columns, each bucket with
    its number of rows and the sums of the halves of two hashes, which no order of rows
    changes. ``schema`` gives the types to hash columns as, and their order."""
    halves = [
        F.sum(half).alias(f"s{i}")
        for i, half in enumerate(
            part
            for h in ("h1", "h2")
            for part in (F.shiftright(h, 32), F.col(h).bitwiseAND(0xFFFFFFFF))
        )
    ]
    hashed = df.select(*_hashes(schema or df.schema))
    summed = hashed.groupBy(F.pmod("h1", F.lit(buckets)).alias("bucket")).agg(F.count("*").alias("n"), *halves)
    return summed.select("bucket", F.struct("n", "s0", "s1", "s2", "s3").alias("digest"))


def _hashes(schema: T.StructType) -> list[Column]:
    columns = [F.col(f"`{f.name}`").cast(f.dataType) for f in schema.fields]
    # The second hash starts from another seed.
    return [F.xxhash64(*columns).alias("h1"), F.xxhash64(F.lit("h2"), *columns).alias("h2")]


def _unlike_buckets(
    left: DataFrame, right: DataFrame, names: list[str], buckets: int
) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides whose buckets have different digests."""
    if buckets < 1:
        raise ValueError("digests must be 1 or more.")
    quoted = [F.col(f"`{name}`") for name in names]
    left, right = left.select(*quoted), right.select(*quoted)
    # Equal numbers of different widths have to get one hash.
    schema = left.unionByName(right).schema
    ours, theirs = (bucket_digests(df, buckets, schema) for df in (left, right))
    ours, theirs = ours.withColumnRenamed("digest", "ours"), theirs.withColumnRenamed("digest", "theirs")
    unlike = ours.join(theirs, "bucket", "full").where(~F.col("ours").eqNullSafe(F.col("theirs")))
    bucket = free_name("__bucket", left)
    # As many rows as there are buckets, at most.
    unlike = F.broadcast(unlike.select(F.col("bucket").alias(bucket)))
    number = F.pmod(_hashes(schema)[0], F.lit(buckets))
    return tuple(
        df.withColumn(bucket, number).join(unlike, bucket, "left_semi").drop(bucket) for df in (left, right)
    )


def _unlike_types(left: DataFrame, right: DataFrame) -> list[str]:
    theirs = {f.name: f.dataType for f in right.schema.fields}
    return [f.name for f in left.schema.fields if not _alike(f.dataType, theirs[f.name])]


def _alike(a: T.DataType, b: T.DataType) -> bool:
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return True
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return _alike(a.elementType, b.elementType)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return a.names == b.names and all(
            _alike(x.dataType, y.dataType) for x, y in zip(a.fields, b.fields)
        )
    return type(a) is type(b)
