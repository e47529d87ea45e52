"""Names for helper columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def free_name(base: str, *frames: DataFrame) -> str:
    """``base``, with as many underscores behind it as it takes to be no column's name."""
    taken = {c.lower() for df in frames for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    return isinstance(kind, T.StructType) and any(_holds_map(f.dataType) for f in kind.fields)


def row_hash(df: DataFrame) -> Column:
    """A hash of the row and of the partition it is in, so that equal rows differ, too. It
    comes out the same when a lost task is run again, unlike a random number."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not _holds_map(f.dataType)]
    return F.xxhash64(F.spark_partition_id(), *plain)
