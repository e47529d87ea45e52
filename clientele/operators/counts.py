"""Row counts, as one-row frames: each task counts its own rows and sends on
a single number per counter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_rows(df: DataFrame, name: str = "n_rows") -> DataFrame:
    """The number of rows."""
    return df.agg(F.count("*").alias(name))


def count_where(df: DataFrame, **conditions: Column | str) -> DataFrame:
    """For each named condition (a column or SQL text) the number of rows that
    meet it, all in one scan."""
    exprs = {n: F.expr(c) if isinstance(c, str) else c for n, c in conditions.items()}
    return df.agg(*(F.count_if(c).alias(n) for n, c in exprs.items()))
