"""Catalog scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    name: str,
    schema: str | None = None,
    max_partitions: int | None = None,
) -> DataFrame:
    """Scan a catalog table, named in full or as ``schema`` and ``name``.

    ``max_partitions`` merges scan partitions down to that many, with no
    shuffle. It also caps how many tasks scan and project, so leave it unset
    for large tables and size scan tasks by ``spark.sql.files.maxPartitionBytes``.
    """
    df = spark.read.table(f"{schema}.{name}" if schema else name)
    return df if max_partitions is None else df.coalesce(max_partitions)
