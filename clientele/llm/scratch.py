"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_LOG = logging.getLogger(__name__)


def _is_local(path: str) -> bool:
    return path.startswith(("/", "file:"))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below ``spark.checkpoint.dir``, or below the warehouse folder if that is
    not set. Results are lazy and read such tables later, so the folder is the caller's to
    clear once the results are written. On a cluster a warehouse on local disks is warned of,
    as other machines cannot read it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        if _is_local(root) and not spark.conf.get("spark.master", "local").startswith("local"):
            _LOG.warning("spark.checkpoint.dir is not set; %s has to be a folder that all machines share.", root)
    return f"{root.rstrip('/')}/scratch-{uuid.uuid4().hex}/{label}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame, written once and read back: it cuts the lineage, and what a lost executor
    had computed is not lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: Column) -> Column:
    """Tells rows with one id and different texts apart; null is the empty text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))
