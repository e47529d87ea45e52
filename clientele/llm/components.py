"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.scratch import stored


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links (``a``, ``b``; no nulls), where
    the component is named by its smallest node.

    Alternates the large-star and small-star steps of Kiveris et al. (2014), which takes a
    number of rounds that grows with the logarithm of the component size. Each round is
    stored. Nodes of many links are joined by Spark's skew-splitting sort-merge join; no
    node's links are gathered.
    """
    edges = stored(_down(links.where("a <> b")), "links")
    size = _size(edges)
    while True:
        edges = stored(_small_star(_large_star(edges)), "links")
        before, size = size, _size(edges)
        if size == before:
            break
    roots = edges.select(F.col("low").alias("node")).distinct()
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )


def _down(links: DataFrame) -> DataFrame:
    return links.select(
        F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")
    ).distinct()


def _size(edges: DataFrame) -> tuple:
    """Changes whenever a step changes the edges."""
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to its smallest neighbour or itself."""
    lowest = edges.groupBy(F.col("high").alias("at")).agg(F.min("low").alias("lowest"))
    joined = edges.join(lowest, F.col("low") == F.col("at"), "left")
    return joined.select("high", F.coalesce("lowest", "low").alias("low")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them."""
    lowest = edges.groupBy(F.col("high").alias("at")).agg(F.min("low").alias("lowest"))
    joined = edges.join(lowest, F.col("high") == F.col("at"))
    return (
        joined.where(F.col("low") != F.col("lowest"))
        .select(F.col("low").alias("high"), F.col("lowest").alias("low"))
        .union(lowest.select("at", "lowest"))
        .distinct()
    )
