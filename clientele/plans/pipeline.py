"""A batch job from source tables to one result table."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clientele.operators.layout import Layout
from clientele.sinks import overwrite_table, restore_table
from clientele.sources import read_table

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Outcome:
    """What a run did: its rows and the nulls of each column, counted as they were written,
    or the error that it logged."""

    ok: bool
    rows: int = 0
    nulls: dict[str, int] = field(default_factory=dict)
    error: Exception | None = None


@dataclass(frozen=True)
class Pipeline:
    """Reads ``sources``, applies ``transform`` to them, overwrites ``destination``.

    The destination may be one of the sources. ``tolerates`` lists the error
    classes that ``run(on_error="log")`` logs instead of raising. An existing
    destination keeps its rows until the new ones are complete, unless
    ``staged`` is off; with ``one_step`` readers find it at every moment where
    the sink can do that.
    """

    name: str
    sources: tuple[str, ...]
    destination: str
    transform: Callable[..., DataFrame]
    layout: Layout = None
    max_scan_partitions: int | None = None
    tolerates: tuple[type[Exception], ...] = ()
    staged: bool = True
    one_step: bool = True

    def result(self, spark: SparkSession) -> DataFrame:
        """The transformed frame, not yet run."""
        limit = self.max_scan_partitions
        frames = [read_table(spark, s, max_partitions=limit) for s in self.sources]
        return self.transform(*frames)

    def run(self, spark: SparkSession, on_error: str = "raise") -> bool:
        """Run the job on a session that stays the caller's. Returns whether it
        succeeded; by default an error is raised rather than returned."""
        return self.run_observed(spark, on_error).ok

    def run_observed(self, spark: SparkSession, on_error: str = "raise") -> Outcome:
        """As ``run``, with the number of rows and the nulls of each column, which are counted
        in the pass that writes them, and logged."""
        if on_error not in ("raise", "log"):
            raise ValueError(f"on_error must be 'raise' or 'log', not {on_error!r}.")
        log.info("%s: %s -> %s", self.name, ", ".join(self.sources), self.destination)
        try:
            # Whatever an earlier job left cut off between two renames.
            for table in dict.fromkeys((*self.sources, self.destination)):
                restore_table(spark, table)
            result, seen = self.result(spark), Observation()
            # Numbered, as names may hold anything.
            nulls = [
                F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{i}") for i, c in enumerate(result.columns)
            ]
            overwrite_table(
                result.observe(seen, F.count("*").alias("rows"), *nulls),
                self.destination,
                layout=self.layout,
                staged=self.staged,
                one_step=self.one_step,
            )
        except self.tolerates as error:
            if on_error == "raise":
                raise
            log.error("%s failed: %s", self.name, error)
            return Outcome(False, error=error)
        found = seen.get
        outcome = Outcome(
            True, found["rows"], {c: found[f"nulls_{i}"] for i, c in enumerate(result.columns)}
        )
        some = ", ".join(f"{c} {n}" for c, n in outcome.nulls.items() if n)
        log.info("%s: done, %d rows, nulls: %s", self.name, outcome.rows, some or "none")
        return outcome
