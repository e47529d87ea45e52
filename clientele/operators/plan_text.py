"""What Spark says about a plan, by the public ``explain``."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame) -> str:
    """The physical plan as it stands before the frame has run."""
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def shuffles(df: DataFrame) -> bool:
    """Whether the plan moves rows between tasks, other than by a broadcast."""
    return bool(re.search(r"(?<!Broadcast)Exchange\b", plan_text(df)))


def keeps_whole_files(df: DataFrame) -> bool:
    """Whether the plan reads files of one table, keeps all their columns and rows, and moves
    none, so that what a task writes is about as large as what it reads."""
    text = plan_text(df)
    scans = re.findall(r"\bFileScan (\w+)", text)
    others = re.search(r"Exchange\b|Join\b|\bGenerate\b|\bFilter\b|(LocalTable|InMemoryTable|Batch)Scan|\bRange\b", text)
    if len(scans) != 1 or others:
        return False
    files = df.inputFiles()
    if not files:
        return False
    stored = df.sparkSession.read.format(scans[0]).load(files[0]).columns
    return {c.lower() for c in stored} <= {c.lower() for c in df.columns}
