"""Derived columns. All are narrow projections: no shuffle, every input row
gives one output row, every other column passes through."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame

from clientele.functions import AsOf, age_years, flag, full_name, has_reached


@dataclass(frozen=True)
class EligibilityRule:
    """Column ``name`` holds ``yes`` from ``min_age`` years on, else ``no``."""

    name: str
    min_age: int
    yes: Any = True
    no: Any = False


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Fail before any job runs if a column is missing. Names are compared
    exactly, even where Spark itself would ignore case."""
    for name in names:
        if name not in df.columns:
            # Fixed value: the wording of the message.
            raise ValueError(f"Input DataFrame must contain a '{name}' column.")
    return df


def add_age(df: DataFrame, dob: str = "dob", as_of: AsOf = None, check: bool = True) -> DataFrame:
    """Add or replace ``age``, the completed years since ``dob``."""
    return add_eligibility(df, (), dob=dob, as_of=as_of, check=check)


def add_eligibility(
    df: DataFrame,
    rules: Iterable[EligibilityRule],
    dob: str = "dob",
    as_of: AsOf = None,
    check: bool = True,
) -> DataFrame:
    """Add or replace ``age`` and one column per rule, in one projection.

    With ``check`` off a missing ``dob`` column is left to Spark's analyser,
    which raises ``AnalysisException``.
    """
    rules = tuple(rules)
    names = [rule.name.lower() for rule in rules]
    if "age" in names or len(set(names)) < len(names):
        raise ValueError(f"Rules need distinct names other than 'age', not {names}.")
    if check:
        require_columns(df, dob)
    columns = {"age": age_years(dob, as_of)}
    for rule in rules:
        # Same as comparing the age, but reads only the date.
        reached = has_reached(dob, rule.min_age, as_of)
        columns[rule.name] = flag(reached, rule.yes, rule.no)
    return df.withColumns(columns)


def add_full_name(
    df: DataFrame,
    first: str = "first_name",
    last: str = "last_name",
    name: str = "full_name",
    sep: str = "",
    null_safe: bool = False,
) -> DataFrame:
    """Add or replace ``full_name``; see ``functions.full_name`` for nulls."""
    return df.withColumn(name, full_name(first, last, sep, null_safe))


def select_columns(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, or all columns in name order if none are named."""
    return df.select(*(names or sorted(df.columns)))
