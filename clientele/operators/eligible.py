"""Filters on ages and flags as ranges of the stored birth date."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.functions import AsOf, birth_cutoff, flag
from clientele.operators.derive import EligibilityRule, add_eligibility

#: Ages that dates of the years 1 to 9999 can give.
OLDEST = 9999
#: More runs of ages than this make one range, from the lowest to the highest.
MOST_RANGES = 8


def filter_eligible(
    df: DataFrame,
    *conditions: Column | str,
    rules: Iterable[EligibilityRule] = (),
    dob: str = "dob",
    as_of: AsOf = None,
    check: bool = True,
) -> DataFrame:
    """``add_eligibility(df, rules, ...)`` where all conditions hold, as ``filter`` would
    give it, but with the birth dates that they leave as ranges that a scan can use.

    A condition is SQL text or a column over ``age``, the rules' flags and the frame's own
    columns. One over ``age`` and flags alone, whatever it is made of, holds or not for an
    age. It is tried on every age there is, and the runs of ages for which it holds become
    ranges of birth dates, as ages fall with the birth date; for the null age, ``IS NULL``.
    A condition that reads other columns too is applied as it is, so keep what can be told
    from the age in conditions of their own. The conditions themselves are applied as well.

    Conditions have to give the same result each time. Birth dates are taken to lie in the
    years 1 to 9999, as SQL dates do. With a column as ``as_of`` nothing is derived.
    """
    rules = tuple(rules)
    flagged = add_eligibility(df, rules, dob=dob, as_of=as_of, check=check)
    if not isinstance(as_of, Column):
        others = {c.lower() for c in df.columns} - {"age", *(r.name.lower() for r in rules)}
        for condition in conditions:
            if any(re.search(rf"\b{re.escape(c)}\b", str(condition).lower()) for c in others):
                continue
            bounds = birth_range(df.sparkSession, condition, rules, F.col(f"`{dob}`"), as_of)
            if bounds is not None:
                df = df.where(bounds)
        flagged = add_eligibility(df, rules, dob=dob, as_of=as_of, check=check)
    for condition in conditions:
        flagged = flagged.where(condition)
    return flagged


def birth_range(
    spark: SparkSession,
    condition: Column | str,
    rules: Iterable[EligibilityRule],
    dob: Column,
    as_of: AsOf = None,
) -> Column | None:
    """The birth dates at which a condition over ``age`` and flags can hold; nothing if it
    reads other columns, or holds at every age."""
    ages = spark.range(-OLDEST, OLDEST + 1, 1, 1).select(F.col("id").cast("int").alias("age"))
    ages = ages.union(spark.range(1).select(F.lit(None).cast("int").alias("age")))
    known = ages.select(
        "age", *[flag(F.col("age") >= r.min_age, r.yes, r.no).alias(r.name) for r in rules]
    )
    try:
        # At most the ages there are.
        found = [row.age for row in known.where(condition).select("age").collect()]
    except PySparkException:
        # It reads other columns, or fails at some age that the data need not have.
        return None
    born = dob.cast("date")
    parts = [_range(born, low, high, as_of) for low, high in _runs(x for x in found if x is not None)]
    if None in found:
        parts.append(born.isNull())
    if any(p is None for p in parts):
        # Any birth date will do, and perhaps none.
        return None if None in found else born.isNotNull()
    return reduce(or_, parts) if parts else F.lit(False)


def _runs(ages: Iterable[int]) -> list[tuple[int, int]]:
    runs: list[tuple[int, int]] = []
    for age in sorted(ages):
        if runs and runs[-1][1] == age - 1:
            runs[-1] = runs[-1][0], age
        else:
            runs.append((age, age))
    return runs if len(runs) <= MOST_RANGES else [(runs[0][0], runs[-1][1])]


def _range(born: Column, low: int, high: int, as_of: AsOf) -> Column | None:
    bounds = []
    if low > -OLDEST:
        bounds.append(born <= birth_cutoff(low, as_of))
    if high < OLDEST:
        bounds.append(born > birth_cutoff(high + 1, as_of))
    return reduce(lambda a, b: a & b, bounds) if bounds else None
