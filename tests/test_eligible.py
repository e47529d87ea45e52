"""Filters on ages and flags against the plain filter over them."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import clientele as cl
from clientele.operators.eligible import birth_range
from tests.helpers import AS_OF, CASES, ID_DOB, plan_of
from tests.test_age import DRINK, DRIVE, REFERENCE_DAYS, VOTE, grid  # noqa: F401

RULES = (DRIVE, VOTE, DRINK, cl.EligibilityRule("status", 18, "Yes", "No"))
CONDITIONS = [
    "age < 21 AND canVote AND NOT canDrink",
    "NOT (age >= 16) OR canDrink",
    "canDrive AND age <> 17",
    "age IN (3, 4, 5, 40) OR age IS NULL",
    "age IS NULL AND NOT canDrive",
    "coalesce(age, 30) = 30",
    "status = 'Yes' AND CASE WHEN canDrink THEN age < 30 ELSE age > 18 END",
    "age % 2 = 0",
    "age BETWEEN -3 AND 0",
    "age > 5000",
    "canVote OR NOT canVote",
    "age = age",
    "1 / age > 0 OR age = 1",
    "false",
    lambda: F.col("canVote") & (F.col("age") < 30),
]


@pytest.mark.parametrize("condition", CONDITIONS)
def test_filter_equals_the_plain_filter(spark, grid, condition):  # noqa: F811
    condition = condition() if callable(condition) else condition
    days = REFERENCE_DAYS[3], REFERENCE_DAYS[4], REFERENCE_DAYS[-1]
    births = grid.where(F.col("day") == days[0]).select("dob").union(spark.sql("SELECT CAST(NULL AS date)"))
    if "/" in str(condition):
        births = births.where(F.year("dob") < 1990)  # the plain filter fails at age 0
    for day in days:
        plain = cl.add_eligibility(births, RULES, as_of=day).where(condition)
        found = cl.filter_eligible(births, condition, rules=RULES, as_of=day)
        assert found.columns == plain.columns and cl.frames_equal(found, plain)


def test_bounds_reach_the_scan(spark, database):
    spark.createDataFrame([(i, dob) for i, (_, dob, *_) in enumerate(CASES)], ID_DOB).write.saveAsTable(f"{database}.b")
    births = spark.table(f"{database}.b")
    found = cl.filter_eligible(births, "age < 21 AND canVote AND NOT canDrink", "id > 3", rules=RULES, as_of=AS_OF)
    plan = plan_of(found)
    assert "LessThanOrEqual(dob,2008-06-15)" in plan and "GreaterThan(dob,2005-06-15)" in plan
    assert " > 3)" in plan
    # A condition that mixes in other columns is applied, but not turned into dates.
    mixed = cl.filter_eligible(births, "id > 3 AND canVote", rules=RULES, as_of=AS_OF)
    assert "2008-06-15" not in plan_of(mixed).split("PushedFilters")[1].split("]")[0]
    assert cl.frames_equal(mixed, cl.add_eligibility(births, RULES, as_of=AS_OF).where("id > 3 AND canVote"))
    assert "IsNull(dob)" in plan_of(cl.filter_eligible(births, "age IS NULL", as_of=AS_OF))


def test_what_says_nothing_about_dates(spark):
    for condition in ("canVote OR NOT canVote", "id = 3", "1 / age > 0"):
        assert birth_range(spark, condition, RULES, F.col("dob"), AS_OF) is None


def test_columns_as_day_and_errors(spark):
    rows = spark.createDataFrame([(1, AS_OF)], ID_DOB).withColumn("day", F.lit(AS_OF))
    assert cl.filter_eligible(rows, "age = 0", as_of=F.col("day")).count() == 1
    assert cl.filter_eligible(rows, as_of=AS_OF).columns == ["id", "dob", "day", "age"]
    with pytest.raises(AnalysisException):
        cl.filter_eligible(rows, "nothing > 3", as_of=AS_OF)
    with pytest.raises(ValueError, match="'born'"):
        cl.filter_eligible(rows, "age > 3", dob="born")
