import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

import clientele as cl
from tests.helpers import AS_OF, CASES, ID_DOB, settings

DRIVE = cl.EligibilityRule("canDrive", 16)
VOTE = cl.EligibilityRule("canVote", 18)
DRINK = cl.EligibilityRule("canDrink", 21)

# Days on which month ends, leap days and plain days meet.
REFERENCE_DAYS = [
    dt.date(year, month, day)
    for year in (1999, 2000, 2023, 2024, 2026, 2100)
    for month, day in (
        (1, 1), (1, 31), (2, 1), (2, 27), (2, 28), (3, 1), (3, 30), (4, 30), (6, 15), (12, 31),
    )
] + [dt.date(2000, 2, 29), dt.date(2024, 2, 29)]


@pytest.fixture(scope="module")
def grid(spark):
    """Every birth date from 1890 to 2110 on every reference day."""
    days = (dt.date(2110, 12, 31) - dt.date(1890, 1, 1)).days
    return (
        spark.range(0, days, 1, 8)
        .select(F.date_add(F.lit(dt.date(1890, 1, 1)), F.col("id").cast("int")).alias("dob"))
        .withColumn("day", F.explode(F.array(*map(F.lit, REFERENCE_DAYS))))
    )


def _months_age(day, dob):
    return F.floor(F.months_between(day, dob) / 12).cast("int")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_age_is_whole_years_of_months_between(spark, grid, zone):
    with settings(spark, spark_sql_session_timeZone=zone):
        wrong = grid.where(
            ~cl.age_years("dob", F.col("day")).eqNullSafe(_months_age(F.col("day"), F.col("dob")))
        )
        assert grid.count() > 4_900_000
        assert wrong.isEmpty()


def test_age_of_timestamps_is_whole_years_of_months_between(spark, grid):
    with settings(spark, spark_sql_session_timeZone="UTC"):
        late = grid.withColumn("dob", F.expr("cast(dob AS timestamp) + interval 1439 minutes"))
        assert dict(late.dtypes)["dob"] == "timestamp"
        wrong = late.where(
            ~cl.age_years("dob", F.col("day")).eqNullSafe(_months_age(F.col("day"), F.col("dob")))
        )
        assert wrong.isEmpty()


def test_reached_age_agrees_with_age(grid):
    aged = grid.withColumn("age", cl.age_years("dob", F.col("day")))
    for years in (0, 1, 16, 18, 21, 100):
        reached = cl.has_reached("dob", years, F.col("day"))
        assert aged.where(~reached.eqNullSafe(F.col("age") >= years)).isEmpty()


@pytest.mark.parametrize(
    "dob, day, age",
    [
        ("2008-02-29", "2026-02-27", 17),
        ("2008-02-29", "2026-02-28", 18),
        ("2008-02-29", "2024-02-28", 15),
        ("2008-02-29", "2024-02-29", 16),
        ("2007-02-28", "2024-02-28", 17),
        ("2010-01-31", "2026-01-30", 15),
        ("2010-01-31", "2026-01-31", 16),
    ],
)
def test_leap_days_and_month_ends(spark, dob, day, age):
    df = spark.createDataFrame([(dt.date.fromisoformat(dob),)], "dob date")
    for as_of in (day, dt.date.fromisoformat(day), F.lit(day)):
        row = cl.add_eligibility(df, (cl.EligibilityRule("ok", age),), as_of=as_of).collect()[0]
        assert (row.age, row.ok) == (age, True)


def test_cases(spark):
    df = spark.createDataFrame([(c[0], c[1]) for c in CASES], "case string, dob date")
    result = cl.add_eligibility(df, (DRIVE, VOTE, DRINK), as_of=AS_OF)
    assert {tuple(row) for row in result.collect()} == set(CASES)


def test_today_is_the_default_day(spark):
    df = spark.createDataFrame([(dt.date(2000, 1, 2),), (None,)], "dob date")
    default = cl.add_eligibility(df, (DRIVE,))
    today = cl.add_eligibility(df, (DRIVE,), as_of=F.current_date())
    assert cl.frames_equal(default, today)


def test_birthdays_around_today(spark):
    born = "add_months(current_date(), -192)"
    days = spark.sql(f"SELECT {born} AS today, {born} - 1 AS yesterday, {born} + 1 AS tomorrow")
    for day, age in (("today", 16), ("yesterday", 16), ("tomorrow", 15)):
        row = cl.add_eligibility(days, (DRIVE,), dob=day).collect()[0]
        assert (row.age, row.canDrive) == (age, age >= 16)


def test_output_types(spark):
    rules = (DRIVE, cl.EligibilityRule("status", 18, yes="Yes", no="No"))
    for df in (
        spark.createDataFrame([], ID_DOB),
        spark.createDataFrame([(1, dt.date(2000, 1, 1))], ID_DOB),
    ):
        assert cl.add_eligibility(df, rules, as_of=AS_OF).schema == T.StructType(
            [
                *ID_DOB.fields,
                T.StructField("age", T.IntegerType(), True),
                T.StructField("canDrive", T.BooleanType(), False),
                T.StructField("status", T.StringType(), False),
            ]
        )


def test_text_flag_and_named_birth_column(spark):
    df = spark.createDataFrame([(c[0], c[1]) for c in CASES], "case string, born date")
    rule = cl.EligibilityRule("canDrive", 18, yes="Yes", no="No")
    result = cl.add_eligibility(df, (rule,), dob="born", as_of=AS_OF)
    expected = {(c[0], "Yes" if c[4] else "No") for c in CASES}
    assert {(row.case, row.canDrive) for row in result.collect()} == expected


def test_empty_input(spark):
    result = cl.add_eligibility(spark.createDataFrame([], ID_DOB), (DRIVE, VOTE), as_of=AS_OF)
    assert result.columns == ["id", "dob", "age", "canDrive", "canVote"]
    assert result.count() == 0


def test_inferred_rows_keep_other_columns_and_copies(spark):
    born = dt.date(1996, 6, 15)
    rows = [Row(id=1, name="Ada", city="Oslo", dob=born)] * 2 + [
        Row(id=2, name="Bo", city="Rome", dob=dt.date(2012, 1, 1))
    ]
    df = spark.createDataFrame(rows)
    assert dict(df.dtypes)["id"] == "bigint"
    result = cl.add_eligibility(df, (DRIVE,), as_of=AS_OF)
    assert sorted(result.collect()) == [
        (1, "Ada", "Oslo", born, 30, True),
        (1, "Ada", "Oslo", born, 30, True),
        (2, "Bo", "Rome", dt.date(2012, 1, 1), 14, False),
    ]


def test_dict_rows_with_schema(spark):
    df = spark.createDataFrame([{"id": 1, "dob": dt.date(2010, 6, 15)}], ID_DOB)
    assert cl.add_age(df, as_of=AS_OF).collect() == [(1, dt.date(2010, 6, 15), 16)]


def test_existing_columns_are_replaced(spark):
    schema = "AGE int, canVote string, dob date"
    df = spark.createDataFrame([(99, "?", dt.date(2010, 6, 15))], schema)
    once = cl.add_eligibility(df, (DRIVE,), as_of=AS_OF)
    twice = cl.add_eligibility(once, (DRIVE,), as_of=AS_OF)
    assert [c.lower() for c in once.columns] == ["age", "canvote", "dob", "candrive"]
    assert once.collect() == twice.collect() == [(16, "?", dt.date(2010, 6, 15), True)]


def test_timestamps_count_from_their_day(spark):
    df = spark.sql("SELECT timestamp_ntz'2010-06-15 23:59:00' AS dob")
    row = cl.add_eligibility(df, (DRIVE,), as_of=AS_OF).collect()[0]
    assert (row.age, row.canDrive) == (16, True)


@pytest.mark.parametrize(
    "schema", ["id int, birth_date date", "name string", "id bigint, DOB date"]
)
def test_missing_birth_column(spark, schema):
    df = spark.createDataFrame([], schema)
    with pytest.raises(ValueError, match="Input DataFrame must contain a 'dob' column."):
        cl.add_eligibility(df, (DRIVE,), as_of=AS_OF)
    with pytest.raises(ValueError, match="must contain a 'dob' column"):
        cl.add_age(df)


def test_missing_birth_column_unchecked(spark):
    with pytest.raises(AnalysisException) as error:
        cl.add_eligibility(spark.createDataFrame([], "id int"), (DRIVE,), check=False)
    assert error.value.getCondition().startswith("UNRESOLVED_COLUMN")


def test_wrong_birth_column_types_fail(spark):
    with pytest.raises(AnalysisException):
        cl.add_age(spark.createDataFrame([], "dob int"), as_of=AS_OF)
    broken = cl.add_age(spark.sql("SELECT 'soon' AS dob"), as_of=AS_OF)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        broken.collect()


@pytest.mark.parametrize("names", [("age",), ("AGE",), ("a", "A"), ("a", "b", "a")])
def test_rules_need_distinct_names(spark, names):
    rules = [cl.EligibilityRule(name, 16) for name in names]
    with pytest.raises(ValueError, match="distinct names"):
        cl.add_eligibility(spark.createDataFrame([], ID_DOB), rules)


def test_works_on_a_stream(spark, database):
    table = f"{database}.births"
    spark.createDataFrame([(c[0], c[1]) for c in CASES], "case string, dob date").write.saveAsTable(
        table
    )
    stream = cl.add_eligibility(spark.readStream.table(table), (DRIVE, VOTE, DRINK), as_of=AS_OF)
    query = stream.writeStream.format("memory").queryName("aged").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert {tuple(row) for row in spark.table("aged").collect()} == set(CASES)


def test_age_between(spark):
    from tests.helpers import AS_OF, CASES

    rows = spark.createDataFrame([(case, dob) for case, dob, *_ in CASES], "c string, dob date")
    for low, high in ((16, 17), (18, 18), (-1, 0), (21, 150)):
        found = rows.where(cl.age_between("dob", low, high, AS_OF))
        expected = {case for case, _, age, *_ in CASES if age is not None and low <= age <= high}
        assert {r.c for r in found.collect()} == expected
    with pytest.raises(ValueError):
        cl.age_between("dob", 3, 2)
