import datetime as dt
import logging

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import clientele as cl
from clientele.__main__ import main
from clientele.plans import presets
from clientele.sinks import tables as sink
from tests.helpers import AS_OF, CASES
from workload.views import drop_scratch, scratch_database

# Each job's destination and the columns it adds.
JOBS = {
    "drive18_drink21": ("customers_2", ["age", "canDrive", "canDrink"]),
    "drive16_tr": ("customers_tr", ["age", "canDrive"]),
    "vote18_in_place": ("customers", ["age", "canVote"]),
    "drive16": ("customers2", ["age", "canDrive"]),
    "drive16_vote18": ("customers_new", ["age", "canDrive", "canVote"]),
    "drive16_with_age": ("customers_with_age", ["age", "canDrive"]),
    "drive16_in_place": ("customers", ["age", "canDrive"]),
    "drive_status": ("customers_with_drive_status", ["age", "canDrive"]),
    "drive_status_again": ("customers_with_drive_status", ["age", "canDrive"]),
    "full_name_two_files": ("customers_transformed", ["full_name"]),
    "full_name": ("customers_transformed", ["full_name"]),
    "full_name_null_safe_in_place": ("customers", ["full_name"]),
    "gold_orders": ("gold_orders", ["order_id", "customer_id", "total"]),
    "full_name_again": ("customers_transformed", ["full_name"]),
}
COLUMNS = ["id", "first_name", "last_name", "dob"]


@pytest.fixture
def retail(spark, database):
    """A database with customers, one per case, and two orders."""
    rows = [
        (i, case, None if i % 5 == 0 else "Smith", dob)
        for i, (case, dob, *_) in enumerate(CASES)
    ]
    schema = "id bigint, first_name string, last_name string, dob date"
    spark.createDataFrame(rows, schema).write.saveAsTable(f"{database}.customers")
    orders = [(100, 1, 9.5), (101, 1, 3.0), (102, None, 1.0), (103, 999, 2.0)]
    spark.createDataFrame(orders, "id bigint, customer_id bigint, total double").write.saveAsTable(
        f"{database}.orders"
    )
    return database


def test_there_are_fourteen_jobs():
    assert set(cl.PRESETS) == set(JOBS) and len(JOBS) == 14


@pytest.mark.parametrize(
    "name, fixed_layout",
    [(name, False) for name in sorted(JOBS)]
    + [(name, True) for name in ("vote18_in_place", "drive16_with_age", "full_name_two_files",
                                 "full_name_null_safe_in_place", "gold_orders")],
)
def test_job(spark, retail, name, fixed_layout):
    destination, added = JOBS[name]
    job = cl.preset(name, retail, as_of=AS_OF, fixed_layout=fixed_layout)
    assert job.destination == f"{retail}.{destination}"
    assert job.run(spark) is True
    result = spark.table(job.destination)
    assert result.columns == COLUMNS + added
    if name == "gold_orders":
        assert [(r.id, r.order_id, r.total) for r in result.orderBy("order_id").collect()] == [
            (1, 100, 9.5), (1, 101, 3.0),
        ]
        return
    rows = {r.first_name: r for r in result.collect()}
    assert len(rows) == len(CASES)
    for case, _, age, drive16, vote18, drink21 in CASES:
        row, last = rows[case], rows[case].last_name
        expected = {
            "age": age,
            "canVote": vote18,
            "canDrink": drink21,
            "canDrive": drive16 if "drive16" in name else vote18,
            "full_name": (
                f"{case} {last or ''}" if "null_safe" in name else last and case + last
            ),
        }
        if name.startswith("drive_status"):
            expected["canDrive"] = "Yes" if vote18 else "No"
        for column in added:
            assert row[column] == expected[column], (case, column)


def test_fixed_layouts():
    # File counts of the fourteen jobs, "compact" for single files.
    assert {name: job.layout for name, job in cl.PRESETS.items()} == {
        "drive18_drink21": 4,
        "drive16_tr": 4,
        "vote18_in_place": 4,
        "drive16": 4,
        "drive16_vote18": 200,
        "drive16_with_age": 8,
        "drive16_in_place": 4,
        "drive_status": 4,
        "drive_status_again": 4,
        "full_name_two_files": 2,
        "full_name": "compact",
        "full_name_null_safe_in_place": "compact",
        "gold_orders": "compact",
        "full_name_again": "compact",
    }
    assert cl.preset("drive16", "db").layout is None
    assert cl.preset("full_name_two_files", "db", fixed_layout=True).max_scan_partitions == 4


def test_in_place_jobs_can_run_again_and_after_each_other(spark, retail):
    for name in ("vote18_in_place", "drive16_in_place", "vote18_in_place"):
        cl.preset(name, retail, as_of=AS_OF).run(spark)
    result = spark.table(f"{retail}.customers")
    assert sorted(result.columns) == sorted([*COLUMNS, "age", "canVote", "canDrive"])
    assert result.count() == len(CASES)


def test_in_place_job_restores_a_table_cut_off_mid_swap(spark, retail):
    for name in ("vote18_in_place", "drive16"):
        spark.sql(f"ALTER TABLE {retail}.customers RENAME TO {retail}.customers{sink._OLD}5")
        assert cl.preset(name, retail, as_of=AS_OF).run(spark)
        assert spark.table(f"{retail}.customers").count() == len(CASES)


def test_from_one_database_to_another(spark, retail):
    other = scratch_database(spark)
    born = spark.table(f"{retail}.customers").withColumnRenamed("dob", "born")
    born.write.saveAsTable(f"{retail}.people")
    job = cl.preset(
        "drive16", source_database=retail, destination_database=other, sources=("people",),
        destination="drivers", dob="born", as_of=AS_OF,
    )
    assert job.run(spark) and job.destination == f"{other}.drivers"
    assert spark.table(f"{other}.drivers").where("canDrive").count() > 0
    with pytest.raises(ValueError, match="database"):
        cl.preset("drive16", source_database=retail)
    with pytest.raises(ValueError, match="2 tables"):
        cl.preset("gold_orders", retail, sources=("customers",))
    with pytest.raises(ValueError, match="no birth column"):
        cl.preset("full_name", retail, dob="born")


def test_other_ages(spark, retail):
    rules = (cl.EligibilityRule("canDrive", 20), cl.EligibilityRule("canVote", 25))
    job = cl.preset("drive16_vote18", retail, as_of=AS_OF, rules=rules)
    job.run(spark)
    row = spark.table(job.destination).where("first_name = '20'").collect()[0]
    assert (row.canDrive, row.canVote) == (True, False)
    with pytest.raises(ValueError, match="no eligibility rules"):
        cl.preset("full_name", retail, rules=rules)


def test_a_job_keeps_the_old_result_if_it_fails(spark, retail):
    job = cl.preset("drive16", retail, as_of=AS_OF)
    job.run(spark)
    spark.table(f"{retail}.customers").drop("dob").selectExpr(
        "*", "if(id = 3, cast('no date' AS date), NULL) AS dob"
    ).createOrReplaceTempView("broken")
    failing = cl.Pipeline("failing", ("broken",), job.destination, job.transform)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        failing.run(spark)
    assert spark.table(job.destination).where("canDrive").count() > 0


def test_ages_count_to_today_by_default(spark, retail):
    job = cl.preset("drive16", retail)
    today = cl.add_eligibility(
        spark.table(f"{retail}.customers"), (presets.DRIVE_16,), as_of=F.current_date()
    )
    assert cl.frames_equal(job.result(spark), today)


# --- failures ----------------------------------------------------------------


@pytest.fixture
def no_births(spark, database):
    spark.createDataFrame([(1, "x")], "id int, name string").write.saveAsTable(
        f"{database}.customers"
    )
    return database


def test_errors_are_raised_by_default(spark, no_births):
    with pytest.raises(ValueError, match="'dob'"):
        cl.preset("drive16", no_births).run(spark)
    with pytest.raises(AnalysisException):
        cl.preset("drive_status", no_births).run(spark)


def test_tolerated_errors_are_logged_on_request(spark, no_births, caplog):
    with caplog.at_level(logging.ERROR):
        for name in ("drive18_drink21", "drive16_tr", "drive16"):
            assert cl.preset(name, no_births).run(spark, on_error="log") is False
            assert cl.preset(name, "nowhere").run(spark, on_error="log") is False
    assert len(caplog.records) == 6 and "'dob'" in caplog.text
    assert not spark.catalog.tableExists(f"{no_births}.customers2")


@pytest.mark.parametrize("name", ["drive16_vote18", "drive16_with_age", "vote18_in_place"])
def test_other_jobs_tolerate_nothing(spark, no_births, name):
    with pytest.raises(ValueError, match="'dob'"):
        cl.preset(name, no_births).run(spark, on_error="log")


def test_only_the_listed_errors_are_tolerated(spark, retail):
    def break_down(df):
        raise RuntimeError("down")

    job = cl.Pipeline(
        "broken", (f"{retail}.customers",), f"{retail}.out", break_down, tolerates=(ValueError,)
    )
    with pytest.raises(RuntimeError, match="down"):
        job.run(spark, on_error="log")
    with pytest.raises(ValueError, match="on_error"):
        job.run(spark, on_error="ignore")


def test_own_pipeline_over_two_sources(spark, retail):
    job = cl.Pipeline(
        name="spend",
        sources=(f"{retail}.customers", f"{retail}.orders"),
        destination=f"{retail}.spend",
        transform=lambda c, o: cl.join_on(cl.add_age(c, as_of=AS_OF), o, prefix="order_"),
    )
    assert job.run(spark)
    assert {r.age for r in spark.table(job.destination).collect()} == {25}


# --- command line ------------------------------------------------------------


class _Session:
    def __init__(self, session):
        self.session, self.stopped = session, False

    def __getattr__(self, name):
        return getattr(self.session, name)

    def stop(self):
        self.stopped = True


@pytest.fixture
def session(spark, monkeypatch):
    wrapped = _Session(spark)
    monkeypatch.setattr("clientele.__main__.get_session", lambda app_name: wrapped)
    return wrapped


def test_command_line(spark, retail, session):
    assert main(["drive16", "--database", retail, "--as-of", AS_OF.isoformat()]) == 0
    assert session.stopped
    row = spark.table(f"{retail}.customers2").where(F.col("dob") == dt.date(2010, 6, 15)).first()
    assert row.canDrive is True


def test_command_line_with_other_tables_and_ages(spark, retail, session, capsys):
    other = scratch_database(spark)
    spark.sql(f"CREATE VIEW {retail}.people AS SELECT *, dob AS born FROM {retail}.customers")
    args = ["drive16_vote18", "--source-database", retail, "--destination-database", other]
    args += ["--source", "people", "--destination", "out", "--dob", "born", "--as-of", AS_OF.isoformat()]
    assert main([*args, "--age", "canDrive=20", "--age", "canVote=25", "--unstaged"]) == 0
    row = spark.table(f"{other}.out").where("first_name = '20'").first()
    assert (row.canDrive, row.canVote) == (True, False)
    for wrong in (["drive16"], ["drive16", "--database", "x", "--age", "canDrive"]):
        with pytest.raises(SystemExit):
            main(wrong)


def test_scratch_databases_can_be_dropped(spark):
    database = scratch_database(spark)
    spark.range(3).write.saveAsTable(f"{database}.t")
    cl.overwrite_table(cl.read_table(spark, f"{database}.t").where("id > 0"), f"{database}.t")
    drop_scratch(spark)
    assert not [d.name for d in spark.catalog.listDatabases() if d.name.startswith("w_")]


def test_command_line_failures_stop_the_session(no_births, session):
    assert main(["drive16", "--database", no_births, "--on-error", "log"]) == 1
    assert session.stopped
    session.stopped = False
    with pytest.raises(ValueError):
        main(["drive16", "--database", no_births])
    assert session.stopped


def test_session_handle_joins_the_running_session(spark):
    assert cl.get_session("any name").sparkContext is spark.sparkContext
