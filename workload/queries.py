"""One Spark query per operator, over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import clientele as cl
from clientele.plans.presets import (
    DRINK_21,
    DRIVE_16,
    DRIVE_18,
    DRIVE_18_TEXT,
    VOTE_18,
)
from workload.views import (
    catalog_tables,
    catalog_views,
    customers,
    hot_orders,
    hot_visits,
    orders,
    scratch_database,
)

AS_OF = dt.date(2026, 2, 28)

Query = Callable[[SparkSession, str], DataFrame]


def add_flags(df: DataFrame, *rules: cl.EligibilityRule) -> DataFrame:
    return cl.add_eligibility(df, rules, as_of=AS_OF)


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_flags(customers(spark, sf_dir), DRIVE_16, VOTE_18, DRINK_21)


#: Parameters of the queries that set a number of tasks or files.
SCAN_TASKS, FILES = 64, 8


# --- sources -----------------------------------------------------------------


def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = catalog_views(spark, sf_dir, "customers")
    return cl.read_table(spark, f"{database}.customers")


def scan_schema_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.read_table(spark, "orders", schema=catalog_views(spark, sf_dir, "orders"))


def scan_coalesced(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = catalog_views(spark, sf_dir, "customers")
    return cl.read_table(spark, f"{database}.customers", max_partitions=SCAN_TASKS)


# --- sinks -------------------------------------------------------------------


def overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = scratch_database(spark)
    cl.overwrite_table(_flagged(spark, sf_dir), "customers_out", schema=database, layout=FILES)
    return cl.read_table(spark, "customers_out", schema=database)


def overwrite_single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One file while the table is small, several once it is not.
    table = f"{scratch_database(spark)}.customers_out"
    named = cl.add_full_name(customers(spark, sf_dir))
    cl.overwrite_table(named, table, layout="compact")
    return cl.read_table(spark, table)


def overwrite_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{catalog_tables(spark, sf_dir)}.customers"
    cl.overwrite_table(add_flags(cl.read_table(spark, table), VOTE_18), table)
    return cl.read_table(spark, table)


def overwrite_in_place_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The table keeps its buckets, so the join with it goes on needing no shuffle of it.
    table = f"{catalog_tables(spark, sf_dir, bucketed=True)}.customers"
    cl.overwrite_table(add_flags(cl.read_table(spark, table), DRIVE_16), table)
    return cl.join_on(cl.read_table(spark, table), orders(spark, sf_dir), prefix="order_")


def overwrite_one_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The table is pointed at its new files, twice: with more columns, then with fewer rows.
    table = f"{catalog_tables(spark, sf_dir)}.customers"
    for change in (
        lambda df: add_flags(df, VOTE_18),
        lambda df: df.where("segment <> 'MACHINERY'"),
    ):
        cl.overwrite_table(change(cl.read_table(spark, table)), table, one_step=True)
    return cl.read_table(spark, table)


def overwrite_schema_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{scratch_database(spark)}.customers_out"
    cl.overwrite_table(cl.add_age(customers(spark, sf_dir), as_of=AS_OF), table)
    named = cl.add_full_name(customers(spark, sf_dir)).drop("dob")
    cl.overwrite_table(named, table)
    return cl.read_table(spark, table)


# --- derived columns ---------------------------------------------------------


def age_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.add_age(customers(spark, sf_dir), as_of=AS_OF)


def age_years_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("dob")
    )
    return cl.add_eligibility(lines, (DRIVE_16, VOTE_18, DRINK_21), as_of=dt.date(2016, 2, 29))


def can_drive_16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_flags(customers(spark, sf_dir), DRIVE_16)


def can_vote_18(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_flags(customers(spark, sf_dir), VOTE_18)


def drive18_drink21(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_flags(customers(spark, sf_dir), DRIVE_18, DRINK_21)


def drive_vote_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = cl.EligibilityRule("canDrive", 17), cl.EligibilityRule("canVote", 20)
    return add_flags(customers(spark, sf_dir), *rules)


def drive_status_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    born = customers(spark, sf_dir).withColumnRenamed("dob", "birth_date")
    return cl.add_eligibility(born, (DRIVE_18_TEXT,), dob="birth_date", as_of=AS_OF)


def full_name_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.add_full_name(customers(spark, sf_dir))


def full_name_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.add_full_name(customers(spark, sf_dir), sep=" ", null_safe=True)


def full_name_repartitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.arrange(cl.add_full_name(customers(spark, sf_dir)), FILES)


def select_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.select_columns(customers(spark, sf_dir), "id", "first_name", "segment")


# --- filters -----------------------------------------------------------------


def filter_sql_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flagged(spark, sf_dir).filter("age < 21 AND canVote AND NOT canDrink")


def filter_string_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flagged(spark, sf_dir).filter("segment = 'BUILDING'")


def filter_column_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flagged(spark, sf_dir).filter(F.col("nation") == 7)


def filter_reached_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The age filter as a range on the stored date, which reaches the scan.
    shipped = F.col("l_shipdate").cast("date")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    old = lines.filter(cl.has_reached(shipped, 18, dt.date(2016, 2, 29)))
    return old.select("l_orderkey", "l_linenumber", shipped.alias("dob"))


def filter_age_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Both bounds reach the scan.
    shipped = F.col("l_shipdate").cast("date")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    young = lines.filter(cl.age_between(shipped, 18, 20, dt.date(2016, 2, 29)))
    return young.select("l_orderkey", "l_linenumber", shipped.alias("dob"))


def filter_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Flags and ages as text; the scan sees both bounds of the stored date.
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").alias("dob"), "l_returnflag"
    )
    young = cl.filter_eligible(
        lines,
        "age < 21 AND canVote AND NOT canDrink",
        "l_returnflag <> 'N' OR age = 19",
        rules=(DRIVE_16, VOTE_18, DRINK_21),
        as_of=dt.date(2016, 2, 29),
    )
    return young.withColumn("dob", F.to_date("dob"))


# --- join --------------------------------------------------------------------


def customer_orders_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.join_on(customers(spark, sf_dir), orders(spark, sf_dir), prefix="order_")


def customer_orders_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits, placed = hot_visits(spark, sf_dir), hot_orders(spark, sf_dir)
    ours = cl.heavy_keys(visits, "id", share=0.005)
    theirs = cl.heavy_keys(placed, "customer_id", share=0.005)
    # Slices of the hottest key that fill the tasks of the join once.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = max(theirs.values(), default=0) // tasks + 1
    return cl.join_on(
        visits, placed, prefix="order_", hot_keys=theirs, hot_left_keys=ours, slice_rows=rows
    )


# --- counts, order, comparison -----------------------------------------------


def count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.count_rows(_flagged(spark, sf_dir))


def count_by_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.count_where(
        _flagged(spark, sf_dir),
        n_drive="canDrive = true",
        n_vote=F.col("canVote"),
        n_drink=F.col("canDrink"),
        n_young_voters="canVote AND NOT canDrink",
        n_minor_drivers="canDrive AND NOT canVote",
        n_unknown=F.col("age").isNull(),
    )


def first_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.first_row(_flagged(spark, sf_dir), F.col("dob").desc(), "id")


def sorted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.sort_rows(_flagged(spark, sf_dir), "age", "id")


def frame_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    def flags(rule: cl.EligibilityRule) -> DataFrame:
        flagged = add_flags(customers(spark, sf_dir), rule)
        return flagged.select("segment", "canDrive", "first_name")

    return cl.frame_diff(flags(DRIVE_16), flags(DRIVE_18))


def frame_diff_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    drives = [add_flags(customers(spark, sf_dir), rule) for rule in (DRIVE_16, DRIVE_18)]
    return cl.frame_diff(*drives)


def frame_diff_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Nearly equal frames: only rows of buckets that differ are shuffled.
    drives = add_flags(customers(spark, sf_dir), DRIVE_16)
    changed = F.when(F.col("id") % 997 == 0, ~F.col("canDrive")).otherwise(F.col("canDrive"))
    return cl.frame_diff(drives, drives.withColumn("canDrive", changed), digests=4096)


# --- standard jobs, read back ------------------------------------------------


def _job(name: str, again: str | None = None, bucketed: bool = False, **options: Any) -> Query:
    """A job and its result. ``again``: a job that has written the destination before."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if name.endswith("in_place"):
            database = catalog_tables(spark, sf_dir, bucketed)
        else:
            database = catalog_views(spark, sf_dir, *cl.PRESETS[name].sources)
        if again:
            cl.preset(again, database, as_of=AS_OF).run(spark)
        job = cl.preset(name, database, as_of=AS_OF, **options)
        job.run(spark)
        return cl.read_table(spark, job.destination)

    run.__name__ = f"job_{name}"
    return run


def job_drive16_tr(spark: SparkSession, sf_dir: str) -> DataFrame:
    # From one database to another, with another name for the birth column and the table.
    job = cl.preset(
        "drive16_tr",
        as_of=AS_OF,
        source_database=catalog_views(spark, sf_dir, "members"),
        destination_database=scratch_database(spark),
        sources=("members",),
        dob="born",
    )
    job.run(spark)
    return cl.read_table(spark, job.destination)


#: Each job runs once, with its own layout where that is what sets it apart.
JOBS: dict[str, Query] = {
    "drive18_drink21": _job("drive18_drink21"),
    "drive16_tr": job_drive16_tr,
    "vote18_in_place": _job("vote18_in_place", fixed_layout=True),
    "drive16": _job("drive16"),
    "drive16_vote18": _job("drive16_vote18"),
    "drive16_with_age": _job("drive16_with_age", fixed_layout=True),
    "drive16_in_place": _job("drive16_in_place", bucketed=True),
    "drive_status": _job("drive_status"),
    "drive_status_again": _job("drive_status_again", again="drive_status", staged=False),
    "full_name_two_files": _job("full_name_two_files", fixed_layout=True),
    "full_name": _job("full_name", fixed_layout=True),
    "full_name_null_safe_in_place": _job("full_name_null_safe_in_place"),
    "gold_orders": _job("gold_orders"),
    "full_name_again": _job("full_name_again", again="full_name_two_files"),
}

QUERIES: dict[str, Query] = {
    "scan_table": scan_table,
    "scan_schema_table": scan_schema_table,
    "scan_coalesced": scan_coalesced,
    "overwrite_roundtrip": overwrite_roundtrip,
    "overwrite_single_file": overwrite_single_file,
    "overwrite_in_place": overwrite_in_place,
    "overwrite_in_place_bucketed": overwrite_in_place_bucketed,
    "overwrite_one_step": overwrite_one_step,
    "overwrite_schema_change": overwrite_schema_change,
    "age_years": age_years,
    "age_years_lineitem": age_years_lineitem,
    "can_drive_16": can_drive_16,
    "can_vote_18": can_vote_18,
    "drive18_drink21": drive18_drink21,
    "drive_vote_params": drive_vote_params,
    "drive_status_text": drive_status_text,
    "full_name_strict": full_name_strict,
    "full_name_null_safe": full_name_null_safe,
    "full_name_repartitioned": full_name_repartitioned,
    "select_columns": select_columns,
    "filter_sql_text": filter_sql_text,
    "filter_string_eq": filter_string_eq,
    "filter_column_eq": filter_column_eq,
    "filter_reached_age": filter_reached_age,
    "filter_age_between": filter_age_between,
    "filter_eligible": filter_eligible,
    "customer_orders_inner": customer_orders_inner,
    "customer_orders_hot_keys": customer_orders_hot_keys,
    "count_rows": count_rows,
    "count_by_flags": count_by_flags,
    "first_row": first_row,
    "sorted_rows": sorted_rows,
    "frame_diff": frame_diff,
    "frame_diff_all_columns": frame_diff_all_columns,
    "frame_diff_digests": frame_diff_digests,
    **{f"job_{name}": run for name, run in JOBS.items()},
}
