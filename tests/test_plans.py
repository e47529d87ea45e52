"""What Spark makes of the operators: pushdown, shuffles, skew."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import clientele as cl
from clientele.operators import joins
from clientele.plans.presets import DRINK_21, DRIVE_16, VOTE_18
from tests.helpers import AS_OF, partition_sizes, plan_of, settings
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def births(spark):
    """A stored table with a birth date and columns nobody asks for."""
    from workload.views import customers, scratch_database

    table = f"{scratch_database(spark)}.births"
    customers(spark, SF_DIR).write.saveAsTable(table)
    return spark.table(table)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_nested_loops(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for node in ("Python", "Pandas", "Arrow", "NestedLoop", "CartesianProduct"):
        assert node not in plan


def test_derived_columns_are_one_generated_stage_without_shuffle(births):
    result = cl.add_full_name(
        cl.add_eligibility(births, (DRIVE_16, VOTE_18, DRINK_21), as_of=AS_OF)
    )
    plan = plan_of(result)
    assert "Exchange" not in plan and "*(1) Project" in plan and "*(2)" not in plan
    assert plan.count("Project") == 1
    # The thresholds are literals, and a default day is one as well.
    assert "dob" in plan and "<= 2010-06-15" in plan and "last_day" not in plan
    today = plan_of(cl.add_eligibility(births, (DRIVE_16,)))
    assert "current_date" not in today and "add_months" not in today


def test_reached_age_filter_reaches_the_scan(births):
    plan = plan_of(births.where(cl.has_reached("dob", 16, AS_OF)).select("id"))
    assert "LessThanOrEqual(dob,2010-06-15)" in plan
    assert "ReadSchema: struct<id:bigint,dob:date>" in plan


def test_flag_reads_only_the_birth_date(births):
    flagged = cl.add_eligibility(births, (DRIVE_16,), as_of=AS_OF)
    plan = plan_of(flagged.where("canDrive").select("canDrive"))
    assert "ReadSchema: struct<dob:date>" in plan and "year(" not in plan


def test_first_row_does_not_sort_the_frame(births):
    plan = plan_of(cl.first_row(births, "id"))
    assert plan.startswith("TakeOrderedAndProject") and "Exchange" not in plan


def test_counts_are_partial_before_the_exchange(births):
    plan = plan_of(cl.count_where(births, a="id > 3", b=F.col("dob").isNull()))
    assert plan.count("Exchange") == 1 and "partial_count" in plan


def test_frame_diff_shuffles_partial_sums_once(births):
    plan = plan_of(cl.frame_diff(births, births.where("id > 3")))
    assert plan.count("Exchange") == 1 and "partial_sum" in plan
    assert plan.count("HashAggregate") == 2 and "Sort" not in plan


# --- skew --------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """Customers, and orders of which one customer holds a third."""
    customers = spark.range(0, 3000).withColumn("name", F.concat(F.lit("c"), F.col("id")))
    orders = spark.range(0, 60_000, 1, 24).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 3000).alias("customer_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    return customers, orders


def test_adaptive_execution_splits_a_hot_customer(spark, skewed):
    with settings(
        spark,
        spark_sql_autoBroadcastJoinThreshold="-1",
        spark_sql_adaptive_autoBroadcastJoinThreshold="-1",
        spark_sql_adaptive_advisoryPartitionSizeInBytes="128k",
        spark_sql_adaptive_skewJoin_skewedPartitionThresholdInBytes="256k",
        spark_sql_adaptive_skewJoin_skewedPartitionFactor="2",
    ):
        joined = cl.join_on(*skewed).withColumn("task", F.spark_partition_id())
        rows = joined.collect()
        assert "skew=true" in plan_of(joined)
    hot_tasks = Counter(row.task for row in rows if row.customer_id == 7)
    assert len(rows) == 60_000
    assert len(hot_tasks) > 3 and max(hot_tasks.values()) < 7_000


def test_hot_keys_are_dealt_out_without_adaptive_execution(spark, skewed):
    customers, orders = skewed
    with settings(
        spark, spark_sql_adaptive_enabled="false", spark_sql_autoBroadcastJoinThreshold="-1"
    ):
        assert max(partition_sizes(cl.join_on(customers, orders))) > 20_000
        hot = cl.heavy_keys(orders, "customer_id", share=0.1)
        assert hot == {7: 20_020}
        by_key = orders.repartition(24, "customer_id")
        for placed in (orders, by_key):
            dealt = cl.join_on(customers, placed, hot_keys=hot, slice_rows=1000)
            assert "SortMergeJoin" in plan_of(dealt)
            assert max(partition_sizes(dealt)) < 15_000
            assert cl.frames_equal(dealt, cl.join_on(customers, orders))


def test_hot_keys_on_the_left_are_dealt_out(spark, skewed):
    customers, orders = skewed
    few = customers.select(F.col("id").alias("customer_id"), "name")
    with settings(
        spark, spark_sql_adaptive_enabled="false", spark_sql_autoBroadcastJoinThreshold="-1"
    ):
        hot = cl.heavy_keys(orders, "customer_id", share=0.1)
        plain = cl.join_on(orders, few, "customer_id", "customer_id")
        dealt = cl.join_on(
            orders, few, "customer_id", "customer_id", hot_left_keys=hot, slice_rows=1000
        )
        assert max(partition_sizes(plain)) > 20_000 and max(partition_sizes(dealt)) < 15_000
        assert cl.frames_equal(dealt, plain)


@pytest.fixture(scope="module")
def hot_on_both(spark):
    """One customer has 100 visits and 2,000 orders, and so 200,000 rows of the join."""
    visits = spark.range(0, 400, 1, 3).select(
        F.when(F.col("id") % 4 == 0, 7).otherwise(F.col("id")).alias("id"), F.col("id").alias("visit")
    )
    orders = spark.range(0, 6_000, 1, 4).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 400).alias("customer_id"),
    )
    return visits, orders


@pytest.mark.parametrize("turned", [False, True])
def test_a_key_that_is_hot_on_both_sides_is_spread_evenly(spark, hot_on_both, monkeypatch, turned):
    sides = [(hot_on_both[0], "id"), (hot_on_both[1], "customer_id")][:: -1 if turned else 1]
    (left, left_key), (right, right_key) = sides
    ours, theirs = cl.heavy_keys(left, left_key, 0.1), cl.heavy_keys(right, right_key, 0.1)
    assert list(ours) == list(theirs) == [7]
    plain = cl.join_on(left, right, left_key, right_key)
    # Adaptive execution sees few rows to join, and leaves them to one task.
    dealt = cl.join_on(left, right, left_key, right_key, hot_keys=theirs, hot_left_keys=ours, slice_rows=250)
    assert plan_of(dealt).count("BroadcastHashJoin") >= 1
    assert max(partition_sizes(dealt)) < 40_000
    assert cl.frames_equal(dealt, plain)
    # Slices of many rows: the tasks go by the rows that they make.
    monkeypatch.setattr(joins, "_TASK_ROWS", 10_000)
    dealt = cl.join_on(left, right, left_key, right_key, hot_keys=theirs, hot_left_keys=ours)
    assert max(partition_sizes(dealt)) < 20_000
    assert cl.frames_equal(dealt, plain)
    # Too many rows for a broadcast.
    with settings(
        spark,
        spark_sql_adaptive_enabled="false",
        spark_sql_autoBroadcastJoinThreshold="-1",
        spark_sql_shuffle_partitions="20",
    ):
        dealt = cl.join_on(
            left, right, left_key, right_key, hot_keys=theirs, hot_left_keys=ours, broadcast_rows=99
        )
        assert "BroadcastHashJoin" not in plan_of(dealt)
        assert max(partition_sizes(dealt)) < 100_000
        assert cl.frames_equal(dealt, plain)


def test_rows_of_a_key_that_is_hot_on_both_sides_take_little_space(spark, tmp_path):
    visits = spark.range(0, 2_001, 1, 3).select(F.lit(7).alias("id"), F.col("id").alias("visit"))
    orders = spark.range(0, 2_100, 1, 4).select(F.col("id").alias("order_id"), F.lit(7).alias("customer_id"))
    joined = cl.join_on(visits, orders, hot_keys={7: 2_100}, hot_left_keys={7: 2_001})
    joined.write.parquet(f"{tmp_path}/joined")
    written = spark.read.parquet(f"{tmp_path}/joined")
    seen = written.agg(F.count("*"), F.count_distinct("visit", "order_id")).first()
    assert tuple(seen) == (2_001 * 2_100, 2_001 * 2_100)
    # Each visit comes with each order: without care for their turn its number takes a byte or two.
    assert sum(f.stat().st_size for f in (tmp_path / "joined").glob("*.parquet")) < 0.5 * seen[0]


@pytest.mark.parametrize("turned", [False, True])
@pytest.mark.parametrize("counted", [{7: 100, 8: 20}, {7: 30, 8: 90}, {7: 1, 8: 900}])
def test_chunks_hold_every_pair_of_rows_once(spark, monkeypatch, counted, turned):
    # Copies of rows, odd numbers of rows, and names that the helper columns would take.
    visits = spark.range(0, 143, 1, 3).select(
        F.when(F.col("id") < 101, 7).when(F.col("id") < 122, 8).otherwise(F.col("id")).alias("id"),
        (F.col("id") % 50).alias("__place"),
        F.lit("v").alias("__of_many"),
    )
    orders = spark.range(0, 900, 1, 4).select(
        F.col("id").alias("__of_few"), F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 143).alias("customer_id")
    )
    sides = [(visits, "id"), (orders, "customer_id")][:: -1 if turned else 1]
    (left, left_key), (right, right_key) = sides
    hot = [counted, {7: 450, 8: 2_000}][:: -1 if turned else 1]
    monkeypatch.setattr(joins, "_CHUNK_ROWS", 10)
    dealt = cl.join_on(left, right, left_key, right_key, hot_keys=hot[1], hot_left_keys=hot[0])
    plain = cl.join_on(left, right, left_key, right_key)
    assert dealt.columns == plain.columns and plain.count() > 45_000
    assert cl.frames_equal(dealt, plain)
    assert len(partition_sizes(dealt)) > 9
    itself = cl.join_on(visits, visits, "id", "id", hot_keys=counted, hot_left_keys=counted)
    assert cl.frames_equal(itself, cl.join_on(visits, visits, "id", "id"))


def test_heavy_keys_scans_once(spark, skewed, database):
    skewed[1].write.saveAsTable(f"{database}.orders")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("heavy", "heavy")
    cl.heavy_keys(spark.table(f"{database}.orders"), "customer_id")
    jobs = tracker.getJobIdsForGroup("heavy")
    scans = {s for j in jobs for s in tracker.getJobInfo(j).stageIds}
    assert len(scans) <= 3
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_join_is_not_forced_to_broadcast(spark, skewed):
    with settings(
        spark,
        spark_sql_autoBroadcastJoinThreshold="-1",
        spark_sql_adaptive_autoBroadcastJoinThreshold="-1",
    ):
        assert "Broadcast" not in plan_of(cl.join_on(*skewed))


def test_join_of_bucketed_tables_needs_no_shuffle(spark, skewed, database):
    for frame, name, key in zip(skewed, ("customers", "orders"), ("id", "customer_id")):
        frame.write.bucketBy(4, key).sortBy(key).saveAsTable(f"{database}.{name}")
    with settings(spark, spark_sql_autoBroadcastJoinThreshold="-1"):
        joined = cl.join_on(spark.table(f"{database}.customers"), spark.table(f"{database}.orders"))
        assert "SortMergeJoin" in plan_of(joined) and "Exchange" not in plan_of(joined)
        assert joined.count() == 60_000


def test_compact_layout_is_left_to_adaptive_execution(spark, births):
    plan = plan_of(cl.arrange(births, "compact"))
    assert plan.count("Exchange") == 1 and "REBALANCE_PARTITIONS_BY_NONE" in plan
    with settings(spark, spark_sql_adaptive_enabled="false"):
        with pytest.raises(ValueError, match="adaptive"):
            cl.arrange(births, "compact")


def test_age_range_reaches_the_scan_with_both_bounds(births):
    plan = plan_of(births.where(cl.age_between("dob", 16, 17, AS_OF)).select("id"))
    assert "LessThanOrEqual(dob,2010-06-15)" in plan and "GreaterThan(dob,2008-06-15)" in plan


def test_bucketed_join_needs_no_shuffle_after_an_in_place_job(spark, skewed, database):
    customers, orders = skewed
    customers.withColumn("dob", F.to_date(F.lit("2000-01-01"))).write.bucketBy(4, "id").sortBy(
        "id"
    ).saveAsTable(f"{database}.customers")
    orders.write.bucketBy(4, "customer_id").sortBy("customer_id").saveAsTable(f"{database}.orders")
    for _ in range(2):
        cl.preset("drive16_in_place", database, as_of=AS_OF).run(spark)
    with settings(spark, spark_sql_autoBroadcastJoinThreshold="-1"):
        joined = cl.join_on(spark.table(f"{database}.customers"), spark.table(f"{database}.orders"))
        assert "Exchange" not in plan_of(joined) and joined.count() == 60_000


def test_projection_jobs_write_without_a_shuffle(births):
    for name in ("drive16", "drive18_drink21", "drive_status", "full_name"):
        job = cl.preset(name, "any")
        assert "Exchange" not in plan_of(cl.arrange(job.transform(births), job.layout))
