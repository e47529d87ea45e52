"""Comparison by digests, split joins, ties, scans split by size, one-step overwrites, outcomes."""

import logging
import os
import threading
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

import clientele as cl
from clientele.operators.ordering import _has_heavy_key
from clientele.operators.plan_text import keeps_whole_files, shuffles
from clientele.sinks import tables as sink
from tests.helpers import AS_OF, partition_sizes, plan_of, settings


@pytest.fixture
def rows(spark, database):
    frame = spark.range(0, 20_000, 1, 8).select(
        "id", (F.col("id") % 50).cast("int").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("text")
    )
    frame.write.saveAsTable(f"{database}.rows")
    return spark.table(f"{database}.rows")


# --- digests -----------------------------------------------------------------


def test_digests_give_the_same_difference(spark, rows):
    changed = rows.withColumn("k", F.when(F.col("id") % 7001 == 0, -1).otherwise(F.col("k")))
    other = changed.where("id <> 11").union(changed.where("id IN (12, 13)"))
    for left, right in ((rows, other), (other, rows), (rows, rows), (rows, rows.limit(0)), (rows.limit(0), rows.limit(0))):
        for n in (1, 64, 4096):
            diffs = cl.frame_diff(left, right, digests=n), cl.frame_diff(left, right)
            assert sorted(diffs[0].collect()) == sorted(diffs[1].collect())
    assert cl.frame_diff(rows, other, digests=512).count() == 9
    with pytest.raises(ValueError, match="digests"):
        cl.frame_diff(rows, rows, digests=0)


def test_digests_of_other_types_and_names(spark):
    left = spark.createDataFrame([(1, 2.0, None), (1, 2.0, None)], "a int, `b.c` float, d string")
    right = spark.createDataFrame([(None, 2.0, 1), (None, 2.0, 1), (None, -0.0, 1)], "d string, `b.c` double, a bigint")
    diff = cl.frame_diff(left, right, digests=16)
    assert [tuple(r) for r in diff.collect()] == [(1, 0.0, None, "right", 1)]
    zeros = spark.createDataFrame([(0.0,)], "x double"), spark.createDataFrame([(-0.0,)], "x double")
    assert cl.frame_diff(*zeros, digests=4).isEmpty()
    same = cl.bucket_digests(left, 8), cl.bucket_digests(left.orderBy("a"), 8)
    assert cl.frames_equal(*same)


def test_equal_frames_shuffle_bucket_rows_only(spark, rows):
    diff = cl.frame_diff(rows, rows.where("id >= 0"), digests=64)
    assert diff.collect() == []
    plan = plan_of(diff)
    # The rows' own exchange gets none; the digests' exchanges at most a row a bucket and task.
    assert "LeftSemi" in plan and "BroadcastHashJoin" in plan


# --- joins -------------------------------------------------------------------


def test_hot_rows_stay_where_they_are(spark, rows):
    left = spark.range(0, 50).select(F.col("id").alias("id"), F.lit("x").alias("name"))
    hot = cl.heavy_keys(rows, "k", share=0.015)
    assert hot == {k: 400 for k in range(50)}
    right = rows.withColumn("customer_id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("k")))
    hot = {k: n for k, n in cl.heavy_keys(right, "customer_id", share=0.1).items()}
    assert list(hot) == [7]
    with settings(spark, spark_sql_autoBroadcastJoinThreshold="-1", spark_sql_adaptive_autoBroadcastJoinThreshold="-1"):
        joined = cl.join_on(left, right, hot_keys=hot, prefix="r_")
        plan = plan_of(joined)
        assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1
        assert cl.frames_equal(joined, cl.join_on(left, right, prefix="r_"))
        turned = cl.join_on(right, left.withColumnRenamed("id", "customer_id"), "customer_id", "customer_id", hot_left_keys=hot)
        assert turned.count() == joined.count()
        # Too many rows on the other side for a broadcast: they are dealt.
        many = left.unionAll(left).unionAll(left)
        for limit, broadcasts in ((3, 1), (2, 0)):
            dealt = cl.join_on(many, right, hot_keys=hot, prefix="r_", slice_rows=500, broadcast_rows=limit)
            assert plan_of(dealt).count("BroadcastHashJoin") == broadcasts
            assert cl.frames_equal(dealt, cl.join_on(many, right, prefix="r_"))


def test_heavy_keys_of_a_type_without_a_sketch(spark):
    rows = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.lit(b"a")).otherwise(F.col("id").cast("string").cast("binary")).alias("k"))
    assert {bytes(k): n for k, n in cl.heavy_keys(rows, "k", 0.1).items()} == {b"a": 300}


# --- order -------------------------------------------------------------------


def test_ties_are_cut_only_where_a_key_is_heavy(spark, rows):
    hot = rows.withColumn("k", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")))
    with settings(spark, spark_sql_shuffle_partitions="16", spark_sql_adaptive_enabled="false"):
        assert not _has_heavy_key(rows, ("id",)) and not _has_heavy_key(rows, (F.col("text").desc(),))
        assert _has_heavy_key(hot, ("k",)) and _has_heavy_key(hot, (F.col("k").desc_nulls_last(),))
        assert not _has_heavy_key(hot, ("k", "id")) and not _has_heavy_key(hot.limit(0), ("k",))
        assert "xxhash64" not in plan_of(cl.sort_rows(rows, "id"))
        for options in ({}, {"cut_ties": True}):
            ordered = cl.sort_rows(hot, "k", **options)
            assert "xxhash64" in plan_of(ordered) and max(partition_sizes(ordered)) < 4000
            keys = [r.k for r in ordered.collect()]
            assert keys == sorted(keys) and len(keys) == 20_000
        assert max(partition_sizes(cl.sort_rows(hot, "k", cut_ties=False))) > 6000


# --- layout ------------------------------------------------------------------


def files_of(spark, table):
    details = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    folder = urlparse(details["Location"]).path
    return [os.path.getsize(f"{folder}/{x}") for x in os.listdir(folder) if x.startswith("part-")]


def test_compact_projections_are_split_by_file_size(spark, rows, database):
    flagged = rows.withColumn("even", F.col("id") % 2 == 0)
    total = sum(files_of(spark, f"{database}.rows"))
    assert keeps_whole_files(flagged)
    for frame in (rows.select("id"), rows.where("k = 3"), rows.repartition(3), rows.union(rows), spark.range(3)):
        assert not keeps_whole_files(frame)
    assert shuffles(rows.repartition(3)) and not shuffles(rows.join(F.broadcast(spark.range(3)), "id"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in (10 * total, total // 3):
        with settings(spark, spark_sql_adaptive_advisoryPartitionSizeInBytes=str(size)):
            cl.overwrite_table(flagged, f"{database}.out", layout="compact")
        sizes = files_of(spark, f"{database}.out")
        assert max(sizes) < 2 * size and sum(sizes) / len(sizes) > min(size, total) / 2
        assert cl.frames_equal(spark.table(f"{database}.out"), flagged)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


# --- overwrites --------------------------------------------------------------


def test_a_reader_finds_the_table_at_every_moment(spark, rows, database):
    table, seen, done = f"{database}.rows", [], threading.Event()

    def poll():
        session = spark.newSession()
        while not done.is_set():
            seen.append((session.catalog.tableExists(table), session.table(table).columns))

    reader = threading.Thread(target=poll)
    reader.start()
    try:
        for n in (3, 2, 1):
            new = cl.read_table(spark, table).where(f"id >= {n}").withColumn(f"c{n}", F.lit(n))
            cl.overwrite_table(new, table, one_step=True)
    finally:
        done.set()
        reader.join()
    assert len(seen) > 5 and all(there for there, _ in seen)
    assert {len(columns) for _, columns in seen} <= {3, 4, 5, 6}
    assert spark.table(table).columns == ["id", "k", "text", "c3", "c2", "c1"]
    assert spark.table(table).count() == 19_997 and len(spark.catalog.listTables(database)) == 1


def test_one_step_where_it_cannot_be(spark, rows, database):
    table = f"{database}.rows"
    cl.overwrite_table(cl.read_table(spark, table).select("text", "id"), table, one_step=True)
    assert spark.table(table).columns == ["text", "id"]
    cl.overwrite_table(rows.sparkSession.table(table), table, fmt="orc", one_step=True)
    assert spark.table(table).count() == 20_000
    parts = f"{database}.parts"
    spark.table(table).withColumn("k", F.col("id") % 3).write.partitionBy("k").saveAsTable(parts)
    cl.overwrite_table(cl.read_table(spark, parts).where("id < 9"), parts, one_step=True)
    assert spark.table(parts).count() == 9
    failing = cl.read_table(spark, parts).withColumn("bad", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        cl.overwrite_table(failing, parts, one_step=True)
    assert spark.table(parts).count() == 9


def test_one_step_leaves_one_folder_and_keeps_the_shape(spark, rows, database, tmp_path):
    rows.write.option("path", f"{tmp_path}/mine").bucketBy(4, "id").sortBy("id").saveAsTable(f"{database}.b")
    for n in (5, 9):
        cl.overwrite_table(cl.read_table(spark, f"{database}.b").where(f"id >= {n}"), f"{database}.b", one_step=True)
        assert len(os.listdir(tmp_path)) == 1 and spark.table(f"{database}.b").count() == 20_000 - n
    with settings(spark, spark_sql_autoBroadcastJoinThreshold="-1"):
        assert "Exchange" not in plan_of(spark.table(f"{database}.b").groupBy("id").count())
    cl.drop_table(spark, f"{database}.b")
    assert os.listdir(tmp_path) == []


class StandIn:
    """Writes down what it is told, as a format that is not here would be."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args):
            self.calls.append((name, *args))
            return self

        return call


class StandInFrame:
    def __init__(self, spark):
        self.write, self.staged, self.sparkSession = StandIn(), StandIn(), spark

    def writeTo(self, table):
        self.staged.calls.append(("writeTo", table))
        return self.staged


def test_formats_with_snapshots(spark):
    shape = sink._Shape("iceberg", "", False, ("k",), properties={"a": "b"}, transforms=("k", "days(ts)", "bucket(4, id)"))
    frame = StandInFrame(spark)
    sink.REPLACERS["iceberg"](frame, "c.d.t", shape)
    names = [c[0] for c in frame.staged.calls]
    assert names == ["writeTo", "using", "partitionedBy", "tableProperty", "createOrReplace"] and not frame.write.calls
    assert [str(c) for c in frame.staged.calls[2][1:]] == ["Column<'k'>", "Column<'days(ts)'>", "Column<'bucket(4, id)'>"]
    frame = StandInFrame(spark)
    sink.REPLACERS["delta"](frame, "t", sink._Shape("delta", "", False, ("k",)))
    assert frame.write.calls == [("format", "delta"), ("partitionBy", "k"), ("mode", "overwrite"), ("option", "overwriteSchema", "true"), ("saveAsTable", "t")]
    for provider in ("hudi", "paimon"):
        frame = StandInFrame(spark)
        with pytest.raises(ValueError, match=f"t is a {provider} table"):
            sink.REPLACERS[provider](frame, "t", sink._Shape(provider, "", False))
        assert not frame.write.calls and not frame.staged.calls
    with pytest.raises(ValueError, match="truncate"):
        sink._transform("truncate(4, x)")


# --- outcomes ----------------------------------------------------------------


def test_outcome_of_a_run(spark, rows, database, caplog):
    def named(df):
        return df.select("id", F.when(F.col("k") > 4, F.col("text")).alias("odd. name"))

    job = cl.Pipeline("job", (f"{database}.rows",), f"{database}.out", named)
    for layout in (None, "compact", 3):
        job = cl.Pipeline("job", (f"{database}.rows",), f"{database}.out", named, layout=layout)
        with caplog.at_level(logging.INFO):
            outcome = job.run_observed(spark)
        assert outcome == cl.Outcome(True, 20_000, {"id": 0, "odd. name": 2000})
        assert "20000 rows, nulls: odd. name 2000" in caplog.text
    empty = cl.Pipeline("none", (f"{database}.rows",), f"{database}.none", lambda df: df.where("id < 0"))
    assert empty.run_observed(spark) == cl.Outcome(True, 0, {"id": 0, "k": 0, "text": 0})
    flawed = cl.Pipeline("bad", (f"{database}.rows",), f"{database}.bad", lambda df: df.where("nothing"), tolerates=(Exception,))
    outcome = flawed.run_observed(spark, on_error="log")
    assert not outcome.ok and "nothing" in str(outcome.error) and "bad failed" in caplog.text


def test_rows_are_counted_in_the_pass_that_writes_them(spark, rows, database):
    job = cl.Pipeline("once", (f"{database}.rows",), f"{database}.out", lambda df: df.withColumn("x", F.lit(1)))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("once", "once")
    job.run_observed(spark)
    tasks = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("once") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # One stage reads and writes; catalog statements run no job of several tasks.
    assert sum(t.numTasks > 1 for t in tasks if t) == 1


def test_a_job_is_never_without_its_table(spark, rows, database):
    born = rows.withColumn("dob", F.lit(AS_OF))
    born.write.saveAsTable(f"{database}.customers")
    job = cl.preset("drive16_in_place", database, as_of=AS_OF)
    renames = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(sink, "_rename", lambda *args: renames.append(args))
        assert job.run(spark) and job.run(spark)
    assert not renames and spark.table(f"{database}.customers").columns == ["id", "k", "text", "dob", "age", "canDrive"]
