"""Results when tasks fail and run again, on a session that allows retries."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import tempfile
from collections import Counter

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

import clientele as cl

spark = (
    SparkSession.builder.master("local[4,3]")
    .config("spark.sql.shuffle.partitions", "6")
    .config("spark.sql.autoBroadcastJoinThreshold", "-1")
    .config("spark.sql.adaptive.enabled", "false")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-"))
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")


def fail_once(batches):
    context = TaskContext.get()
    for batch in batches:
        yield batch
    if context.attemptNumber() == 0 and context.partitionId() % 3 == 0:
        raise RuntimeError("lost after giving its rows")


def shaky(df):
    return df.mapInArrow(fail_once, df.schema)


def attempts(batches):
    for _ in batches:
        yield pd.DataFrame({"attempt": [TaskContext.get().attemptNumber()]})


orders = spark.range(0, 6000, 1, 12).select(
    F.col("id").alias("order_id"),
    F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("customer_id"),
)
customers = spark.range(0, 500, 1, 6).withColumn("name", F.concat(F.lit("c"), "id"))
joined = customers.join(orders, F.col("id") == F.col("customer_id"))
expected = Counter(map(tuple, joined.collect()))

tried = shaky(orders).mapInPandas(attempts, "attempt int").collect()
assert Counter(row.attempt for row in tried) == {0: 8, 1: 4}

dealt = cl.join_on(shaky(customers), shaky(orders), hot_keys={7: 2000}, hot_left_keys={7: 900}, slice_rows=400)
assert Counter(map(tuple, dealt.collect())) == expected

keys = [row.customer_id for row in cl.sort_rows(shaky(orders), "customer_id").collect()]
assert len(keys) == 6000 and keys == sorted(keys)

assert cl.frames_equal(shaky(orders), orders)

for layout in (None, 5, "compact"):
    spark.conf.set("spark.sql.adaptive.enabled", str(layout == "compact").lower())
    cl.overwrite_table(orders, "orders_kept")
    cl.overwrite_table(shaky(spark.table("orders_kept")), "orders_kept", layout=layout)
    assert cl.frames_equal(spark.table("orders_kept"), orders)

print("finished")
"""


def test_lost_tasks_change_nothing():
    root = Path(__file__).resolve().parent.parent
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=root, capture_output=True, text=True, timeout=300
    )
    assert run.returncode == 0, run.stderr[-3000:]
    assert "finished" in run.stdout
