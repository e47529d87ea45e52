import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import clientele as cl
from tests.helpers import partition_sizes, settings

NAMES = "first_name string, last_name string"


@pytest.mark.parametrize(
    "first, last, strict, safe",
    [
        ("A", "B", "AB", "A B"),
        (None, "B", None, " B"),
        ("A", None, None, "A "),
        (None, None, None, " "),
        ("", "", "", " "),
    ],
)
def test_full_names(spark, first, last, strict, safe):
    df = spark.createDataFrame([(first, last)], NAMES)
    assert cl.add_full_name(df).collect() == [(first, last, strict)]
    safe_df = cl.add_full_name(df, sep=" ", null_safe=True)
    assert safe_df.collect() == [(first, last, safe)]
    assert cl.add_full_name(df).schema["full_name"].nullable
    assert not safe_df.schema["full_name"].nullable


def test_full_name_of_other_columns(spark):
    df = spark.createDataFrame([("A", "B")], "given string, family string")
    named = cl.add_full_name(df, "family", "given", name="label", sep=", ")
    assert named.collect() == [("A", "B", "B, A")]


def test_select_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "c int, a int, b int")
    assert cl.select_columns(df, "b", "c").collect() == [(3, 1)]
    assert cl.select_columns(df).columns == ["a", "b", "c"]


def test_require_columns_passes_the_frame_through(spark):
    df = spark.range(1)
    assert cl.require_columns(df, "id") is df
    with pytest.raises(ValueError, match="'ID'"):
        cl.require_columns(df, "ID")


# --- counts ------------------------------------------------------------------


def test_counts(spark):
    df = spark.createDataFrame([(1, True), (1, True), (2, False), (3, None)], "a int, b boolean")
    assert cl.count_rows(df).collect() == [(4,)]
    assert cl.count_rows(df.limit(0), name="n").collect() == [(0,)]
    counts = cl.count_where(df, ones="a = 1 AND b = true", yes=F.col("b"), none=F.col("b").isNull())
    assert counts.collect()[0].asDict() == {"ones": 2, "yes": 2, "none": 1}


# --- order -------------------------------------------------------------------


def test_sort_and_first(spark):
    df = spark.createDataFrame([(2, "b"), (None, "n"), (1, "z"), (1, "a")], "k int, v string")
    df = df.repartition(3)
    assert cl.sort_rows(df, "k").columns == ["k", "v"]
    assert [r.k for r in cl.sort_rows(df, "k").collect()] == [None, 1, 1, 2]
    assert cl.sort_rows(df).collect() == [(None, "n"), (1, "a"), (1, "z"), (2, "b")]
    assert cl.sort_rows(df, F.col("k").desc(), "v").collect() == [
        (2, "b"), (1, "a"), (1, "z"), (None, "n"),
    ]
    assert cl.first_row(df, F.col("k").desc()).collect() == [(2, "b")]
    assert cl.first_row(df.limit(0), "k").collect() == []


def test_sort_spreads_copies_of_one_row(spark):
    rows = spark.range(0, 30_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k")
    )
    with settings(spark, spark_sql_adaptive_enabled="false"):
        assert max(partition_sizes(rows.orderBy("k"))) >= 10_000
        assert max(partition_sizes(cl.sort_rows(rows, "k"))) < 7_500
        result = [r.k for r in cl.sort_rows(rows, "k").collect()]
    assert result == sorted(result) and len(result) == 30_000


# --- comparison --------------------------------------------------------------


def test_frame_diff_counts_surplus_copies_on_each_side(spark):
    rows = [(1, "a"), (1, "a"), (1, "a"), (2, None), (3, "c")]
    left = spark.createDataFrame(rows, "k int, v string")
    right = spark.createDataFrame([("a", 1), (None, 2), ("d", 4), ("d", 4)], "v string, k int")
    result = cl.frame_diff(left, right)
    assert result.columns == ["k", "v", "side", "copies"]
    assert sorted(result.collect()) == [
        (1, "a", "left", 2), (3, "c", "left", 1), (4, "d", "right", 2),
    ]
    assert not cl.frames_equal(left, right)


def test_frame_diff_agrees_with_except_all(spark):
    left = spark.range(0, 5000).select((F.col("id") % 37).alias("a"), (F.col("id") % 5).alias("b"))
    right = spark.range(0, 4000).select((F.col("id") % 41).alias("a"), (F.col("id") % 5).alias("b"))
    for side, one, other in (("left", left, right), ("right", right, left)):
        expected = one.exceptAll(other).groupBy("a", "b").count()
        actual = cl.frame_diff(left, right).where(F.col("side") == side).drop("side")
        assert sorted(actual.collect()) == sorted(expected.collect())


def test_frame_diff_of_odd_column_names(spark):
    left = spark.createDataFrame([(1, 2)], ["a.b", "c d"])
    assert cl.frame_diff(left, left.limit(0)).collect() == [(1, 2, "left", 1)]
    assert cl.frame_diff(left, left.limit(0)).columns == ["a.b", "c d", "side", "copies"]


def test_frames_equal_ignores_row_and_column_order(spark):
    left = spark.createDataFrame([(1, None), (2, "b"), (2, "b")], "k int, v string")
    assert cl.frames_equal(left, left.orderBy(F.col("k").desc()).select("v", "k"))
    assert not cl.frames_equal(left, left.distinct())
    assert not cl.frames_equal(left, left.withColumnRenamed("v", "w"))
    with pytest.raises(ValueError, match="Column names differ"):
        cl.frame_diff(left, left.drop("v"))
    with pytest.raises(ValueError, match="taken"):
        cl.frame_diff(*[left.withColumnRenamed("v", "Side")] * 2)


def test_frames_of_unlike_types_are_unequal(spark):
    def one(value, kind):
        return spark.createDataFrame([(value,)], f"k {kind}")

    assert not cl.frames_equal(one(1, "int"), one("1", "string"))
    assert not cl.frames_equal(one(1, "int"), one("x", "string"))
    assert not cl.frames_equal(one(True, "boolean"), one(1, "int"))
    assert cl.frames_equal(one(1, "int"), one(1, "bigint"))
    assert not cl.frames_equal(one(1, "int"), one(2, "bigint"))
    assert cl.frames_equal(one([1], "array<int>"), one([1], "array<bigint>"))
    assert not cl.frames_equal(one([1], "array<int>"), one(["1"], "array<string>"))
    with pytest.raises(ValueError, match="types differ"):
        cl.frame_diff(one(1, "int"), one("1", "string"))


# --- join --------------------------------------------------------------------


@pytest.fixture(scope="module")
def sides(spark):
    customers = spark.createDataFrame(
        [(1, "Ada", "x"), (2, "Bo", "y"), (None, "None", "z"), (4, "Di", "w"), (1, "Ada 2", "v")],
        "id bigint, name string, note string",
    )
    orders = spark.createDataFrame(
        [(10, 1, "o1"), (11, 1, "o2"), (12, 4, "o3"), (13, None, "o4"), (14, 9, "o5")],
        "ID bigint, customer_id bigint, note string",
    )
    return customers, orders


JOINED = [
    (1, "Ada", "x", 10, 1, "o1"),
    (1, "Ada", "x", 11, 1, "o2"),
    (1, "Ada 2", "v", 10, 1, "o1"),
    (1, "Ada 2", "v", 11, 1, "o2"),
    (4, "Di", "w", 12, 4, "o3"),
]


@pytest.mark.parametrize("left", [None, {1: 2}, {4: 9, 77: 3}])
@pytest.mark.parametrize("right", [None, {1: 2}, {1: 7, 4: 3}, {77: 5}])
def test_join_keeps_all_columns_and_can_be_saved(spark, sides, database, left, right):
    joined = cl.join_on(
        *sides, prefix="order_", hot_keys=right, hot_left_keys=left, slice_rows=1
    )
    assert joined.columns == ["id", "name", "note", "order_ID", "customer_id", "order_note"]
    assert sorted(joined.collect()) == JOINED
    cl.overwrite_table(joined, f"{database}.gold")
    assert sorted(spark.table(f"{database}.gold").collect()) == JOINED


@pytest.mark.parametrize("hot_keys", [None, {1: 5}])
@pytest.mark.parametrize("key", ["id", "ID"])
def test_join_on_equally_named_keys(sides, key, hot_keys):
    customers, _ = sides
    joined = cl.join_on(customers, customers, "id", key, prefix="other_", hot_keys=hot_keys, slice_rows=2)
    assert joined.columns == ["id", "name", "note", "other_id", "other_name", "other_note"]
    assert joined.count() == 6


def test_join_keys_belong_to_their_own_side(sides):
    customers, orders = sides
    for keys in (("customer_id", "customer_id"), ("id", "name"), ("id", "nothing")):
        with pytest.raises(AnalysisException):
            cl.join_on(customers, orders, *keys, prefix="order_")


def test_join_refuses_a_prefix_that_collides(spark, sides):
    customers, orders = sides
    with pytest.raises(ValueError, match="order_note"):
        cl.join_on(customers.withColumn("order_note", F.lit(1)), orders, prefix="order_")
    with pytest.raises(ValueError, match="already in use"):
        cl.join_on(customers, orders, prefix="")
    with pytest.raises(ValueError, match="slice_rows"):
        cl.join_on(customers, orders, prefix="order_", hot_keys={1: 5}, slice_rows=0)


def test_helper_columns_take_no_name_that_is_in_use(spark):
    left = spark.createDataFrame([(1, "a", "b")], "id int, __left string, __right_ string")
    right = spark.createDataFrame([(1, "c"), (1, "d")], "customer_id int, __right string")
    joined = cl.join_on(left, right, hot_keys={1: 2}, slice_rows=1)
    assert sorted(joined.collect()) == [(1, "a", "b", 1, "c"), (1, "a", "b", 1, "d")]
    tied = left.withColumnsRenamed({"__left": "__tie", "__right_": "__weight"})
    assert cl.sort_rows(tied).columns == tied.columns
    assert cl.frame_diff(tied, tied.limit(0)).collect()[0]["__weight"] == "b"


def test_heavy_keys(spark):
    third = F.col("id") % 3
    key = F.when(third == 0, 7).when(third == 1, None).otherwise(F.col("id"))
    rows = spark.range(0, 900).select(key.alias("k"))
    assert cl.heavy_keys(rows, "k", share=0.1) == {7: 300}
    assert cl.heavy_keys(rows, "k", share=0.5) == {}
    assert cl.heavy_keys(rows.limit(0), "k") == {}
    with pytest.raises(ValueError):
        cl.heavy_keys(rows, "k", share=0)


# --- layout ------------------------------------------------------------------


def test_layout_keeps_rows(spark):
    df = spark.range(0, 1000, 1, 5)
    for layout in (None, "compact", 2, 8):
        assert cl.frames_equal(cl.arrange(df, layout), df)
    assert cl.arrange(df, None) is df
    for n in (2, 3, 8):
        assert cl.arrange(df, n).rdd.getNumPartitions() == n


@pytest.mark.parametrize("layout", [1, 0, -3, True, "single", 2.0])
def test_layout_refuses_one_partition_and_nonsense(spark, layout):
    with pytest.raises(ValueError, match="layout must be"):
        cl.arrange(spark.range(1), layout)
