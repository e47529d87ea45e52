"""The customers and orders tables, derived from the TPC-H-like test tables.

The test tables have no birth dates or separate names, so those are derived
from the key and the full name, with nulls among them, over all rows. The
expressions mean the same in Spark and DuckDB.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from clientele.sinks import drop_table

CUSTOMER_COLUMNS = """
    c_custkey AS id,
    CASE WHEN c_custkey % 13 <> 5 THEN split_part(c_name, '#', 1) END AS first_name,
    CASE WHEN c_custkey % 11 <> 3 THEN split_part(c_name, '#', 2) END AS last_name,
    CASE WHEN c_custkey % 17 <> 0
         THEN date '1940-01-01' + cast((c_custkey * 7919) % 34000 AS int) END AS dob,
    c_nationkey AS nation,
    c_mktsegment AS segment
"""

ORDER_COLUMNS = """
    o_orderkey AS id,
    o_custkey AS customer_id,
    o_orderstatus AS status,
    o_totalprice AS total,
    o_orderdate AS ordered_at
"""

MEMBER_COLUMNS = CUSTOMER_COLUMNS.replace("AS dob", "AS born")

VIEWS = {
    "customers": (CUSTOMER_COLUMNS, "customer"),
    "members": (MEMBER_COLUMNS, "customer"),
    "orders": (ORDER_COLUMNS, "orders"),
}


def parquet_sql(columns: str, sf_dir: str, table: str) -> str:
    return f"SELECT {columns} FROM parquet.`{sf_dir}/{table}.parquet`"


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(parquet_sql(CUSTOMER_COLUMNS, sf_dir, "customer"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(parquet_sql(ORDER_COLUMNS, sf_dir, "orders"))


#: Databases made by ``scratch_database`` in this process.
_MADE: set[str] = set()


def scratch_database(spark: SparkSession) -> str:
    """A new database in the shared folder the session names for checkpoints, or in its
    warehouse. Tables in it have to outlive the call, since the results are lazy;
    ``drop_scratch`` removes them."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    name, root = f"w_{uuid.uuid4().hex}", root.rstrip("/")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{root}/{name}'")
    _MADE.add(name)
    return name


def drop_scratch(spark: SparkSession) -> None:
    """Drop the databases that ``scratch_database`` made, with their files. Results that
    read them can no longer be run."""
    for name in sorted(_MADE):
        for table in spark.catalog.listTables(name):
            if table.tableType != "VIEW":
                drop_table(spark, f"{name}.{table.name}")
        spark.sql(f"DROP DATABASE {name} CASCADE")
        _MADE.remove(name)


def catalog_views(spark: SparkSession, sf_dir: str, *names: str) -> str:
    """A database with the named tables as views: nothing is copied."""
    database = scratch_database(spark)
    for name in names:
        columns, table = VIEWS[name]
        spark.sql(f"CREATE VIEW {database}.{name} AS {parquet_sql(columns, sf_dir, table)}")
    return database


def catalog_tables(spark: SparkSession, sf_dir: str, bucketed: bool = False) -> str:
    """A database with customers as a stored table, to be overwritten."""
    database = scratch_database(spark)
    writer = customers(spark, sf_dir).write
    if bucketed:
        writer = writer.bucketBy(8, "id").sortBy("id")
    writer.saveAsTable(f"{database}.customers")
    return database


#: One customer of the orders below has every third order, at any scale; every hundredth
#: customer row repeats as the hot one, so that both sides of the join have a hot key.
HOT_CUSTOMER = 7
HOT_ORDERS = ORDER_COLUMNS.replace(
    "o_custkey AS customer_id",
    f"CASE WHEN o_orderkey % 3 = 0 THEN {HOT_CUSTOMER} ELSE o_custkey END AS customer_id",
)
HOT_VISITS = f"""
    CASE WHEN c_custkey % 100 = 0 THEN {HOT_CUSTOMER} ELSE c_custkey END AS id,
    c_custkey AS visit,
    c_name AS name
"""


def hot_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(parquet_sql(HOT_ORDERS, sf_dir, "orders"))


def hot_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(parquet_sql(HOT_VISITS, sf_dir, "customer"))
