"""Table overwrites.

Formats with snapshots overwrite a table in one step, each in its own way (``REPLACERS``).
For the others the new rows are written to a second table at a location of its own. Where
only rows change, or columns are added, the first table can be pointed at that location, so
that no reader ever finds it missing (``one_step``); else the second table takes the first
one's place by two renames in the catalog. The old files go last. A table with a location of its own
does not move when it is renamed, so that from the second overwrite on no file is moved or
copied, on object stores neither. The first overwrite of a table in the warehouse folder
renames that folder once: a step for a file system that renames, a copy of the old rows for
a store that does not.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.operators.layout import Layout, laid_out

# Name endings of the tables in a swap. Both get the id of the run, so that neither
# another job nor a killed job's remains are in the way.
_NEW, _OLD = "__clientele_new_", "__clientele_old_"
#: Marks a table whose location this module chose, so that its files are ours to delete.
_PLACED = "clientele.placed"


@dataclass(frozen=True)
class _Shape:
    """What a table is besides its rows and columns."""

    provider: str
    location: str
    external: bool
    partitions: tuple[str, ...] = ()
    buckets: int = 0
    bucket_columns: tuple[str, ...] = ()
    sort_columns: tuple[str, ...] = ()
    comment: str | None = None
    properties: dict[str, str] = field(default_factory=dict)
    #: Partitions as transforms of columns, where the format has these.
    transforms: tuple[str, ...] = ()


def overwrite_table(
    df: DataFrame,
    name: str,
    schema: str | None = None,
    layout: Layout = None,
    fmt: str | None = None,
    staged: bool = True,
    one_step: bool = False,
) -> None:
    """Replace the rows and the columns of a catalog table, or create it.

    ``layout`` sets the number of files, see ``operators.arrange``. ``fmt``
    defaults to the table's format, for a new table to the session's.

    The old rows stay until the new ones are complete, also if the job fails or
    the frame reads the table, by name or by path. The table keeps its
    partitioning, bucketing, sorting, comment and properties; a frame that
    lacks a column these need is refused. Its files come to lie beside where
    they were, and those it had are deleted. A job killed before the swap
    leaves its second table behind, to be dropped with ``drop_table``; one
    killed between the two renames is mended by ``restore_table``, which is
    tried first here. For the moment between them readers do not find the table.

    ``one_step`` points the table at the new files instead, where it has no
    partitions, keeps its format, and its columns come first and with the same
    types in the frame; elsewhere it makes no difference. Readers then find the
    table at every moment, at first with the old rows and nulls in new columns.

    Of formats with snapshots, Delta tables are overwritten with their option
    for a new schema and Iceberg tables replaced by a staged table. For others
    ``ValueError`` says that they cannot be replaced with a new schema in one step.

    ``staged=False`` drops the old rows first. It is for tables whose rows can
    be made again and that do not fit twice, and loses them if the job fails.
    """
    with laid_out(df, layout) as arranged:
        _overwrite(arranged, f"{schema}.{name}" if schema else name, fmt, staged, one_step)


def _overwrite(df: DataFrame, table: str, fmt: str | None, staged: bool, one_step: bool) -> None:
    spark = df.sparkSession
    restore_table(spark, table)
    if not spark.catalog.tableExists(table):
        _writer(df, fmt).saveAsTable(table)
        return
    shape = _shape_of(spark, table)
    provider = (fmt or shape.provider).lower()
    if provider in REPLACERS:
        _check_columns(df, shape)
        REPLACERS[provider](df, table, shape)
        return
    _check_columns(df, shape)
    if staged:
        added = _added_columns(spark.table(table), df) if one_step else None
        if added is not None and provider == shape.provider.lower() and not shape.partitions:
            _write_and_point(df, table, provider, shape, added)
        else:
            _write_and_swap(df, table, provider, shape)
        return
    writer = _writer(df, provider, shape).mode("overwrite")
    if shape.external:
        writer = writer.option("path", shape.location)
    writer.saveAsTable(table)
    _describe(spark, table, shape)


def restore_table(spark: SparkSession, name: str) -> bool:
    """Put the old table back if a swap was cut off between its two renames.
    Returns whether there was anything to restore."""
    if spark.catalog.tableExists(name):
        return False
    found = _remains(spark, name, _OLD)
    if not found:
        return False
    # A swap that was cut off still has its new table; other old tables are leftovers.
    cut = [x for x in found if x in _remains(spark, name, _NEW)] or found
    if len(cut) > 1:
        tables = ", ".join(_beside(name, _OLD + x) for x in cut)
        raise ValueError(f"{name} is gone, and any of these may be its last state: {tables}.")
    _rename(spark, _beside(name, _OLD + cut[0]), name)
    return True


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table together with its files, if the catalog or this module placed them."""
    if not spark.catalog.tableExists(name):
        return
    shape = _shape_of(spark, name)
    spark.sql(f"DROP TABLE {name}")
    if shape.external and _PLACED in shape.properties:
        _delete(spark, shape.location)


def _writer(df: DataFrame, fmt: str | None, shape: _Shape | None = None):
    writer = df.write
    if fmt:
        writer = writer.format(fmt)
    if shape and shape.partitions:
        writer = writer.partitionBy(*shape.partitions)
    if shape and shape.buckets:
        writer = writer.bucketBy(shape.buckets, *shape.bucket_columns)
        if shape.sort_columns:
            writer = writer.sortBy(*shape.sort_columns)
    return writer


def _check_columns(df: DataFrame, shape: _Shape) -> None:
    needed = {*shape.partitions, *shape.bucket_columns, *shape.sort_columns}
    lacking = sorted(needed - set(df.columns))
    if lacking:
        raise ValueError(f"The table is partitioned, bucketed or sorted by {lacking}, which the frame lacks.")


def _describe(spark: SparkSession, table: str, shape: _Shape, **more: str) -> None:
    if properties := {**shape.properties, **more}:
        pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")
    if shape.comment:
        spark.sql(f"COMMENT ON TABLE {table} IS {_quoted(shape.comment)}")


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


# --- formats with snapshots --------------------------------------------------


def _replace_delta(df: DataFrame, table: str, shape: _Shape) -> None:
    writer = _writer(df, "delta", shape).mode("overwrite")
    writer.option("overwriteSchema", "true").saveAsTable(table)


def _replace_staged(df: DataFrame, table: str, shape: _Shape) -> None:
    """``CREATE OR REPLACE``, which the format's catalogs stage and commit at once."""
    writer = df.writeTo(table).using(shape.provider)
    if partitions := [_transform(x) for x in shape.transforms or shape.partitions]:
        writer = writer.partitionedBy(*partitions)
    for key, value in shape.properties.items():
        writer = writer.tableProperty(key, value)
    writer.createOrReplace()
    if shape.comment:
        _describe(df.sparkSession, table, _Shape(shape.provider, "", False, comment=shape.comment))


def _refuse(df: DataFrame, table: str, shape: _Shape) -> None:
    raise ValueError(
        f"{table} is a {shape.provider} table, whose rows and columns cannot be replaced in one step. "
        "Overwrite it with the format's own writer, or give another format in fmt."
    )


#: How tables of a format with snapshots are replaced, by provider.
REPLACERS: dict[str, Callable[[DataFrame, str, _Shape], None]] = {
    "delta": _replace_delta,
    "iceberg": _replace_staged,
    "hudi": _refuse,
    "paimon": _refuse,
}


def _transform(text: str) -> Column:
    """A partition column, or a transform of one as the catalog writes it."""
    found = re.fullmatch(r"(\w+)\((?:(\d+), *)?([\w.`]+)\)", text.strip())
    if not found:
        return F.col(text.strip().strip("`"))
    name, number, column = found.groups()
    if name == "bucket" and number:
        return F.partitioning.bucket(int(number), column)
    if name in ("years", "months", "days", "hours") and not number:
        return getattr(F.partitioning, name)(column)
    raise ValueError(f"The partition transform {text} is not known here.")


# --- other formats -----------------------------------------------------------


def _added_columns(now: DataFrame, df: DataFrame) -> list[tuple[str, str]] | None:
    """Names and types of the columns that come behind the table's own; nothing if those are
    not the frame's first."""
    ours, new = now.schema.fields, df.schema.fields
    same = [(f.name.lower(), f.dataType) for f in ours] == [
        (f.name.lower(), f.dataType) for f in new[: len(ours)]
    ]
    return [(f.name, f.dataType.simpleString()) for f in new[len(ours) :]] if same else None


def _write_new(df: DataFrame, table: str, run: str, provider: str, shape: _Shape) -> tuple[str, str]:
    """Write the second table; its name and location."""
    new = _beside(table, _NEW + run)
    parent = shape.location.rstrip("/").rpartition("/")[0]
    leaf = re.sub(r"[^\w-]", "_", _parts(table)[-1].strip("`"))
    location = f"{parent}/{leaf}__{run}"
    try:
        _writer(df, provider, shape).option("path", location).saveAsTable(new)
    except Exception:
        _delete(df.sparkSession, location)
        raise
    return new, location


def _write_and_point(
    df: DataFrame, table: str, provider: str, shape: _Shape, added: list[tuple[str, str]]
) -> None:
    spark = df.sparkSession
    new, location = _write_new(df, table, uuid.uuid4().hex[:12], provider, shape)
    if added:
        columns = ", ".join(f"`{name}` {kind}" for name, kind in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(location)}")
    spark.catalog.refreshTable(table)
    if shape.external:
        _describe(spark, table, _Shape(provider, "", True), **{_PLACED: "true"})
    # Its files are the table's now.
    spark.sql(f"DROP TABLE {new}")
    _delete(spark, shape.location)


def _write_and_swap(df: DataFrame, table: str, provider: str, shape: _Shape) -> None:
    spark, run = df.sparkSession, uuid.uuid4().hex[:12]
    old = _beside(table, _OLD + run)
    new, _ = _write_new(df, table, run, provider, shape)
    _describe(spark, new, shape, **{_PLACED: "true"})
    _rename(spark, table, old)
    try:
        _rename(spark, new, table)
    except Exception:
        _rename(spark, old, table)
        raise
    spark.sql(f"DROP TABLE {old}")
    if shape.external:
        _delete(spark, shape.location)


def _shape_of(spark: SparkSession, table: str) -> _Shape:
    details: dict[str, str] = {}
    transforms: list[str] = []
    after = False
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        after = after or row.col_name.startswith("# Detailed")
        if after:
            details.setdefault(row.col_name, row.data_type)
        elif re.fullmatch(r"Part \d+", row.col_name):
            transforms.append(row.data_type)
    ours = {"transient_lastDdlTime", "numFiles", "totalSize", "numRows", "rawDataSize"}
    properties = {
        row.key: row.value
        for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
        if row.key not in ours and not row.key.startswith("spark.sql.")
    }
    comment = details.get("Comment") or properties.get("comment")
    properties.pop("comment", None)
    columns = spark.catalog.listColumns(table)
    return _Shape(
        provider=details.get("Provider", spark.conf.get("spark.sql.sources.default")),
        location=details.get("Location", ""),
        external=details.get("Type") == "EXTERNAL",
        partitions=tuple(c.name for c in columns if c.isPartition),
        buckets=int(details.get("Num Buckets", 0)),
        bucket_columns=_names(details.get("Bucket Columns")),
        sort_columns=_names(details.get("Sort Columns")),
        comment=comment,
        properties=properties,
        transforms=tuple(transforms),
    )


def _names(listed: str | None) -> tuple[str, ...]:
    return tuple(re.findall(r"`([^`]+)`", listed or ""))


def _remains(spark: SparkSession, table: str, suffix: str) -> list[str]:
    """The ids of the runs of which a table with this name ending is left."""
    *database, leaf = _parts(table)
    start = leaf.strip("`").lower() + suffix
    where = f" IN {'.'.join(database)}" if database else ""
    if database and not spark.catalog.databaseExists(".".join(database)):
        return []
    # Of a large database only the table's own remains are listed.
    like = _quoted(re.sub(r"\W", "*", start) + "*")
    names = [row.tableName.lower() for row in spark.sql(f"SHOW TABLES{where} LIKE {like}").collect()]
    return sorted(n[len(start) :] for n in names if n.startswith(start))


def _parts(table: str) -> list[str]:
    return re.findall(r"`[^`]+`|[^.`]+", table)


def _beside(table: str, suffix: str) -> str:
    """A table name in the same database; either may be in backquotes."""
    return f"{table[:-1]}{suffix}`" if table.endswith("`") else table + suffix


def _rename(spark: SparkSession, old: str, new: str) -> None:
    # The new name is read relative to the old one's catalog.
    spark.sql(f"ALTER TABLE {old} RENAME TO {'.'.join(_parts(new)[-2:])}")


def _delete(spark: SparkSession, location: str) -> None:
    """Delete the files at a location by SQL alone, so that it also works from a remote
    client: a database that lies there takes them along when it is dropped."""
    name = f"spark_catalog.clientele_gone_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION {_quoted(location)}")
    spark.sql(f"DROP DATABASE {name}")
