"""The customer-order join."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from math import isqrt
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.operators.naming import free_name, row_hash
from clientele.operators.plan_text import shuffles


#: About so many rows of the result a task makes of keys that are hot on both sides.
_TASK_ROWS = 10_000_000
#: Of a key that is hot on both sides a task takes about so many broadcast rows, one of so many
#: chunks at most.
_CHUNK_ROWS, _MOST_CHUNKS = 512, 32


def join_on(
    left: DataFrame,
    right: DataFrame,
    left_key: str = "id",
    right_key: str = "customer_id",
    prefix: str = "right_",
    hot_keys: Mapping[Any, int] | None = None,
    hot_left_keys: Mapping[Any, int] | None = None,
    slice_rows: int = 1_000_000,
    broadcast_rows: int = 100_000,
) -> DataFrame:
    """Inner equi-join that keeps all columns of both sides, both keys included.

    Right columns whose name the left side already has get ``prefix``, so the
    result can be saved as a table. Null keys match nothing.

    Without hot keys there is no broadcast hint: Spark broadcasts a side only
    below its size threshold and otherwise sort-merges. A key that holds a
    large share of a side then makes one oversized partition, which adaptive
    execution splits at run time. Where that is off or does not reach, give such
    keys and their row counts (``heavy_keys`` finds both) in ``hot_keys`` for
    the right side and ``hot_left_keys`` for the left one. The join is split:

    * rows of all other keys are joined as without hot keys;
    * for keys that are hot on one side, the other side's rows are counted. Up
      to ``broadcast_rows``, they are broadcast, and the hot rows do not move;
    * for keys that are hot on both sides, whose result is far larger than either
      side, the side with fewer rows of them is broadcast up to the same bound, and
      the other's rows are spread evenly over tasks by the rows that they make. A task
      takes one chunk of the broadcast rows, as values that come round after a few hundred
      rows, and not after thousands, take a fraction of the space in a column file;
    * keys that have more rows than that on the other side are dealt over slices
      of about ``slice_rows`` rows, shorter ones where both sides are hot, and the
      other side's rows of those keys are repeated to match.
    """
    if slice_rows < 1:
        raise ValueError("slice_rows must be 1 or more.")
    right, right_key = _rename_collisions(left, right, right_key, prefix)
    theirs, ours = dict(hot_keys or {}), dict(hot_left_keys or {})
    if not theirs and not ours:
        return left.join(right, left[left_key] == right[right_key], "inner")

    def of(df: DataFrame, key: str, keys: Iterable[Any]) -> DataFrame:
        return df.where(df[key].isin(list(keys)))

    def rest(df: DataFrame, key: str) -> DataFrame:
        return df.where(~df[key].isin([*{**theirs, **ours}]))

    cold_left, cold_right = rest(left, left_key), rest(right, right_key)
    parts = [cold_left.join(cold_right, cold_left[left_key] == cold_right[right_key], "inner")]
    both, dealt = set(theirs) & set(ours), set()
    from_left = {k for k in both if ours[k] <= theirs[k]}
    for big, big_key, small, small_key, keys, others, own in (
        (right, right_key, left, left_key, theirs, ours, set(theirs) - both),
        (left, left_key, right, right_key, ours, theirs, set(ours) - both),
        (right, right_key, left, left_key, theirs, ours, from_left),
        (left, left_key, right, right_key, ours, theirs, both - from_left),
    ):
        if not own:
            continue
        few = of(small, small_key, own)
        if few.limit(broadcast_rows + 1).count() > broadcast_rows:
            dealt |= own
            continue
        many = of(big, big_key, own)
        chunks = {k: _chunks(others[k]) for k in own} if own <= both else {}
        if own <= both or shuffles(big):
            # An earlier shuffle may have put a key's rows in one partition. Few rows of keys that
            # are hot on both sides make many, which Spark, sizing tasks by input, cannot see.
            made = {k: keys[k] * others.get(k, 1) // chunks.get(k, 1) for k in own}
            tasks = sum(max(-(-keys[k] // slice_rows), -(-made[k] // _TASK_ROWS)) for k in own)
            # Of frames in one partition a union is one partition, too.
            many = many.repartition(max(tasks, 2), row_hash(many))
        if max(chunks.values(), default=1) > 1:
            joined = _by_chunks(many, big_key, few, small_key, chunks)
        else:
            joined = many.join(F.broadcast(few), many[big_key] == few[small_key], "inner")
        parts.append(joined.select(*parts[0].columns))
    if dealt:
        parts.append(
            _deal(of(left, left_key, dealt), of(right, right_key, dealt), left_key, right_key, ours, theirs, slice_rows)
        )
    return reduce(DataFrame.unionByName, parts)


def _chunks(rows: int) -> int:
    """In how many chunks so many rows are joined."""
    return max(1, min(-(-rows // _CHUNK_ROWS), _MOST_CHUNKS))


def _by_chunks(
    many: DataFrame, many_key: str, few: DataFrame, few_key: str, chunks: Mapping[Any, int]
) -> DataFrame:
    """Joins ``many`` with ``few``, which is broadcast, one chunk of each key's few rows to a task.

    The rows of ``many`` are shuffled once and read for each chunk. Rows are dealt to chunks by
    eights, as Parquet packs values by eights: chunks of whole eights look alike each time they
    come round. A wrong count of rows makes longer or shorter chunks.
    """
    place, own, other = (free_name(f"__{n}", many, few) for n in ("place", "of_few", "of_many"))
    few = few.withColumn(place, row_hash(few))
    few = few.withColumn(place, F.row_number().over(Window.partitionBy(few[few_key]).orderBy(place)) - 1)
    few = few.withColumn(own, F.pmod(F.floor(few[place] / 8), _number(few[few_key], chunks)).cast("int"))
    every = range(max(chunks.values()))
    many = reduce(DataFrame.unionByName, [many.withColumn(other, F.lit(n)) for n in every])
    matched = (many[many_key] == few[few_key]) & (many[other] == few[own])
    return many.join(F.broadcast(few), matched, "inner")


def _deal(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    ours: Mapping[Any, int],
    theirs: Mapping[Any, int],
    slice_rows: int,
) -> DataFrame:
    names = [free_name(f"__{n}", left, right) for n in ("left", "right", "left_", "right_")]
    our_slices, their_slices = _slices(ours, theirs, slice_rows), _slices(theirs, ours, slice_rows)
    left = _dealt(left, left_key, names[0], our_slices, names[1], their_slices)
    right = _dealt(right, right_key, names[3], their_slices, names[2], our_slices)
    matched = (
        (left[left_key] == right[right_key])
        & (left[names[0]] == right[names[2]])
        & (left[names[1]] == right[names[3]])
    )
    return left.join(right, matched, "inner").drop(*names)


def heavy_keys(df: DataFrame, key: str, share: float = 0.01) -> dict[Any, int]:
    """The key values that each hold more than ``share`` of all rows, with their row counts.

    Fewer than ``1 / share`` keys can do so, which bounds what reaches the
    driver. Reads the key column only, once, into a sketch of fixed size per
    task, so that keys are not shuffled. Counts are exact while there are few
    different keys, and may be over by a fifth of ``share`` else. Keys of types
    that the sketch does not take are counted one by one.
    """
    if not 0 < share < 1:
        raise ValueError("share must lie between 0 and 1.")
    most = int(1 / share) + 1
    column = F.col(key).alias("key")
    if isinstance(df.select(column).schema["key"].dataType, _SKETCHED):
        # A count is over by 4 rows in this many, at most.
        tracked = min(max(10_000, 20 * most), 1_000_000)
        top = f"approx_top_k(key, {most}, {tracked}) FILTER (WHERE key IS NOT NULL)"
        found = df.select(column).agg(F.expr(top).alias("top"), F.count("*").alias("total")).first()
        counts, total = {x["item"]: x["count"] for x in found["top"] or ()}, found["total"]
    else:
        seen = Observation()
        rows = df.groupBy(column).agg(F.count("*").alias("n"))
        rows = rows.observe(seen, F.sum("n").alias("total")).orderBy(F.col("n").desc()).limit(most)
        counts = {x["key"]: x["n"] for x in rows.collect()}
        total = seen.get["total"] or 0
    return {k: n for k, n in counts.items() if k is not None and n > total * share}


#: Types of which Spark's sketch of frequent items takes values.
_SKETCHED = (T.StringType, T.IntegralType, T.FractionalType, T.BooleanType, T.DateType, T.TimestampType)


def _slices(counts: Mapping[Any, int], others: Mapping[Any, int], rows: int) -> dict[Any, int]:
    """How many slices each key with more rows than a slice takes. Of keys that are hot on both
    sides a slice is so short that a pair of them makes about ``_TASK_ROWS`` rows at most."""
    short = min(rows, isqrt(_TASK_ROWS))
    sizes = {k: short if n * others.get(k, 0) > _TASK_ROWS else rows for k, n in counts.items()}
    return {key: -(-n // sizes[key]) for key, n in counts.items() if n > sizes[key]}


def _number(key: Column, slices: dict[Any, int]) -> Column:
    """How many slices a key has."""
    column = F.lit(1)
    for n in sorted(set(slices.values())):
        keys = [k for k, m in slices.items() if m == n]
        column = F.when(key.isin(keys), F.lit(n)).otherwise(column)
    return column


def _dealt(
    df: DataFrame, key: str, own: str, slices: dict[Any, int], other: str, others: dict[Any, int]
) -> DataFrame:
    """Rows of this side's hot keys go to one of their slices, rows of the other side's hot
    keys are repeated for each of theirs."""
    dealt = F.pmod(row_hash(df), _number(df[key], slices)).cast("int")
    every = F.sequence(F.lit(0), _number(df[key], others) - 1)
    return df.where(df[key].isNotNull()).withColumns(
        {own: dealt if slices else F.lit(0)}
    ).withColumn(other, F.explode(every) if others else F.lit(0))


def _rename_collisions(
    left: DataFrame, right: DataFrame, right_key: str, prefix: str
) -> tuple[DataFrame, str]:
    # Catalogs ignore case, so `ID` and `id` collide as well.
    taken = {c.lower() for c in left.columns}
    renames = {c: prefix + c for c in right.columns if c.lower() in taken}
    taken |= {c.lower() for c in right.columns}
    clash = sorted(new for new in renames.values() if new.lower() in taken)
    if clash:
        raise ValueError(f"Prefix {prefix!r} gives column names already in use: {clash}.")
    renamed_keys = {c.lower(): new for c, new in renames.items()}
    return right.withColumnsRenamed(renames), renamed_keys.get(right_key.lower(), right_key)
