"""Merkle manifest of a table: a hash per row, a root per group, a root of all.

1. Leaves are hashed in the JVM; only ids and hashes travel from there on.
2. The ids of each group become compressed bitmaps: 64 ids make a word, and a chunk of 4096
   ids holds the words that are not zero, a summary bitmap of which those are, and the
   number of rows before each. Counts of chunks are summed up along two more levels of
   2^18 and 2^17 children, so that every directory is of bounded size and none is global.
3. A leaf's place in its group is a rank query: the rows before its chunk, those before its
   word, and the bits set before its own. Leaves are not sorted.
4. Nodes go to slot arrays of 1024 places, keyed by group and place, which a task reduces
   by ten levels at once; the arrays' roots are the nodes of the next step. Paths come back
   the same way, from the root to the leaves.

Rows that share an id come in order of their hashes. Their places within an id are ranks
among the first three digits of the hash, then among what is left, so that no id has all
its rows in one task; copies of a row are counted and get places one after the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.arrow import slices
from clientele.llm.scratch import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels that a slot array takes up, and so the binary logarithm of its places.
LEVELS = 10
#: Chunk of a row without an id, before those of all ids.
_NO_ID = -(2**51) - 1


def digest(*parts: str) -> str:
    """Lowercase hex sha256 of the parts, joined."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(fields: Sequence[Column]) -> Column:
    """The hash of a row: each field's byte count, a colon and its value; ``-`` for null."""
    coded = [
        F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-"))
        for x in (c.cast("string") for c in fields)
    ]
    return F.sha2(F.concat(*coded), 256)


# --- places ------------------------------------------------------------------


def directory(leaves: DataFrame) -> DataFrame:
    """Chunks of the bitmaps of ``group, chunk, low``: ``group, chunk, base, summary, words``,
    where ``words`` has for each word that is not zero its bits, its rows, and the rows
    before it in the chunk; ``base`` is the number of rows of the group before the chunk."""
    words = leaves.groupBy("group", "chunk", F.expr("shiftright(low, 6)").alias("k")).agg(
        F.expr("bit_or(shiftleft(1L, low & 63))").alias("bits"), F.count("*").alias("n")
    )
    chunks = words.groupBy("group", "chunk").agg(
        F.sort_array(F.collect_list(F.struct("k", "bits", "n"))).alias("found"),
        F.expr("bit_or(shiftleft(1L, k))").alias("summary"),
        F.sum("n").alias("n"),
    )
    chunks = chunks.select(
        "group", "chunk", "n", "summary",
        F.expr("shiftright(chunk, 18)").alias("mid"),
        F.expr(
            "transform(found, (x, i) -> struct(x.bits AS bits, x.n AS n,"
            " aggregate(slice(found, 1, i), 0L, (sum, y) -> sum + y.n) AS before))"
        ).alias("words"),
    )
    chunks = stored(chunks, "chunks")
    mids = chunks.groupBy("group", "mid").agg(F.sum("n").alias("n"))
    mids = mids.withColumn("top", F.expr("shiftright(mid, 17)"))
    tops = mids.groupBy("group", "top").agg(F.sum("n").alias("n"))
    tops = tops.select("group", "top", _before(["group"], "top").alias("top_base"))
    mids = mids.select("group", "top", "mid", _before(["group", "top"], "mid").alias("mid_base"))
    mids = mids.join(tops, ["group", "top"]).select(
        "group", "mid", (F.col("mid_base") + F.col("top_base")).alias("mid_base")
    )
    chunks = chunks.withColumn("own_base", _before(["group", "mid"], "chunk"))
    return chunks.join(mids, ["group", "mid"]).select(
        "group", "chunk", (F.col("own_base") + F.col("mid_base")).alias("base"), "summary", "words"
    )


def _before(keys: list[str], order: str | list[str], n: str = "n") -> Column:
    """The sum of ``n`` over the rows before."""
    own = Window.partitionBy(*keys).orderBy(*([order] if isinstance(order, str) else order))
    return F.coalesce(F.sum(n).over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def places(leaves: DataFrame) -> DataFrame:
    """``group, pos, id, leaf, seen`` of ``group, chunk, low, id, leaf, seen``: ``pos`` counts
    a group's rows from 0, by id, rows without one first."""
    word = F.expr("words[bit_count(summary & ~shiftleft(-1L, shiftright(low, 6)))]")
    found = leaves.join(directory(leaves), ["group", "chunk"]).select(
        "group", "chunk", "low", "id", "leaf", "seen",
        (F.col("base") + word["before"]).alias("start"),
        word["bits"].alias("bits"),
        (word["n"] > F.bit_count(word["bits"])).alias("crowded"),
    )
    found = stored(
        found.withColumn("rank", F.expr("bit_count(bits & ~shiftleft(-1L, low & 63))")).drop("bits"),
        "ranks",
    )
    alone = found.where(~F.col("crowded")).select(
        "group", (F.col("start") + F.col("rank")).alias("pos"), "id", "leaf", "seen"
    )
    # Words in which an id has several rows.
    cell = ["group", "chunk", "start", "low", "head"]
    rows = (
        found.where("crowded")
        .groupBy(*cell[:-1], F.substring("leaf", 1, 3).alias("head"), "id", "leaf", "seen")
        .agg(F.count("*").alias("n"))
    )
    cells = rows.groupBy(*cell).agg(F.sum("n").alias("n"))
    cells = cells.select(*cell, _before(["group", "chunk", "start"], ["low", "head"]).alias("cell"))
    shared = rows.withColumn("own", _before(cell, ["leaf", "seen"])).join(cells, cell)
    first = F.col("start") + F.col("cell") + F.col("own")
    shared = shared.select(
        "group", F.explode(F.sequence(first, first + F.col("n") - 1)).alias("pos"), "id", "leaf", "seen"
    )
    return alone.union(shared)


# --- trees -------------------------------------------------------------------


def levels_of(n: int, most: int) -> int:
    """Levels that a step takes up in a group of ``n`` nodes."""
    return min(most, (n - 1).bit_length())


def reduced(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes and each level above them."""
    rows = [nodes]
    for _ in range(levels):
        nodes = [digest(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        rows.append(nodes)
    return rows


def siblings(rows: list[list[str]], slot: int) -> list[str]:
    """For each level the sibling of the slot's node, after ``L`` or ``R`` for its side, or
    ``-`` where there is none."""
    path = []
    for row in rows[:-1]:
        other = slot ^ 1
        path.append(("L" if slot & 1 else "R") + row[other] if other < len(row) else "-")
        slot >>= 1
    return path


def folded(node: str, path: list[str]) -> str:
    """The root that the node and its path lead to."""
    for step in path:
        if step == "-":
            node = digest(node)
        else:
            node = digest(step[1:], node) if step[0] == "L" else digest(node, step[1:])
    return node


def proof(path: list[str]) -> str:
    return digest(*(step[1:] for step in path))


def _steps(path: str) -> list[str]:
    return path.split(",") if path else []


class _Tree:
    """Slot arrays of the trees over ``group, pos, hash`` and ``group, n``."""

    def __init__(self, nodes: DataFrame, sizes: DataFrame, levels: int, extra: tuple[str, ...] = ()):
        self.levels, self.steps = levels, []
        most = sizes.agg(F.max("n")).first()[0] or 0
        while True:
            blocks = nodes.groupBy("group", F.expr(f"shiftright(pos, {levels})").alias("block")).agg(
                F.sort_array(
                    F.collect_list(
                        F.struct((F.col("pos") % 2**levels).cast("int").alias("slot"), "hash", *extra)
                    )
                ).alias("slots")
            )
            blocks = stored(blocks.join(sizes, "group"), "slots")
            self.steps.append(blocks)
            self.top = nodes = stored(self._roots(blocks), "nodes")
            if most <= 2**levels:
                return
            most = -(-most >> levels)
            sizes = sizes.select("group", F.ceil(F.col("n") / 2**levels).cast("bigint").alias("n"))
            extra = ()

    def _roots(self, blocks: DataFrame) -> DataFrame:
        most = self.levels

        def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                lists, sizes = batch.column(2).to_pylist(), batch.column(3).to_pylist()
                roots = [reduced(x, levels_of(n, most))[-1][0] for x, n in zip(lists, sizes)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(roots, pa.string())], ["group", "pos", "hash"]
                )

        return blocks.select("group", "block", F.col("slots.hash"), "n").mapInArrow(
            up, "group string, pos bigint, hash string"
        )

    def paths(self, upper: DataFrame) -> DataFrame:
        """The lowest arrays with ``path`` and ``root``, the way from the array's own root to
        the root of all, of ``group, path, root`` for the groups."""
        most = self.levels

        def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                columns = [batch.column(i).to_pylist() for i in range(len(batch.schema))]
                out: list[tuple] = []
                for group, block, hashes, n, path, root in zip(*columns):
                    rows, rest = reduced(hashes, levels_of(n, most)), _steps(path)
                    first = block << most
                    for slot in range(len(hashes)):
                        own = ",".join([*siblings(rows, slot), *rest])
                        out.append((group, first + slot, own, root))
                kinds = [pa.string(), pa.int64(), pa.string(), pa.string()]
                columns = zip(*out) if out else [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(columns, kinds)], ["group", "pos", "path", "root"]
                )

        upper = upper.withColumn("block", F.lit(0).cast("bigint"))
        for blocks in reversed(self.steps[1:]):
            known = blocks.join(upper, ["group", "block"])
            upper = known.select("group", "block", F.col("slots.hash"), "n", "path", "root").mapInArrow(
                down, "group string, block bigint, path string, root string"
            )
        return self.steps[0].join(upper, ["group", "block"])


def _ordered(subroots: DataFrame) -> DataFrame:
    """``group, pos, hash``: the groups counted in the order of their names, part by part."""
    names = stored(
        subroots.repartitionByRange("group").withColumn("part", F.spark_partition_id()), "groups"
    )
    parts = names.groupBy("part").agg(F.count("*").alias("n"))
    parts = parts.select("part", _before([], "part").alias("base"))
    own = F.row_number().over(Window.partitionBy("part").orderBy("group"))
    return names.withColumn("own", own).join(parts, "part").select(
        F.col("group").alias("name"), (F.col("own") + F.col("base") - 1).cast("bigint").alias("pos"), "hash"
    )


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    id_col: str = "doc_id",
    group_col: str = "lang",
    seen: dict[str, Column] | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """Per row ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``leaf`` is the hash of the row's ``fields``. Per value of ``group_col`` the leaves, by
    id, are reduced in pairs, a last one alone, to ``subroot``; the subroots, by group, null
    first, to ``root``. ``seen`` gives fields as they are found later: ``folded_root`` is
    what the row so found and the siblings of the manifest lead to, ``verified`` whether that
    is the root. ``proof_sha256`` is the hash of the siblings from the leaf to the root.

    Null fields count as ``-``. Rows without an id come before all others; rows that share
    an id come by their hashes; copies of a row get a place each. Empty texts are values of
    no bytes. An empty table gives no rows. Columns not named are not looked at.
    """
    names = {c: F.col(f"`{c}`") for c in fields}
    now = {**names, **(seen or {})}
    number = F.col(f"`{id_col}`").cast("bigint")
    group = F.col(f"`{group_col}`").cast("string")
    leaves = docs.select(
        # Null comes first in the order of groups.
        F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group)).alias("group"),
        number.alias("id"),
        leaf(list(names.values())).alias("leaf"),
        leaf([now[c] for c in fields]).alias("seen"),
    )
    leaves = leaves.select(
        "group", "id", "leaf", F.nullif("seen", "leaf").alias("seen"),
        F.coalesce(F.expr("shiftright(id, 12)"), F.lit(_NO_ID)).alias("chunk"),
        F.coalesce((F.col("id").bitwiseAND(4095)), F.lit(0)).cast("int").alias("low"),
    )
    leaves = stored(leaves, "leaves")
    nodes = places(leaves).withColumnRenamed("leaf", "hash")
    sizes = leaves.groupBy("group").agg(F.count("*").alias("n"))
    trees = _Tree(nodes, sizes, levels, ("id", "seen"))
    named = stored(_ordered(trees.top.select("group", "hash")), "subroots")
    whole = F.lit("").alias("group")
    forest = _Tree(
        named.select(whole, "pos", "hash", "name"), named.groupBy(whole).agg(F.count("*").alias("n")),
        levels, ("name",),
    )
    tops = forest.paths(forest.top.select("group", F.lit("").alias("path"), F.col("hash").alias("root")))
    by_group = _leaf_rows(
        tops, levels, "name string, subroot string, path string, root string",
        lambda slot, path, root, subroot: (slot["name"], slot["hash"], ",".join(path), root),
    )
    by_group = stored(by_group.withColumnRenamed("name", "group"), "group_paths")
    found = trees.paths(by_group.select("group", "path", "root"))
    found = found.join(by_group.select("group", "subroot"), "group")

    def row(slot: dict, path: list[str], root: str, subroot: str) -> tuple:
        own = slot["hash"]
        end = folded(slot["seen"] or own, path)
        return slot["id"], own, subroot, root, proof(path), end, end == root

    return _leaf_rows(
        found, levels, "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string,"
        " folded_root string, verified boolean", row,
    )


def _leaf_rows(blocks: DataFrame, levels: int, schema: str, row) -> DataFrame:
    """``row(slot, path, root, subroot)`` for each slot of the arrays."""
    kinds = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    names, types = zip(*(x.split() for x in schema.split(",")))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = [batch.column(i).to_pylist() for i in range(len(batch.schema))]
            out: list[tuple] = []
            for slots, n, path, root, subroot in zip(*columns):
                tree, rest = reduced([x["hash"] for x in slots], levels_of(n, levels)), _steps(path)
                for i, slot in enumerate(slots):
                    out.append(row(slot, siblings(tree, i) + rest, root, subroot))
            columns = zip(*out) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kinds[t]) for x, t in zip(columns, types)], list(names)
            )

    subroot = F.col("subroot") if "subroot" in blocks.columns else F.lit(None).cast("string")
    return blocks.select("slots", "n", "path", "root", subroot.alias("subroot")).mapInArrow(rows, schema)
