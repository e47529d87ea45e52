"""Chat formatting with a repair of roles that costs least.

A legal conversation is an optional system turn, then user and assistant turns in
alternation, from a user's to an assistant's. Dynamic programming over this automaton
chooses for each turn whether it keeps its role, is relabelled, or is merged with the turn
before, and where empty turns are put in, so that the sum of the costs is smallest.

A turn is a 4 x 4 matrix of costs from state to state, and a run of turns the min-plus
product of its turns' matrices. So conversations of any length are spread over tasks: the
sort cuts the turns anywhere, each part of a conversation is summed up by its product, the
products of a conversation give the states at the cuts, and with those each part is
decoded by itself, to just what one pass over the whole would choose.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.arrow import slices
from clientele.llm.scratch import stored

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
#: Other names of roles. A name in neither list is unknown.
ALIASES = {"human": USER, "prompter": USER, "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT, "ai": ASSISTANT, "developer": SYSTEM}


@dataclass(frozen=True)
class Costs:
    merge: int = 2
    relabel: int = 3
    relabel_unknown: int = 1
    insert: int = 4


#: Never chosen, as what it stands for can always be relabelled.
_NEVER = 1 << 40


def role_index(role: str | None) -> int:
    """The state of a role's name, 0 if unknown; case and outer white space do not count."""
    name = (role or "").strip().lower()
    return ROLES.index(name) if name in ROLES[1:] else ALIASES.get(name, 0)


def steps(costs: Costs) -> tuple[np.ndarray, np.ndarray]:
    """Costs from the state before a turn to its role, without relabelling; and from the last
    state to the end."""
    step = np.full((4, 4), _NEVER, dtype=np.int64)
    step[START, SYSTEM] = step[START, USER] = step[SYSTEM, USER] = step[USER, ASSISTANT] = step[ASSISTANT, USER] = 0
    for same in (SYSTEM, USER, ASSISTANT):
        step[same, same] = costs.merge
    step[START, ASSISTANT] = step[SYSTEM, ASSISTANT] = costs.insert
    # Between equal roles an empty turn of the other one may be cheaper than to merge.
    step[USER, USER] = min(costs.merge, costs.insert)
    step[ASSISTANT, ASSISTANT] = min(costs.merge, costs.insert)
    end = np.array([0, 2 * costs.insert, costs.insert, 0], dtype=np.int64)
    return step, end


def turn_costs(roles: np.ndarray, costs: Costs) -> np.ndarray:
    """For each turn, by role index, what it costs to become each role."""
    out = np.full((len(roles), 4), costs.relabel, dtype=np.int64)
    out[roles == 0] = costs.relabel_unknown
    out[np.arange(len(roles)), roles] = 0
    out[:, START] = _NEVER
    return out


def product(roles: np.ndarray, costs: Costs) -> np.ndarray:
    """The min-plus product of the turns' matrices."""
    step, _ = steps(costs)
    total = np.full((4, 4), _NEVER, dtype=np.int64)
    np.fill_diagonal(total, 0)
    for relabel in turn_costs(roles, costs):
        total = np.minimum((total[:, :, None] + step[None]).min(axis=1) + relabel, _NEVER)
    return total


def decode(roles: np.ndarray, before: np.ndarray, last: int, costs: Costs) -> tuple[int, np.ndarray]:
    """The state before the first turn and each turn's role, on the cheapest way from the
    costs ``before`` to the state ``last``. Of equally cheap ways, the one whose states are
    the first in the list, from the end backwards."""
    step, _ = steps(costs)
    relabel = turn_costs(roles, costs)
    reached = [before]
    for now in relabel:
        reached.append(np.minimum((reached[-1][:, None] + step).min(axis=0) + now, _NEVER))
    out, state = np.empty(len(roles), np.int64), last
    for t in range(len(roles) - 1, -1, -1):
        out[t] = state
        state = int((reached[t] + step[:, state]).argmin())
    return state, out


def cuts(products: list[np.ndarray], costs: Costs) -> list[tuple[np.ndarray, int]]:
    """For each part of a conversation the costs of the states before it, and the state
    after it."""
    _, end = steps(costs)
    before = [np.array([0, _NEVER, _NEVER, _NEVER], dtype=np.int64)]
    for p in products:
        before.append(np.minimum((before[-1][:, None] + p).min(axis=0), _NEVER))
    state, out = int((before[-1] + end).argmin()), []
    for p, costs_in in zip(reversed(products), reversed(before[:-1])):
        out.append((costs_in, state))
        state = int((costs_in + p[:, state]).argmin())
    return out[::-1]


def _between(before: int, role: int, costs: Costs) -> tuple[bool, list[int]]:
    """Whether the turn is merged with the one before, and the empty turns put in between."""
    if before == role:
        if role == SYSTEM or costs.merge <= costs.insert:
            return True, []
        return False, [USER + ASSISTANT - role]
    return False, [USER] if role == ASSISTANT and before in (START, SYSTEM) else []


def _opened(role: int) -> str:
    return f"<|im_start|>{ROLES[role]}\n"


_CLOSED = "<|im_end|>\n"

_TURNS_SQL = "conv_id bigint, turn bigint, role string, text string, part int, pos bigint, product array<bigint>"
_TURNS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("turn", pa.int64()),
        ("role", pa.string()),
        ("text", pa.string()),
        ("part", pa.int32()),
        ("pos", pa.int64()),
        ("product", pa.list_(pa.int64())),
    ]
)
_OUT = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("turn", pa.int64()),
        *((name, pa.string()) for name in ("old_role", "role", "action", "inserted")),
        ("cost", pa.int64()),
        ("piece", pa.string()),
        ("part", pa.int32()),
        ("pos", pa.int64()),
    ]
)
_OUT_SQL = (
    "conv_id bigint, turn bigint, old_role string, role string, action string, inserted string,"
    " cost bigint, piece string"
)


def repair(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    costs: Costs = Costs(),
) -> DataFrame:
    """One row per turn: ``conv_id, turn, old_role, role, action, inserted, cost, piece, part, pos``.

    ``action`` is keep, relabel, merge or relabel+merge; ``inserted`` names the empty turns
    put in before the turn, and for the last turn, after a semicolon, those behind it.
    A conversation's pieces, joined in the order of ``part`` and ``pos``, are its rendered
    text; a long conversation is never gathered in one string. Turns go by number, those
    without one last, equal ones by role and text. Turns without a conversation id are one
    conversation. A null text is empty; a null role is unknown. Repeated rows are turns of
    their own. Other columns are not looked at; an empty table gives no rows.
    """
    chosen = turns.select(
        F.col(conv_col).cast("bigint").alias("conv_id"),
        F.col(turn_col).cast("bigint").alias("turn"),
        F.col(role_col).cast("string").alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_last(), F.col("role"), F.xxhash64("text")]

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, pos = TaskContext.get().partitionId(), 0
        now: tuple[int | None] | None = None
        total = np.empty(0)

        def summary() -> pa.RecordBatch:
            row = now[0], None, None, None, part, None, total.reshape(-1).tolist()
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _TURNS)], schema=_TURNS)

        for batch in batches:
            n = len(batch)
            ids = batch.column(0).to_pylist()
            roles = np.array([role_index(r) for r in batch.column(2).to_pylist()], dtype=np.int64)
            starts = [i for i in range(n) if i == 0 or ids[i] != ids[i - 1]]
            for begin, stop in zip(starts, [*starts[1:], n]):
                own = product(roles[begin:stop], costs)
                if now is not None and now[0] == ids[begin]:
                    total = np.minimum((total[:, :, None] + own[None]).min(axis=1), _NEVER)
                    continue
                if now is not None:
                    yield summary()
                now, total = (ids[begin],), own
            extra = [pa.array([part] * n, pa.int32()), pa.array(range(pos, pos + n), pa.int64()), pa.nulls(n, pa.list_(pa.int64()))]
            pos += n
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], schema=_TURNS)
        if now is not None:
            yield summary()

    ordered = chosen.repartitionByRange(*order).sortWithinPartitions(*order)
    table = stored(ordered.mapInArrow(sum_up, _TURNS_SQL), "turns")

    @F.pandas_udf("array<struct<part: int, before: array<bigint>, last: int, final: boolean>>")
    def at_cuts(parts: pd.Series) -> pd.Series:
        def one(rows: list) -> list[dict]:
            found = cuts([np.array(r["product"], dtype=np.int64).reshape(4, 4) for r in rows], costs)
            return [
                {"part": r["part"], "before": before.tolist(), "last": last, "final": i + 1 == len(rows)}
                for i, (r, (before, last)) in enumerate(zip(rows, found))
            ]

        return parts.map(one)

    # One product for each part that a conversation reaches into.
    by_conversation = (
        table.where("product IS NOT NULL")
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("part", "product"))).alias("parts"))
    )
    known = by_conversation.select("conv_id", F.inline(at_cuts("parts"))).select(
        F.col("conv_id").alias("of_conv"), F.col("part").alias("of_part"), "before", "last", "final"
    )

    def decode_run(rows: list[dict]) -> list[tuple]:
        """What one part of the sort holds of one conversation."""
        first = rows[0]
        old = np.array([role_index(r["role"]) for r in rows], dtype=np.int64)
        state, new = decode(old, np.array(first["before"], dtype=np.int64), first["last"], costs)
        step, end = steps(costs)
        relabel = turn_costs(old, costs)
        out = []
        for i, (row, role) in enumerate(zip(rows, new.tolist())):
            merged, inserted = _between(state, role, costs)
            cost = int(step[state, role] + relabel[i, role])
            names = ",".join(ROLES[r] for r in inserted)
            piece = "\n\n" if merged else _CLOSED if state != START else ""
            piece += "".join(_opened(r) + _CLOSED for r in inserted)
            piece += ("" if merged else _opened(role)) + row["text"]
            if first["final"] and i + 1 == len(rows):
                piece += _CLOSED
                behind = [[], [USER, ASSISTANT], [ASSISTANT], []][role]
                if behind:
                    names += ";" + ",".join(ROLES[r] for r in behind)
                    piece += "".join(_opened(r) + _CLOSED for r in behind)
                    cost += int(end[role])
            action = "+".join([*["relabel"] * bool(role != old[i]), *["merge"] * merged]) or "keep"
            place = row["part"], row["pos"]
            out.append((row["conv_id"], row["turn"], row["role"], ROLES[role], action, names, cost, piece, *place))
            state = role
        return out

    def decode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def done(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(_OUT)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _OUT)], schema=_OUT)

        for batch in slices(batches):
            out: list[tuple] = []
            for row in batch.to_pylist():
                if held and (held[0]["conv_id"], held[0]["part"]) != (row["conv_id"], row["part"]):
                    out += decode_run(held)
                    held = []
                held.append(row)
            yield done(out)
        if held:
            yield done(decode_run(held))

    same = F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("part") == F.col("of_part"))
    rows = table.where("product IS NULL").drop("product").join(known, same).drop("of_conv", "of_part")
    runs = rows.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "pos")
    return runs.mapInArrow(decode_rows, f"{_OUT_SQL}, part int, pos bigint")
