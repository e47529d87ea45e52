import random
from itertools import product as every

import pytest

from clientele.llm.role_repair import ASSISTANT, SYSTEM, USER, Costs, role_index, repair
from tests.helpers import settings
from tests.llm.data import CLASHES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, " + ", ".join(f"{c} string" for c in CLASHES)
NAMES = {"s": "system", "u": "user", "a": "assistant", "?": "tool"}


def turns(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * len(CLASHES)) for r in rows], SCHEMA)


def cheapest(roles, costs):
    """The least cost by trying all roles and all ways to fill up or merge."""
    best = None
    for new in every((SYSTEM, USER, ASSISTANT), repeat=len(roles)):
        cost, before = 0, 0
        for old, role in zip(roles, new):
            if old != role:
                cost += costs.relabel if old else costs.relabel_unknown
            if before == role:
                cost += costs.merge if role == SYSTEM else min(costs.merge, costs.insert)
            elif role == SYSTEM and before:
                cost += 10**9
            elif role == ASSISTANT and before in (0, SYSTEM):
                cost += costs.insert
            before = role
        cost += {0: 0, SYSTEM: 2 * costs.insert, USER: costs.insert, ASSISTANT: 0}[before]
        best = cost if best is None else min(best, cost)
    return best


def rendered(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["part"], r["pos"])):
        out[r["conv_id"]] = out.get(r["conv_id"], "") + r["piece"]
    return out


def roles_of(text):
    return [b.split("\n")[0] for b in text.split("<|im_start|>")[1:]]


@pytest.mark.parametrize("costs", [Costs(), Costs(merge=5, relabel=3, insert=1), Costs(merge=9, relabel=1, relabel_unknown=1, insert=20)])
def test_every_short_conversation_is_legal_at_least_cost(spark, costs):
    patterns = ["".join(p) for n in range(1, 5) for p in every("sua?", repeat=n)]
    rows = [(k, i, NAMES[c], f"{c}{i}") for k, p in enumerate(patterns) for i, c in enumerate(p)]
    found = repair(turns(spark, rows), costs=costs).collect()
    spent = {}
    for r in found:
        spent[r["conv_id"]] = spent.get(r["conv_id"], 0) + r["cost"]
    for k, text in rendered(found).items():
        roles = roles_of(text)
        body = roles[1:] if roles[0] == "system" else roles
        assert body == ["user", "assistant"] * (len(body) // 2) and body
        assert text.count("<|im_end|>\n") == len(roles) and text.endswith("<|im_end|>\n")
        assert spent[k] == cheapest([role_index(NAMES[c]) for c in patterns[k]], costs)


def test_rendered_text(spark):
    rows = [(1, 0, "System ", "S"), (1, 1, "human", "q1"), (1, 2, "user", "q2"), (1, 3, "gpt", "a"), (1, 4, "user", "q3")]
    found = repair(turns(spark, rows)).collect()
    assert rendered(found) == {
        1: "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nq1\n\nq2<|im_end|>\n"
        "<|im_start|>assistant\na<|im_end|>\n<|im_start|>user\nq3<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    }
    by_turn = {r["turn"]: (r["action"], r["inserted"], r["cost"]) for r in found}
    assert by_turn == {0: ("keep", "", 0), 1: ("keep", "", 0), 2: ("merge", "", 2), 3: ("keep", "", 0), 4: ("keep", ";assistant", 4)}


def test_a_long_conversation_over_many_parts_is_repaired_as_in_one(spark):
    rng = random.Random(5)
    rows = [(1, i, NAMES[rng.choice("suuuaaa?")], f"t{i}") for i in range(900)]
    rows += [(2 + i // 3, i, NAMES[rng.choice("sua?")], f"o{i}") for i in range(300)]
    def run(parts):
        with settings(spark, spark_sql_shuffle_partitions=str(parts), spark_sql_adaptive_enabled="false"):
            return repair(turns(spark, rows).repartition(8)).collect()

    whole, cut = run(1), run(23)
    assert len({r["part"] for r in cut if r["conv_id"] == 1}) > 10
    assert rendered(whole) == rendered(cut) and len(cut) == len(rows)
    key = lambda r: (r["conv_id"], r["turn"])
    drop = lambda r: [v for k, v in r.asDict().items() if k not in ("part", "pos")]
    assert [drop(r) for r in sorted(whole, key=key)] == [drop(r) for r in sorted(cut, key=key)]


def test_awkward_turns(spark):
    rows = [
        (None, 1, "user", "q"), (None, None, None, None), (3, 1, None, "x"), (3, 1, None, "x"), (4, None, "", ""),
        (5, 2, "assistant", "late"), (5, 1, "user", "early"), (6, 0, "user", "long " * 200_000),
    ]
    found = repair(turns(spark, rows)).collect()
    assert len(found) == len(rows)
    texts = rendered(found)
    assert roles_of(texts[None]) == ["user", "assistant"]
    assert texts[5] == "<|im_start|>user\nearly<|im_end|>\n<|im_start|>assistant\nlate<|im_end|>\n"
    assert roles_of(texts[3]) == ["user", "assistant"]
    assert len(texts[6]) > 1_000_000
    assert repair(turns(spark, [])).collect() == []
