"""The same results in plain SQL for DuckDB, written independently of the
operators: ages come from calendar arithmetic with an explicit leap-day rule,
flags from the age, differences from EXCEPT ALL."""

from __future__ import annotations

from workload.views import CUSTOMER_COLUMNS, HOT_ORDERS, HOT_VISITS, ORDER_COLUMNS

AS_OF = "date '2026-02-28'"
LEAP_DAY = "date '2016-02-29'"

CUSTOMERS = f"(SELECT {CUSTOMER_COLUMNS} FROM customer)"
ORDERS = f"(SELECT {ORDER_COLUMNS} FROM orders)"
LINES = "(SELECT l_orderkey, l_linenumber, cast(l_shipdate AS date) AS dob FROM lineitem)"


def _age(as_of: str, dob: str = "dob") -> str:
    return f"""cast(year({as_of}) - year({dob})
        - CASE WHEN month({as_of}) * 100 + day({as_of}) < month({dob}) * 100 + day({dob})
                AND NOT (month({as_of}) = 2 AND month({dob}) = 2
                         AND {as_of} = last_day({as_of}) AND {dob} = last_day({dob}))
               THEN 1 ELSE 0 END AS integer)"""


def _flagged(source: str, as_of: str = AS_OF, dob: str = "dob", **flags: int) -> str:
    columns = "".join(f', coalesce(age >= {n}, false) AS "{c}"' for c, n in flags.items())
    return f"(SELECT *{columns} FROM (SELECT *, {_age(as_of, dob)} AS age FROM {source}))"


def _all(relation: str, where: str = "") -> str:
    return f"SELECT * FROM {relation}" + (f" WHERE {where}" if where else "")


AGED = _flagged(CUSTOMERS)
DRIVE_16 = _flagged(CUSTOMERS, canDrive=16)
DRIVE_18 = _flagged(CUSTOMERS, canDrive=18)
VOTE_18 = _flagged(CUSTOMERS, canVote=18)
DRIVE_18_DRINK_21 = _flagged(CUSTOMERS, canDrive=18, canDrink=21)
DRIVE_16_VOTE_18 = _flagged(CUSTOMERS, canDrive=16, canVote=18)
ALL_FLAGS = _flagged(CUSTOMERS, canDrive=16, canVote=18, canDrink=21)

STRICT = f"SELECT *, first_name || last_name AS full_name FROM {CUSTOMERS}"
NULL_SAFE = f"""SELECT *, coalesce(first_name, '') || ' ' || coalesce(last_name, '') AS full_name
    FROM {CUSTOMERS}"""

FLAGGED_LINES = _flagged(
    "(SELECT l_orderkey, l_linenumber, cast(l_shipdate AS date) AS dob, l_returnflag FROM lineitem)",
    LEAP_DAY, canDrive=16, canVote=18, canDrink=21,
)
OLD_LINES = f"SELECT * EXCLUDE (age) FROM {_flagged(LINES, LEAP_DAY)} WHERE age >= 18"

STATUS_TEXT = "CASE WHEN age >= 18 THEN 'Yes' ELSE 'No' END AS \"canDrive\""

JOINED = f"""SELECT c.*, o.id AS order_id, o.customer_id, o.status, o.total, o.ordered_at
    FROM {CUSTOMERS} c JOIN {ORDERS} o ON c.id = o.customer_id"""

DIFF = f"""
    WITH a AS (SELECT segment, "canDrive", first_name FROM {DRIVE_16}),
         b AS (SELECT segment, "canDrive", first_name FROM {DRIVE_18})
    SELECT *, 'left' AS side, count(*) AS copies
    FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) GROUP BY ALL
    UNION ALL
    SELECT *, 'right' AS side, count(*) AS copies
    FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) GROUP BY ALL"""

DIFF_ALL = f"""
    SELECT *, 'left' AS side, CAST(1 AS BIGINT) AS copies FROM (FROM {DRIVE_16} EXCEPT ALL FROM {DRIVE_18})
    UNION ALL
    SELECT *, 'right' AS side, CAST(1 AS BIGINT) AS copies FROM (FROM {DRIVE_18} EXCEPT ALL FROM {DRIVE_16})"""

CHANGED = f"""(SELECT * REPLACE (CASE WHEN id % 997 = 0 THEN NOT "canDrive" ELSE "canDrive" END AS "canDrive")
    FROM {DRIVE_16})"""
DIFF_FEW = f"""
    SELECT *, 'left' AS side, CAST(1 AS BIGINT) AS copies FROM (FROM {DRIVE_16} EXCEPT ALL FROM {CHANGED})
    UNION ALL
    SELECT *, 'right' AS side, CAST(1 AS BIGINT) AS copies FROM (FROM {CHANGED} EXCEPT ALL FROM {DRIVE_16})"""

COUNTS = f"""SELECT
        count(*) FILTER (WHERE "canDrive") AS n_drive,
        count(*) FILTER (WHERE "canVote") AS n_vote,
        count(*) FILTER (WHERE "canDrink") AS n_drink,
        count(*) FILTER (WHERE age BETWEEN 18 AND 20) AS n_young_voters,
        count(*) FILTER (WHERE age IN (16, 17)) AS n_minor_drivers,
        count(*) FILTER (WHERE dob IS NULL) AS n_unknown
    FROM {ALL_FLAGS}"""

ORACLES: dict[str, str] = {
    "scan_table": _all(CUSTOMERS),
    "scan_schema_table": _all(ORDERS),
    "scan_coalesced": _all(CUSTOMERS),
    "overwrite_roundtrip": _all(ALL_FLAGS),
    "overwrite_single_file": STRICT,
    "overwrite_in_place": _all(VOTE_18),
    "overwrite_in_place_bucketed": f"""SELECT c.*, o.id AS order_id, o.customer_id, o.status, o.total,
        o.ordered_at FROM {DRIVE_16} c JOIN {ORDERS} o ON c.id = o.customer_id""",
    "overwrite_one_step": _all(VOTE_18, "segment <> 'MACHINERY'"),
    "overwrite_schema_change": f"SELECT * EXCLUDE (dob) FROM ({STRICT})",
    "age_years": _all(AGED),
    "age_years_lineitem": _all(_flagged(LINES, LEAP_DAY, canDrive=16, canVote=18, canDrink=21)),
    "can_drive_16": _all(DRIVE_16),
    "can_vote_18": _all(VOTE_18),
    "drive18_drink21": _all(DRIVE_18_DRINK_21),
    "drive_vote_params": _all(_flagged(CUSTOMERS, canDrive=17, canVote=20)),
    "drive_status_text": f"SELECT * RENAME (dob AS birth_date), {STATUS_TEXT} FROM {AGED}",
    "full_name_strict": STRICT,
    "full_name_null_safe": NULL_SAFE,
    "full_name_repartitioned": STRICT,
    "select_columns": f"SELECT id, first_name, segment FROM {CUSTOMERS}",
    "filter_sql_text": _all(ALL_FLAGS, "age BETWEEN 18 AND 20"),
    "filter_string_eq": _all(ALL_FLAGS, "segment = 'BUILDING'"),
    "filter_column_eq": _all(ALL_FLAGS, "nation = 7"),
    "filter_reached_age": OLD_LINES,
    "filter_age_between": f"{OLD_LINES} AND age < 21",
    "filter_eligible": f"""SELECT l_orderkey, l_linenumber, dob, l_returnflag, age, "canDrive", "canVote", "canDrink"
        FROM {FLAGGED_LINES} WHERE age BETWEEN 18 AND 20 AND (l_returnflag <> 'N' OR age = 19)""",
    "customer_orders_inner": JOINED,
    "customer_orders_hot_keys": f"""SELECT c.*, o.id AS order_id, o.customer_id, o.status, o.total,
        o.ordered_at FROM (SELECT {HOT_VISITS} FROM customer) c
        JOIN (SELECT {HOT_ORDERS} FROM orders) o ON c.id = o.customer_id""",
    "count_rows": f"SELECT count(*) AS n_rows FROM {CUSTOMERS}",
    "count_by_flags": COUNTS,
    "first_row": f"SELECT * FROM {ALL_FLAGS} ORDER BY dob DESC NULLS LAST, id LIMIT 1",
    "sorted_rows": f"SELECT * FROM {ALL_FLAGS} ORDER BY age NULLS FIRST, id",
    "frame_diff": DIFF,
    "frame_diff_all_columns": DIFF_ALL,
    "frame_diff_digests": DIFF_FEW,
    "job_drive18_drink21": _all(DRIVE_18_DRINK_21),
    "job_drive16_tr": f"SELECT * RENAME (dob AS born) FROM {DRIVE_16}",
    "job_vote18_in_place": _all(VOTE_18),
    "job_drive16": _all(DRIVE_16),
    "job_drive16_vote18": _all(DRIVE_16_VOTE_18),
    "job_drive16_with_age": _all(DRIVE_16),
    "job_drive16_in_place": _all(DRIVE_16),
    "job_drive_status": f"SELECT *, {STATUS_TEXT} FROM {AGED}",
    "job_drive_status_again": f"SELECT *, {STATUS_TEXT} FROM {AGED}",
    "job_full_name_two_files": STRICT,
    "job_full_name": STRICT,
    "job_full_name_null_safe_in_place": NULL_SAFE,
    "job_gold_orders": JOINED,
    "job_full_name_again": STRICT,
}
