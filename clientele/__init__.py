"""Customer-table analytics for Spark: ages, eligibility flags, full names,
customer-order joins and safe table overwrites, as composable DataFrame operators."""

from clientele.functions import (
    age_between,
    age_years,
    birth_cutoff,
    flag,
    full_name,
    has_reached,
)
from clientele.operators import (
    EligibilityRule,
    add_age,
    add_eligibility,
    add_full_name,
    arrange,
    bucket_digests,
    count_rows,
    count_where,
    filter_eligible,
    first_row,
    frame_diff,
    frames_equal,
    heavy_keys,
    join_on,
    require_columns,
    select_columns,
    sort_rows,
)
from clientele.plans import PRESETS, Outcome, Pipeline, preset
from clientele.sinks import drop_table, overwrite_table, restore_table
from clientele.sources import get_session, read_table

__all__ = [
    "EligibilityRule",
    "Outcome",
    "PRESETS",
    "Pipeline",
    "add_age",
    "add_eligibility",
    "add_full_name",
    "age_between",
    "age_years",
    "arrange",
    "birth_cutoff",
    "bucket_digests",
    "count_rows",
    "count_where",
    "drop_table",
    "filter_eligible",
    "first_row",
    "flag",
    "frame_diff",
    "frames_equal",
    "full_name",
    "get_session",
    "has_reached",
    "heavy_keys",
    "join_on",
    "overwrite_table",
    "preset",
    "read_table",
    "require_columns",
    "restore_table",
    "select_columns",
    "sort_rows",
]
