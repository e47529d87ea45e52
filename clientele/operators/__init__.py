"""DataFrame operators: each takes and returns DataFrames and stays lazy,
except that ``frames_equal``, ``heavy_keys``, ``filter_eligible``, ``join_on`` with hot keys
and ``sort_rows`` without ``cut_ties`` run small jobs of their own."""

from clientele.operators.compare import bucket_digests, frame_diff, frames_equal
from clientele.operators.counts import count_rows, count_where
from clientele.operators.derive import (
    EligibilityRule,
    add_age,
    add_eligibility,
    add_full_name,
    require_columns,
    select_columns,
)
from clientele.operators.eligible import filter_eligible
from clientele.operators.joins import heavy_keys, join_on
from clientele.operators.layout import arrange
from clientele.operators.ordering import first_row, sort_rows

__all__ = [
    "EligibilityRule",
    "add_age",
    "add_eligibility",
    "add_full_name",
    "arrange",
    "bucket_digests",
    "count_rows",
    "count_where",
    "filter_eligible",
    "first_row",
    "frame_diff",
    "frames_equal",
    "heavy_keys",
    "join_on",
    "require_columns",
    "select_columns",
    "sort_rows",
]
