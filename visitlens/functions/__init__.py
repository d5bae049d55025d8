"""Column expressions shared by the operators (all built-in, JVM-side)."""

from visitlens.functions.buckets import STEP_BUCKETS, VISIT_BUCKETS, bucket_label
from visitlens.functions.columns import (
    day_of,
    format_time,
    hour_of,
    ids_to_csv,
    int_div,
    parse_action_time,
    ratio_half_up,
    strings_to_csv,
)

__all__ = [
    "STEP_BUCKETS",
    "VISIT_BUCKETS",
    "bucket_label",
    "day_of",
    "format_time",
    "hour_of",
    "ids_to_csv",
    "int_div",
    "parse_action_time",
    "ratio_half_up",
    "strings_to_csv",
]
