"""Duration and step-length buckets of the session statistics.

One table drives the counts, the ratios, the long-form label counts and the tests.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket names and inclusive bounds that results must match.
# (name, low, high); high None means no upper bound. Visit length is in whole seconds.
# Documented contract: 61-180 s is "1m_3m" and 181-600 s is "3m_10m"; 0 s falls in no bucket.
VISIT_BUCKETS: list[tuple[str, int, int | None]] = [
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
]
STEP_BUCKETS: list[tuple[str, int, int | None]] = [
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
]


def in_bucket(col: Column, low: int, high: int | None) -> Column:
    return col >= low if high is None else col.between(low, high)


def bucket_label(col: Column, buckets: list[tuple[str, int, int | None]], prefix: str) -> Column:
    """Name of the bucket ``col`` falls in, or NULL (one CASE expression, codegen-friendly)."""
    cases = [(in_bucket(col, lo, hi), f"{prefix}{name}") for name, lo, hi in buckets]
    first_cond, first_label = cases[0]
    return reduce(
        lambda acc, case: acc.when(case[0], F.lit(case[1])),
        cases[1:],
        F.when(first_cond, F.lit(first_label)),
    )
