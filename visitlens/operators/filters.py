"""Session predicates (F1-F6) and their conjunction.

Each predicate is a Column over the enriched session row; a parameter that is absent adds no
predicate. A missing data value never matches (NULL in a WHERE is false). Because every
predicate is a plain column expression, Catalyst pushes the user-attribute ones (age,
profession, city, sex) below the session-user join into the user scan.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.params import TaskParams


def age_between(params: TaskParams) -> Column | None:
    """inclusive age range, applied only when both bounds are given."""
    if not params.has_age_range:
        return None
    return F.col("age").between(F.lit(params.start_age), F.lit(params.end_age))


def professional_in(params: TaskParams) -> Column | None:
    """F2 on a scalar field: profession equals any listed value."""
    if params.professionals is None:
        return None
    return F.col("professional").isin(list(params.professionals))


def city_in(params: TaskParams) -> Column | None:
    """city equals any listed value."""
    if params.cities is None:
        return None
    return F.col("city").isin(list(params.cities))


def sex_equals(params: TaskParams) -> Column | None:
    """whole-string equality."""
    if params.sex is None:
        return None
    return F.col("sex") == F.lit(params.sex)


def _any_listed(array_col: Column, values: tuple[str, ...]) -> Column:
    """True when any element of the session's list equals any listed value (text comparison)."""
    wanted = F.array(*[F.lit(v) for v in values])
    return F.arrays_overlap(array_col.cast("array<string>"), wanted)


def keywords_any(params: TaskParams) -> Column | None:
    """F2 on the keyword list: any searched keyword is listed."""
    if params.keywords is None:
        return None
    return _any_listed(F.col("search_keywords"), params.keywords)


def categories_any(params: TaskParams) -> Column | None:
    """F2 on the clicked-category list: any clicked category id is listed."""
    if params.category_ids is None:
        return None
    return _any_listed(F.col("click_category_ids"), params.category_ids)


def keywords_flag(params: TaskParams) -> Column | None:
    """F2 on session facts: the aggregate already flagged sessions that searched a listed keyword."""
    return None if params.keywords is None else F.col("keyword_match")


def categories_flag(params: TaskParams) -> Column | None:
    """F2 on session facts: the aggregate already flagged sessions that clicked a listed category."""
    return None if params.category_ids is None else F.col("category_match")


# Over enriched session rows that carry the keyword / category lists.
PREDICATES = (age_between, professional_in, city_in, sex_equals, keywords_any, categories_any)
# Over enriched session facts (``aggregate_session_facts``), the job's path.
FACT_PREDICATES = (age_between, professional_in, city_in, sex_equals, keywords_flag, categories_flag)


def session_predicate(params: TaskParams, predicates=PREDICATES) -> Column | None:
    """Conjunction of the predicates whose parameters are present (None when none are)."""
    parts = [p for p in (make(params) for make in predicates) if p is not None]
    return reduce(and_, parts) if parts else None


def filter_sessions(enriched: DataFrame, params: TaskParams, predicates=PREDICATES) -> DataFrame:
    """keep the sessions that satisfy every given parameter."""
    cond = session_predicate(params, predicates)
    return enriched if cond is None else enriched.where(cond)
