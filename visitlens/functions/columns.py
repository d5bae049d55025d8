"""Scalar column helpers: parsing, formatting, CSV <-> array, exact rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
ACTION_TIME = r"^(\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2})(?:\.\d+)?$"



def parse_action_time(col: Column) -> Column:
    """Wall-clock parse of ``yyyy-MM-dd H:mm:ss`` (fields padded or not); NULL on any other text.

    A fraction of the second is not read, so differences of parsed times are whole seconds. The cast to
    timestamp_ntz is zone-free. Text in the padded form without a fraction is cast as it is; the pattern, three times
    as dear, is only matched on the rest. That the seconds are two digits is checked there because a cast would read
    a letter or sign at their place as a time zone.
    """
    digit = lambda k: F.substring(col, k, 1).between("0", "9")
    padded = col.like("____-__-__ __:__:__") & digit(1) & digit(18) & digit(19)
    return F.when(padded, col).otherwise(F.regexp_extract(col, ACTION_TIME, 1)).try_cast("timestamp_ntz")


def format_time(col: Column) -> Column:
    return F.date_format(col, TIME_FORMAT)


def day_of(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def hour_of(col: Column) -> Column:
    return F.date_format(col, "HH")





def ids_to_csv(col: Column) -> Column:
    """array<bigint> (already sorted) -> '1,2,3'; empty array -> ''."""
    return F.array_join(col.cast("array<string>"), ",")


def strings_to_csv(col: Column) -> Column:
    return F.array_join(col, ",")


def int_div(num: Column, den: Column) -> Column:
    """Integer division (Spark's ``div``), exact over the whole bigint range."""
    return F.call_function("div", num, den)


def ratio_half_up(count: Column, total: Column, decimals: int = 2) -> Column:
    """count/total rounded half-up to ``decimals`` places, computed exactly in integers.

    floor(count/total * 10^d + 1/2) / 10^d = ((2 * 10^d * count + total) div (2 * total)) / 10^d.
    NULL when total is 0.
    """
    scale = 10**decimals
    total = F.nullif(total, F.lit(0))
    scaled = int_div(F.lit(2 * scale) * count + total, F.lit(2) * total)
    return scaled.cast("double") / F.lit(float(scale))
