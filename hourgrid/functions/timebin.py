"""Time arithmetic on TIMESTAMP_NTZ columns.

All differences are taken in whole microseconds with ``timestamp_diff`` (it
accepts NTZ values, unlike ``unix_micros``) and then scaled with one double
division, so the same numbers come out of any engine that divides the same
integers by the same constants.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

US_PER_HOUR = 3_600_000_000.0
US_PER_DAY = 86_400_000_000.0
# Fixed value: the reference's year length is 365.242 days.
US_PER_YEAR = 86_400.0 * 365.242 * 1_000_000.0


def elapsed_us(start: Column, end: Column) -> Column:
    """end - start in microseconds (bigint)."""
    return F.timestamp_diff("MICROSECOND", start, end)


def hour_bin(start: Column, t: Column) -> Column:
    """Hours since ``start`` rounded up: t == start -> 0, (0 h, 1 h] -> 1,
    (-1 h, 0) -> 0.  Returned as int."""
    return F.ceil(elapsed_us(start, t) / F.lit(US_PER_HOUR)).cast("int")


def los_days(start: Column, end: Column, digits: int = 4) -> Column:
    """Length of stay in days, rounded half away from zero."""
    return F.round(elapsed_us(start, end) / F.lit(US_PER_DAY), digits)


def age_years(dob: Column, at: Column, digits: int = 4) -> Column:
    """Age in years of 365.242 days, rounded half away from zero."""
    return F.round(elapsed_us(dob, at) / F.lit(US_PER_YEAR), digits)


def window_end(start: Column, hours: int) -> Column:
    """start + N hours."""
    return start + F.make_dt_interval(hours=F.lit(hours))
