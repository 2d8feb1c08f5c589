"""Hourly cohort: one row per ICU stay per hour from admission to discharge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timebin import US_PER_HOUR, elapsed_us


def last_hour(intime: Column, outtime: Column) -> Column:
    """ceil(length of stay in hours) as int; NULL when either time is NULL."""
    return F.ceil(elapsed_us(intime, outtime) / F.lit(US_PER_HOUR)).cast("int")


def with_last_hour(stays: DataFrame, name: str = "n_hours") -> DataFrame:
    """Stays that have at least one cohort hour, with the last hour number.

    A stay whose last hour is negative (discharge an hour or more before
    admission) or NULL has no cohort rows, as ``generate_series(0, n)`` yields
    nothing there; Spark's ``sequence(0, -1)`` would count down, so those
    stays are removed first.
    """
    return (stays.withColumn(name, last_hour(F.col("intime"), F.col("outtime")))
            .where(F.col(name) >= F.lit(0)))


def hourly_cohort(icustays: DataFrame) -> DataFrame:
    """JOB-5: subject_id, hadm_id, icustay_id, hr for hr in 0..ceil(LOS hours).

    A narrow generator (no shuffle): each stay row expands in place.
    """
    return (with_last_hour(icustays.select("subject_id", "hadm_id", "icustay_id", "intime", "outtime"))
            .select("subject_id", "hadm_id", "icustay_id",
                    F.explode(F.sequence(F.lit(0), F.col("n_hours"))).alias("hr")))
