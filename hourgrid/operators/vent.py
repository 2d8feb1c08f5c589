"""Ventilation flag per ventilation episode (the reference's unfinished query,
built as written: one row per episode, flag = start hour-of-day > 0)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.joins import join_dimension


def vent_flag(ventdurations: DataFrame, icustays: DataFrame) -> DataFrame:
    """icustay_id, isventilated (1 when the episode starts after 00:59 of its
    day, else 0; NULL start -> 0) for episodes of known stays.

    The join to the stay table only tests existence (stay ids are unique), so
    it is a left semi join: episode rows are neither duplicated nor widened.
    """
    episodes = join_dimension(ventdurations.select("icustay_id", "starttime"),
                              icustays.select("icustay_id"), "icustay_id", how="left_semi")
    return episodes.select(
        "icustay_id",
        F.when(F.hour("starttime") > F.lit(0), F.lit(1)).otherwise(F.lit(0)).alias("isventilated"))
