"""Feature-table refresh and the summary read back from the stored tables.

This is the reference's own two-step workflow: the four hourly feature tables
are rebuilt in full (materialized-view refresh), and the summary joins the
stored tables onto the hourly cohort.  The tables are written bucketed and
sorted by (icustay_id, hr) with one bucket count, so the summary's four left
joins read them co-partitioned; only the cohort is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..operators import features as FE
from ..sources.shared import side_by_side
from ..sources.tables import publish_bucketed, publish_feature, read_feature
from .summary import stored_summary

FEATURES = ("vitals", "labs", "inputs", "outputs")
KEY = ("icustay_id", "hr")


def features(icustays: DataFrame, chartevents: DataFrame, labevents: DataFrame,
             inputevents_cv: DataFrame, outputevents: DataFrame) -> dict[str, DataFrame]:
    """The four hourly feature tables."""
    return {
        "vitals": FE.vitals_hourly(icustays, chartevents),
        "labs": FE.labs_hourly(icustays, labevents),
        "inputs": FE.inputs_hourly(icustays, inputevents_cv),
        "outputs": FE.outputs_hourly(icustays, outputevents),
    }


def _each(tables: dict[str, DataFrame], refresh: Callable[[str, DataFrame], None]) -> None:
    """Refreshes the tables, which do not depend on one another, side by side."""
    spark = next(iter(tables.values())).sparkSession
    side_by_side(spark, *[partial(refresh, name, df) for name, df in tables.items()])


def store_features(icustays: DataFrame, chartevents: DataFrame, labevents: DataFrame,
                   inputevents_cv: DataFrame, outputevents: DataFrame, base_path: str) -> dict[str, str]:
    """Rebuild the four feature tables under ``base_path`` (``publish_feature``); returns their paths."""
    paths = {name: f"{base_path.rstrip('/')}/{name}" for name in FEATURES}
    _each(features(icustays, chartevents, labevents, inputevents_cv, outputevents), lambda name, df: publish_feature(df, paths[name]))
    return paths


def summary_from_paths(spark: SparkSession, icustays: DataFrame, admissions: DataFrame,
                       patients: DataFrame, paths: dict[str, str]) -> DataFrame:
    """JOB-6 over the current versions of stored feature tables."""
    return stored_summary(icustays, admissions, patients, *[read_feature(spark, paths[f]) for f in FEATURES])


def refresh_features(icustays: DataFrame, chartevents: DataFrame, labevents: DataFrame,
                     inputevents_cv: DataFrame, outputevents: DataFrame, base_path: str, *,
                     prefix: str = "hourgrid_", num_buckets: int | None = None) -> dict[str, str]:
    """Rebuild the four feature tables, bucketed, under ``base_path``
    (``publish_bucketed``); returns the names to read them by."""
    names = {name: prefix + name for name in FEATURES}
    _each(features(icustays, chartevents, labevents, inputevents_cv, outputevents),
          lambda name, df: publish_bucketed(df, f"{base_path.rstrip('/')}/{name}", names[name], KEY, num_buckets))
    return names


def summary_from_features(spark: SparkSession, icustays: DataFrame, admissions: DataFrame,
                          patients: DataFrame, names: dict[str, str]) -> DataFrame:
    """JOB-6 over the stored, bucketed feature tables: the cohort is shuffled once,
    to their buckets, and no feature table is."""
    return stored_summary(icustays, admissions, patients, *[spark.table(names[f]) for f in FEATURES])
