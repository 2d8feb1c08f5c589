"""Registered queries: one callable (spark, sf_dir) -> DataFrame per job.

Every query reads the driver's ``events`` table for the given scale factor,
derives the clinical tables from it (``sources.proxy``) and runs one job over
all of it.  Double outputs are rounded to 6 decimals here (and in the oracle)
so sums/averages compare exactly across engines; the library functions
themselves return full precision.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import concepts as C
from .operators import features as FE
from .operators import stays as ST
from .operators.cohort import hourly_cohort
from .operators.vent import vent_flag
from .plans import summary as SU
from .plans import variants as VA
from .plans.refresh import refresh_features, summary_from_features
from .sources.proxy import load_proxy
from .sources.shared import shared_dir, side_by_side
from .sources.tables import SCHEMAS, read_table, write_feature

DIGITS = 6


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def q_vitals_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_proxy(spark, sf_dir)
    return round_doubles(FE.vitals_hourly(t.icustays, t.chartevents))


def q_labs_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_proxy(spark, sf_dir)
    return round_doubles(FE.labs_hourly(t.icustays, t.labevents))


def q_labs_hourly_uncapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_proxy(spark, sf_dir)
    return round_doubles(FE.labs_hourly(t.icustays, t.labevents, min_hr=None, max_hr=None))


def q_admission_labs(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_proxy(spark, sf_dir)
    return round_doubles(FE.admission_labs(t.icustays, t.labevents))


def q_inputs_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_proxy(spark, sf_dir)
    return round_doubles(FE.inputs_hourly(t.icustays, t.inputevents_cv))


def q_inputs_hourly_uncapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_proxy(spark, sf_dir)
    return round_doubles(FE.inputs_hourly(t.icustays, t.inputevents_cv, min_hr=None, max_hr=None, totals=False))


def q_outputs_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_proxy(spark, sf_dir)
    return round_doubles(FE.outputs_hourly(t.icustays, t.outputevents))


def q_outputs_hourly_uncapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_proxy(spark, sf_dir)
    return round_doubles(FE.outputs_hourly(t.icustays, t.outputevents, urine_items=C.URINE_11, unit=None,
                                           min_hr=None, max_hr=None))


def q_hourly_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_cohort(load_proxy(spark, sf_dir).icustays)


def q_stay_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_proxy(spark, sf_dir)
    return round_doubles(ST.stay_demographics(t.icustays, t.admissions, t.patients))


def q_stay_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_proxy(spark, sf_dir)
    return SU.stay_ranks(t.icustays, t.admissions, t.patients)


def q_hourly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_proxy(spark, sf_dir)
    return round_doubles(SU.hourly_summary(
        t.icustays, t.admissions, t.patients,
        FE.vitals_hourly(t.icustays, t.chartevents),
        FE.labs_hourly(t.icustays, t.labevents),
        FE.inputs_hourly(t.icustays, t.inputevents_cv),
        FE.outputs_hourly(t.icustays, t.outputevents)))


def q_summary_from_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two-step workflow: the feature tables are refreshed as bucketed tables,
    and the summary reads them."""
    t = load_proxy(spark, sf_dir)
    run = uuid.uuid4().hex
    names = refresh_features(t.icustays, t.chartevents, t.labevents, t.inputevents_cv, t.outputevents,
                             f"{shared_dir(spark)}/hourgrid-features-{run}", prefix=f"hourgrid_{run}_")
    return round_doubles(summary_from_features(spark, t.icustays, t.admissions, t.patients, names))


def _stored_base(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Base tables as a site keeps them: stored Parquet folders, read with their schemas."""
    t, folder = load_proxy(spark, sf_dir), f"{shared_dir(spark)}/hourgrid-base-{uuid.uuid4().hex}"
    side_by_side(spark, *[partial(write_feature, getattr(t, n).select(*SCHEMAS[n].names), f"{folder}/{n}") for n in names])
    return {n: read_table(spark, folder, n) for n in names}


def q_summary_from_base_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary from stored base tables to the last column."""
    t = _stored_base(spark, sf_dir, "icustays", "admissions", "patients", "chartevents", "labevents", "inputevents_cv", "outputevents")
    return round_doubles(SU.hourly_summary(
        t["icustays"], t["admissions"], t["patients"],
        FE.vitals_hourly(t["icustays"], t["chartevents"]), FE.labs_hourly(t["icustays"], t["labevents"]),
        FE.inputs_hourly(t["icustays"], t["inputevents_cv"]), FE.outputs_hourly(t["icustays"], t["outputevents"])))


def q_vent_from_base_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _stored_base(spark, sf_dir, "icustays", "ventdurations")
    return vent_flag(t["ventdurations"], t["icustays"])


def q_one_pass_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_proxy(spark, sf_dir)
    return round_doubles(SU.one_pass_summary(
        t.icustays, t.admissions, t.patients,
        FE.vitals_hourly(t.icustays, t.chartevents, min_hr=None, max_hr=None),
        FE.labs_hourly(t.icustays, t.labevents, min_hr=None, max_hr=None)))


def q_vent_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_proxy(spark, sf_dir)
    return vent_flag(t.ventdurations, t.icustays)


def q_vitals_with_stay(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_proxy(spark, sf_dir)
    return round_doubles(VA.vitals_with_stay(t.icustays, t.chartevents, t.admissions, t.patients, limit=None))


def q_vitals_with_stay_top100(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_proxy(spark, sf_dir)
    return round_doubles(VA.vitals_with_stay(t.icustays, t.chartevents, t.admissions, t.patients, limit=100))


def q_vitals_with_inout(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_proxy(spark, sf_dir)
    return round_doubles(VA.vitals_with_inout(
        t.icustays, t.chartevents, t.admissions, t.patients, t.inputevents_cv, t.outputevents,
        FE.inputs_hourly(t.icustays, t.inputevents_cv, min_hr=None, max_hr=None, totals=False),
        FE.outputs_hourly(t.icustays, t.outputevents, urine_items=C.URINE_11, unit=None,
                          min_hr=None, max_hr=None)))


def q_vitals_with_admission_labs_top100(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_proxy(spark, sf_dir)
    return round_doubles(VA.vitals_with_admission_labs(
        t.icustays, t.chartevents, t.admissions, t.patients, t.labevents, limit=100))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "vitals_with_stay": q_vitals_with_stay,
        "vitals_with_stay_top100": q_vitals_with_stay_top100,
        "vitals_with_inout": q_vitals_with_inout,
        "vitals_with_admission_labs_top100": q_vitals_with_admission_labs_top100,
        "hourly_cohort": q_hourly_cohort,
        "stay_demographics": q_stay_demographics,
        "stay_ranks": q_stay_ranks,
        "hourly_summary": q_hourly_summary,
        "summary_from_features": q_summary_from_features,
        "summary_from_base_tables": q_summary_from_base_tables,
        "one_pass_summary": q_one_pass_summary,
        "vent_flag": q_vent_flag,
        "vent_from_base_tables": q_vent_from_base_tables,
        "vitals_hourly": q_vitals_hourly,
        "labs_hourly": q_labs_hourly,
        "labs_hourly_uncapped": q_labs_hourly_uncapped,
        "admission_labs": q_admission_labs,
        "inputs_hourly": q_inputs_hourly,
        "inputs_hourly_uncapped": q_inputs_hourly_uncapped,
        "outputs_hourly": q_outputs_hourly,
        "outputs_hourly_uncapped": q_outputs_hourly_uncapped,
    }
