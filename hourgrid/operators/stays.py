"""Stay-grain attributes: demographics, lengths of stay, stay order.

Everything here works on one row per ICU stay, never on hourly rows.  The
ranks are dense ranks, which ignore duplicates, so ranking the distinct stays
that reach a result equals ranking that result's hourly rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timebin import age_years, los_days
from ..plans.joins import join_dimension
from ..plans.ranking import with_dense_ranks


def stay_frame(icustays: DataFrame, admissions: DataFrame, patients: DataFrame) -> DataFrame:
    """Stays joined to their admission and patient (inner joins, as every stay
    has both): subject_id, hadm_id, icustay_id, intime, outtime, admittime,
    dischtime, ethnicity, admission_type, hospital_expire_flag, gender, dob."""
    adm = admissions.select("hadm_id", "admittime", "dischtime", "ethnicity", "admission_type",
                            "hospital_expire_flag")
    pat = patients.select("subject_id", "gender", "dob")
    st = icustays.select("subject_id", "hadm_id", "icustay_id", "intime", "outtime")
    return join_dimension(join_dimension(st, adm, "hadm_id"), pat, "subject_id")


def first_flag(rank: Column) -> Column:
    """'Y' for the first in order, else 'N'."""
    return F.when(rank == F.lit(1), F.lit("Y")).otherwise(F.lit("N"))


def with_stay_ranks(stays: DataFrame, subject_col: str = "subject_id", hadm_col: str = "hadm_id") -> DataFrame:
    """hospstay_seq / first_hosp_stay (dense rank of admittime per subject) and
    icustay_seq / first_icu_stay (dense rank of intime per admission); NULL
    times sort last.  The stays are stored once, and numbered by sorted blocks
    (``plans.ranking``)."""
    ranked = with_dense_ranks(stays, [(subject_col, "admittime", "hospstay_seq"),
                                      (hadm_col, "intime", "icustay_seq")])
    return ranked.withColumns({"first_hosp_stay": first_flag(F.col("hospstay_seq")),
                               "first_icu_stay": first_flag(F.col("icustay_seq"))})


def demographics(stays: DataFrame, *, age_at: str = "intime", age_digits: int = 4) -> DataFrame:
    """Adds age (years at ``age_at``), hospital_los, icu_los (days, 4 decimals)."""
    return stays.withColumns({
        "age": age_years(F.col("dob"), F.col(age_at), age_digits),
        "hospital_los": los_days(F.col("admittime"), F.col("dischtime")),
        "icu_los": los_days(F.col("intime"), F.col("outtime"))})


DEMOGRAPHIC_COLUMNS = (
    "subject_id", "hadm_id", "icustay_id", "age", "gender", "hospital_admission",
    "hospital_discharge", "hospital_los", "ethnicity", "icu_admission", "icu_discharge",
    "icu_los", "admission_type",
)


def stay_demographics(icustays: DataFrame, admissions: DataFrame, patients: DataFrame) -> DataFrame:
    """One row per stay with the summary's demographic block."""
    d = demographics(stay_frame(icustays, admissions, patients))
    return d.select("subject_id", "hadm_id", "icustay_id", "age", "gender",
                    F.col("admittime").alias("hospital_admission"),
                    F.col("dischtime").alias("hospital_discharge"), "hospital_los", "ethnicity",
                    F.col("intime").alias("icu_admission"), F.col("outtime").alias("icu_discharge"),
                    "icu_los", "admission_type")
