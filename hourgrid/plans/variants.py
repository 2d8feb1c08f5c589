"""Older one-statement variants: 24 h vitals with stay details (JOB-7), plus
fluid totals (JOB-8), plus admission-level labs (JOB-9).

All three group charted vitals by (stay, hour) and attach stay attributes.
The reference groups by the stay attributes too; they depend only on the
stay, so the grouping here is by (icustay_id, hr) alone and the attributes
are joined afterwards at stay grain.  Ranks are dense ranks over the stays
that reach the result (they count only rows that survive the filters).
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import concepts as C
from ..functions.timebin import age_years, los_days
from ..operators.features import admission_labs, charted_vitals, pivot_vitals
from ..operators.stays import stay_frame, with_stay_ranks
from ..sources.shared import materialise

ORDER = ["subject_id", "hadm_id", "icustay_id"]

# The 10-code concepts with SpO2 and glucose aggregated by MIN (JOB-9).
VITALS_10_MIN = tuple(replace(r, agg="min") if r.name in ("spo2", "glucose") else r for r in C.VITALS_10)


def _hours(icustays: DataFrame, chartevents: DataFrame, rules, max_icustay_id: int | None) -> DataFrame:
    """The (stay, hour) aggregate of the charted vitals, stored: the one scan of the
    events.  It also tells which stays reach the result."""
    coded = charted_vitals(icustays, chartevents, rules, max_icustay_id=max_icustay_id)
    return materialise(pivot_vitals(coded, rules, ["icustay_id", "hr"]), "stay-hours")


def _result_stays(hours: DataFrame, icustays: DataFrame, admissions: DataFrame, patients: DataFrame,
                  age_digits: int = 4) -> DataFrame:
    """Stay attributes of the stays that have an hour."""
    present = hours.select("icustay_id").distinct()
    st = stay_frame(icustays, admissions, patients).join(present, "icustay_id", "left_semi")
    return st.withColumns({
        "los_hospital": los_days(F.col("admittime"), F.col("dischtime")),
        "age": age_years(F.col("dob"), F.col("admittime"), age_digits),
        "los_icu": los_days(F.col("intime"), F.col("outtime"))})


def _with_rn(rows: DataFrame) -> DataFrame:
    """rn = position of the hour within its stay (at most 25 rows per stay)."""
    return rows.withColumn("rn", F.row_number().over(
        Window.partitionBy("icustay_id").orderBy("hr")).cast("bigint"))


STAY_TAIL = ["admittime", "dischtime", "los_hospital", "age", "ethnicity", "admission_type",
             "hospital_expire_flag", "hospstay_seq", "first_hosp_stay", "intime", "outtime",
             "los_icu", "icustay_seq", "first_icu_stay"]


def _vitals_with_stay_rows(icustays, chartevents, admissions, patients, max_icustay_id,
                           keep_stays: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    hours = _hours(icustays, chartevents, C.VITALS_8, max_icustay_id)
    stays = _result_stays(hours, icustays, admissions, patients)
    if keep_stays is not None:
        stays = stays.join(keep_stays, "icustay_id", "left_semi")
    stays = with_stay_ranks(stays)
    if limit is not None:   # each stay gives a row at least, so no other stay reaches the first ``limit`` rows
        stays = stays.orderBy(*ORDER).limit(limit)
    rows = _with_rn(hours.join(stays, "icustay_id"))
    measures = [name for _, name, _ in C.vital_measures(C.VITALS_8)]
    return rows.select("subject_id", "hadm_id", "icustay_id", "hr", "gender", "rn", *measures, *STAY_TAIL)


def vitals_with_stay(icustays: DataFrame, chartevents: DataFrame, admissions: DataFrame,
                     patients: DataFrame, *, max_icustay_id: int | None = None,
                     limit: int | None = 100) -> DataFrame:
    """JOB-7: 8-concept hourly vitals of the first 24 h with stay details,
    ordered by subject, admission, stay, hour; the first ``limit`` rows
    (``limit=None``: all rows).  ``max_icustay_id`` is the optional
    ``icustay_id < K`` development cut-off."""
    rows = _vitals_with_stay_rows(icustays, chartevents, admissions, patients, max_icustay_id, limit=limit)
    ordered = rows.orderBy("subject_id", "hadm_id", "icustay_id", "hr")
    return ordered.limit(limit) if limit is not None else ordered


def vitals_with_inout(icustays: DataFrame, chartevents: DataFrame, admissions: DataFrame,
                      patients: DataFrame, inputevents_cv: DataFrame, outputevents: DataFrame,
                      inputs: DataFrame, outputs: DataFrame, *,
                      max_icustay_id: int | None = None) -> DataFrame:
    """JOB-8: JOB-7 rows of stays with at least one CareVue input, plus the
    stay-hour's fluid sums.  The reference computes each sum with a
    correlated scalar subquery per output row; here ``inputs`` / ``outputs``
    are the (stay, hour) aggregates over all hours (JOB-3b, JOB-4b) and are
    left-joined once.  Its join to the raw input table only tests existence:
    a left semi join of the stays, not of their events, against the distinct
    input stays (deduplicated map-side before any shuffle)."""
    with_inputs = inputevents_cv.select("icustay_id").distinct()
    rows = _vitals_with_stay_rows(icustays, chartevents, admissions, patients, max_icustay_id,
                                  keep_stays=with_inputs)
    fin = inputs.select("icustay_id", "hr", *[n for n, _ in C.INPUT_SETS])
    fout = outputs.select("icustay_id", "hr", "out_urine", "out_total")
    out = rows.join(fin, ["icustay_id", "hr"], "left").join(fout, ["icustay_id", "hr"], "left")
    cols = rows.columns + [n for n, _ in C.INPUT_SETS] + ["out_urine", "out_total"]
    return out.select(*cols).orderBy("icustay_id", "hr", "subject_id", "hadm_id")


def vitals_with_admission_labs(icustays: DataFrame, chartevents: DataFrame, admissions: DataFrame,
                               patients: DataFrame, labevents: DataFrame, *,
                               max_icustay_id: int | None = None, limit: int = 100) -> DataFrame:
    """JOB-9 as its top-``limit`` report.

    The reference left-joins every (stay, hour) of vitals to *every* row of
    the admission's hospital-level lab table and groups by all lab columns,
    so a stay's rows are (vitals hour x distinct lab row of the admission),
    numbered by ``rn`` in (hour, lab row) order.  That product grows with the
    square of an admission's size, so it is never built whole.  Instead:

    * the charted values are aggregated by (stay, hour) once and stored; the first
      ``limit`` stays in output order come from there, and labs of other admissions
      are dropped before they are aggregated;
    * each of those stays has (hours) x (distinct lab rows, at least 1) rows; the
      running sum over the stays in order tells how many of its rows, if any,
      are among the first ``limit``;
    * a stay's rows are numbered rn = (hour - 1) * L + lab row, so only the
      hours and lab rows that make up those rows are joined: ``limit`` rows in all.
    """
    rules = VITALS_10_MIN
    hours = _hours(icustays, chartevents, rules, max_icustay_id)
    stays = _result_stays(hours, icustays, admissions, patients, age_digits=0)
    first = materialise(stays.orderBy(*ORDER).limit(limit), "first-stays")
    hour_order = Window.partitionBy("icustay_id").orderBy("hr")
    groups = (hours.join(first.select("icustay_id"), "icustay_id", "left_semi")
              .withColumn("__vpos", F.row_number().over(hour_order)))

    lab_cols = list(C.ADMISSION_LAB_COLUMNS)
    lab_order = Window.partitionBy("hadm_id").orderBy(*[F.col(c).asc_nulls_last() for c in lab_cols])
    labs = admission_labs(icustays, labevents.join(first.select("hadm_id").distinct(), "hadm_id", "left_semi"))
    distinct_labs = materialise(labs.select("hadm_id", *lab_cols).distinct(), "first-labs")
    lab_count = distinct_labs.groupBy("hadm_id").agg(F.count(F.lit(1)).alias("__nlab"))
    top_labs = (distinct_labs.withColumn("__lpos", F.row_number().over(lab_order))
                .where(F.col("__lpos") <= F.lit(limit)))

    counts = groups.groupBy("icustay_id").agg(F.count(F.lit(1)).alias("__nhour"))
    sized = first.join(counts, "icustay_id").join(lab_count, "hadm_id", "left").withColumn(
        "__nlab", F.greatest(F.coalesce(F.col("__nlab"), F.lit(0)), F.lit(1)))
    running = Window.orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)   # at most ``limit`` stays
    needed = F.lit(limit) - F.coalesce(F.sum(F.col("__nhour") * F.col("__nlab")).over(running), F.lit(0))
    sized = sized.withColumn("__need", needed).where(F.col("__need") > 0)

    base = (F.col("__vpos") - 1) * F.col("__nlab")
    rows = sized.join(groups, "icustay_id").where(base < F.col("__need")).withColumn("__base", base)
    picked = top_labs.select(F.col("hadm_id").alias("__adm"), "__lpos", *[F.col(c).alias("__lab_" + c) for c in lab_cols])
    rows = rows.join(picked, (F.col("hadm_id") == F.col("__adm")) & (F.col("__base") + F.col("__lpos") <= F.col("__need")), "left")
    rows = rows.withColumn("rn", (F.col("__base") + F.coalesce(F.col("__lpos"), F.lit(1))).cast("bigint"))

    vit_names = [name for _, name, _ in C.vital_measures(rules)]
    vit_out = [F.col(n).alias("glucose_vital" if n == "glucose" else n) for n in vit_names]
    return (rows.orderBy(*ORDER, "hr", "rn").limit(limit)
            .select("subject_id", "hadm_id", "icustay_id", "age", "gender",
                    F.col("admittime").alias("hospital_admission_date"),
                    F.col("dischtime").alias("hospital_discharge_date"),
                    F.col("los_hospital").alias("hospital_los"),
                    F.col("intime").alias("icu_admission_date"),
                    F.col("outtime").alias("icu_discharge_date"),
                    F.col("los_icu").alias("icu_los"), "ethnicity", "admission_type",
                    F.col("hr").alias("hour"), "rn", *vit_out,
                    *[F.col("__lab_" + src).alias(dst) for src, dst in C.LAB_RENAMES]))
