"""Hourly summary (JOB-6) and the one-pass draft summary (JOB-10).

Plan shape, all grains explicit:

* **stay grain** - stays joined to admission and patient, ranks, lengths of
  stay, age, the last cohort hour, the sorted list of hours that have a
  vitals row (at most 30 entries: vitals only exist for hours 0..29) and the
  global offset of the stay's vitals-less rows (``plans.numbering``).
* **stay-hour grain** - the cohort is generated from the stay rows by
  ``explode(sequence(0, n))`` so every stay attribute rides along without a
  join at the hourly grain.  The feature tables are united and grouped once on
  (icustay_id, hour), and the spine meets them in one left join
  (``merged_features``).  Stored, bucketed feature tables are joined one by one
  instead, without moving them (``stored_summary``).
* the final ``orderBy`` is a range-partitioned sort (no single task).

``rn`` reproduces ``ROW_NUMBER() OVER (PARTITION BY <vitals stay id> ORDER BY
<vitals hour>)``: hours with vitals are numbered within their stay; hours
without vitals all share the NULL partition and are numbered globally in the
order (subject_id, hadm_id, icustay_id, hour).  Both numbers are computed
arithmetically from the stay-grain hour list and offset, so no window ever
sees more than one stay's rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import concepts as C
from ..operators.cohort import with_last_hour
from ..operators.stays import demographics, stay_frame, with_stay_ranks
from ..sources.shared import materialise, side_by_side
from .numbering import exclusive_prefix_sum

ORDER = ["subject_id", "hadm_id", "icustay_id"]


def _stays(icustays: DataFrame, admissions: DataFrame, patients: DataFrame) -> DataFrame:
    st = with_last_hour(stay_frame(icustays, admissions, patients))
    return demographics(with_stay_ranks(st))


def numbered_spine(stays: DataFrame, vitals: DataFrame) -> DataFrame:
    """Stay rows -> cohort rows with ``co_hr`` (cohort hour), ``hr`` (the vitals
    hour: ``co_hr`` when the stay has vitals in that hour, else NULL) and ``rn``."""
    vh = vitals.groupBy("icustay_id").agg(F.array_sort(F.collect_list("hr")).alias("__vh"))
    hours = F.filter(F.coalesce(F.col("__vh"), F.array().cast("array<int>")),
                     lambda h: (h >= 0) & (h <= F.col("n_hours")))
    st = (stays.join(vh, "icustay_id", "left").withColumn("__vh", hours)
          .withColumn("__unmatched", (F.col("n_hours") + 1 - F.size("__vh")).cast("bigint")))
    st = exclusive_prefix_sum(st, ORDER, "__unmatched", "__offset")
    spine = st.withColumn("co_hr", F.explode(F.sequence(F.lit(0), F.col("n_hours"))))
    before = F.size(F.filter("__vh", lambda h: h < F.col("co_hr")))
    matched = F.array_contains(F.col("__vh"), F.col("co_hr"))
    keep = [c for c in spine.columns if c not in ("__vh", "__unmatched", "__offset")]
    return spine.select(
        *keep, F.when(matched, F.col("co_hr")).alias("hr"),
        F.when(matched, before + 1).otherwise(F.col("__offset") + F.col("co_hr") - before + 1)
        .cast("bigint").alias("rn"))


def attach(spine: DataFrame, feature: DataFrame, cols: list[str], rename: dict | None = None) -> DataFrame:
    """Left join of an hourly feature table on (icustay_id, cohort hour)."""
    rename = rename or {}
    f = feature.select("icustay_id", F.col("hr").alias("co_hr"),
                       *[F.col(c).alias(rename.get(c, c)) for c in cols])
    return spine.join(f, ["icustay_id", "co_hr"], "left")


def merged_features(parts: list[tuple[DataFrame, list[str], dict]]) -> DataFrame:
    """One wide row per (icustay_id, hr) that any of the feature tables holds, from
    (table, columns, renames) parts; ``__vitals`` tells whether the first one does.

    The tables are one union with the other tables' columns NULL and are grouped
    once, so the spine meets all of them in one join.  A table has one row per key:
    the maximum is that row's value."""
    wide = []
    for n, (table, cols, rename) in enumerate(parts):
        wide.append(table.select("icustay_id", "hr", F.lit(n == 0).alias("__vitals"), *[F.col(c).alias(rename.get(c, c)) for c in cols]))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), wide)
    return union.groupBy("icustay_id", "hr").agg(*[F.max(c).alias(c) for c in union.columns if c not in ("icustay_id", "hr")])


def _merged_summary(icustays: DataFrame, admissions: DataFrame, patients: DataFrame, parts: list[tuple[DataFrame, list[str], dict]]) -> DataFrame:
    """The spine with the merged feature tables; the first part holds the vitals."""
    stays, merged = side_by_side(
        icustays.sparkSession, lambda: _stays(icustays, admissions, patients),
        lambda: materialise(merged_features(parts), "features"))  # read twice: the vitals' hours, and all columns
    spine = numbered_spine(stays, merged.where("__vitals").select("icustay_id", "hr"))
    return attach(spine, merged, [c for c in merged.columns if c not in ("icustay_id", "hr", "__vitals")])


def _head() -> list:
    return ["subject_id", "hadm_id", "icustay_id", "age", "gender",
            F.col("admittime").alias("hospital_admission"), F.col("dischtime").alias("hospital_discharge"),
            "hospital_los", "ethnicity", F.col("intime").alias("icu_admission"),
            F.col("outtime").alias("icu_discharge"), "icu_los", "admission_type", "hr", "rn"]


def _tail() -> list:
    return ["hospstay_seq", "first_hosp_stay", "intime", "outtime", F.col("icu_los").alias("los_icu"),
            "icustay_seq", "first_icu_stay"]
SUMMARY_VITALS = [name for _, name, _ in C.vital_measures(C.VITALS_10) if name != "glucose"]
INPUT_COLS = [n for n, _ in C.INPUT_SETS] + ["in_total"]
OUTPUT_COLS = ["out_urine", "out_total"]


def _summary_rows(rows: DataFrame) -> DataFrame:
    return (rows.orderBy(*ORDER, "co_hr")
            .select(*_head(), *SUMMARY_VITALS, *C.LAB_OUTPUT_ORDER, *INPUT_COLS, *OUTPUT_COLS, *_tail()))


def hourly_summary(icustays: DataFrame, admissions: DataFrame, patients: DataFrame,
                   vitals: DataFrame, labs: DataFrame, inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """JOB-6: one row per cohort hour with demographics, vitals, labs, fluids
    and stay order (63 columns), ordered by subject, admission, stay, hour."""
    return _summary_rows(_merged_summary(icustays, admissions, patients, [
        (vitals, SUMMARY_VITALS, {}), (labs, list(C.LAB_OUTPUT_ORDER), {}), (inputs, INPUT_COLS, {}), (outputs, OUTPUT_COLS, {})]))


def stored_summary(icustays: DataFrame, admissions: DataFrame, patients: DataFrame,
                   vitals: DataFrame, labs: DataFrame, inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """JOB-6 over stored feature tables, each joined as it lies there: where they
    are bucketed by (icustay_id, hr), only the spine moves."""
    out = numbered_spine(_stays(icustays, admissions, patients), vitals)
    for table, cols in ((vitals, SUMMARY_VITALS), (labs, list(C.LAB_OUTPUT_ORDER)), (inputs, INPUT_COLS), (outputs, OUTPUT_COLS)):
        out = attach(out, table, cols)
    return _summary_rows(out)


def one_pass_summary(icustays: DataFrame, admissions: DataFrame, patients: DataFrame,
                     vitals: DataFrame, labs_uncapped: DataFrame) -> DataFrame:
    """JOB-10: the single-statement draft.  It joins the cohort to the *long*
    vitals and lab rows and averages afterwards; each stay-hour's product
    repeats every vitals value once per lab row and vice versa, so the
    averages equal the per-side hourly averages used here (aggregate before
    joining, no product).  Both glucose columns are kept, as glucose_vital and
    glucose_lab; the draft selects no fluid columns."""
    vit_cols = [name for _, name, _ in C.vital_measures(C.VITALS_10)]
    out = _merged_summary(icustays, admissions, patients, [
        (vitals, vit_cols, {"glucose": "glucose_vital"}), (labs_uncapped, list(C.LAB_OUTPUT_ORDER), {"glucose": "glucose_lab"})])
    vit_out = [("glucose_vital" if c == "glucose" else c) for c in vit_cols]
    lab_out = [("glucose_lab" if c == "glucose" else c) for c in C.LAB_OUTPUT_ORDER]
    return (out.orderBy(*ORDER, "co_hr")
            .select(*_head(), *vit_out, *lab_out, *_tail()))


def stay_ranks(icustays: DataFrame, admissions: DataFrame, patients: DataFrame) -> DataFrame:
    """Stay order flags of the stays that have cohort hours (as in the summary)."""
    return _stays(icustays, admissions, patients).select(
        *ORDER, "hospstay_seq", "first_hosp_stay", "intime", "outtime",
        F.col("icu_los").alias("los_icu"), "icustay_seq", "first_icu_stay")
