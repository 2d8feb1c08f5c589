"""Hourly feature tables: vitals, labs, fluid inputs and fluid outputs.

Each job has the same physical shape:

    scan (item / value predicates pushed to Parquet, only used columns read)
      -> join to the stay table on its key (``plans.joins.join_dimension``)
      -> narrow projection: hour bin, concept code / label, unit fixes
      -> hour window filter
      -> groupBy(icustay_id, hr) with conditional aggregates (one hash
         aggregate, partial before the shuffle, so a hot stay is combined
         map-side before anything moves)

Output grain is one row per (icustay_id, hr).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import concepts as C
from ..functions.timebin import hour_bin, window_end
from ..plans.joins import join_dimension, join_interval

_AGG = {"avg": F.avg, "min": F.min, "sum": F.sum}


def _hour_window(df: DataFrame, min_hr: int | None, max_hr: int | None) -> DataFrame:
    """Half-open window ``min_hr <= hr < max_hr`` (either side optional)."""
    if min_hr is not None:
        df = df.where(F.col("hr") >= F.lit(min_hr))
    if max_hr is not None:
        df = df.where(F.col("hr") < F.lit(max_hr))
    return df


def charted_vitals(icustays: DataFrame, chartevents: DataFrame,
                   rules: tuple[C.VitalRule, ...] = C.VITALS_10, *, window_hours: int = 24,
                   max_icustay_id: int | None = None, keep_keys: bool = False) -> DataFrame:
    """Long, coded vitals of the first ``window_hours`` of each stay.

    Rows: every charted value of a listed item with ``intime <= charttime <=
    intime + window`` and ``error`` not 1 (NULL and 0 kept).  Columns:
    icustay_id, hr, code (NULL when the plausibility gate fails; the row is
    kept), valuenum (Fahrenheit items converted to Celsius).
    ``max_icustay_id`` applies the reference's optional ``icustay_id < K``
    development cut-off.
    """
    items = C.vital_items(rules)
    ce = (chartevents
          .where(C.item_in("itemid", items) & ~F.col("error").eqNullSafe(1))
          .select("icustay_id", "charttime", "itemid", "valuenum"))
    stay_cols = ["icustay_id", "intime"] + (["subject_id", "hadm_id"] if keep_keys else [])
    stays = icustays.select(*stay_cols)
    if max_icustay_id is not None:
        ce = ce.where(F.col("icustay_id") < F.lit(max_icustay_id))
        stays = stays.where(F.col("icustay_id") < F.lit(max_icustay_id))
    joined = join_dimension(
        ce, stays, "icustay_id",
        lambda: F.col("charttime").between(F.col("intime"), window_end(F.col("intime"), window_hours)))
    keys = (["subject_id", "hadm_id"] if keep_keys else [])
    return joined.select(
        *keys, "icustay_id",
        hour_bin(F.col("intime"), F.col("charttime")).alias("hr"),
        C.concept_code("itemid", "valuenum", rules).alias("code"),
        C.to_celsius("itemid", "valuenum").alias("valuenum"))


def pivot_vitals(coded: DataFrame, rules: tuple[C.VitalRule, ...], group_cols: list[str]) -> DataFrame:
    """Conditional aggregate per concept code (avg, or min where the spec says so)."""
    aggs = [_AGG[agg](F.when(F.col("code") == F.lit(code), F.col("valuenum"))).alias(name)
            for code, name, agg in C.vital_measures(rules)]
    return coded.groupBy(*group_cols).agg(*aggs)


def vitals_hourly(icustays: DataFrame, chartevents: DataFrame,
                  rules: tuple[C.VitalRule, ...] = C.VITALS_10, *,
                  min_hr: int | None = 0, max_hr: int | None = 30) -> DataFrame:
    """JOB-1: hourly vitals of the first 24 h -> icustay_id, hr, one column per concept."""
    coded = _hour_window(charted_vitals(icustays, chartevents, rules), min_hr, max_hr)
    return pivot_vitals(coded, rules, ["icustay_id", "hr"])


def coded_labs(icustays: DataFrame, labevents: DataFrame, *, keep_hadm: bool = False) -> DataFrame:
    """Long, labelled labs matched to every stay of their admission whose
    ``[intime, outtime]`` holds the lab time.  Values <= 0 or NULL are
    dropped; values above the item limit become NULL (row kept)."""
    le = (labevents
          .where(C.item_in("itemid", C.lab_items()) & F.col("valuenum").isNotNull()
                 & (F.col("valuenum") > F.lit(0)))
          .select("hadm_id", "charttime", "itemid", "valuenum"))
    stays = icustays.select("hadm_id", "icustay_id", "intime", "outtime")
    joined = join_interval(le, stays, "hadm_id", "charttime", "intime", "outtime")
    return joined.select(
        *(["hadm_id"] if keep_hadm else []), "icustay_id",
        hour_bin(F.col("intime"), F.col("charttime")).alias("hr"),
        C.lab_label("itemid").alias("label"),
        C.null_implausible_lab("itemid", "valuenum").alias("valuenum"))


def labs_hourly(icustays: DataFrame, labevents: DataFrame, *,
                min_hr: int | None = 0, max_hr: int | None = 30) -> DataFrame:
    """JOB-2 / JOB-2b: hourly lab averages (25 columns) over the whole stay.

    ``max_hr=None, min_hr=None`` is the uncapped variant.
    """
    coded = _hour_window(coded_labs(icustays, labevents), min_hr, max_hr)
    return coded.groupBy("icustay_id", "hr").agg(*_lab_pivot({r.column: r for r in C.LABS if r.column},
                                                             C.LAB_OUTPUT_ORDER))


def _lab_pivot(rules: dict, columns) -> list:
    """avg per label; several items can share one."""
    return [F.avg(F.when(F.col("label") == F.lit(rules[c].label), F.col("valuenum"))).alias(c) for c in columns]


def admission_labs(icustays: DataFrame, labevents: DataFrame) -> DataFrame:
    """Hospital-level hourly lab table: hadm_id + hr + 19 labs (BANDS included),
    one row per (stay, hour) of the uncapped lab job, keyed for joins by
    admission."""
    coded = coded_labs(icustays, labevents, keep_hadm=True)
    aggs = _lab_pivot({r.raw_column: r for r in C.LABS}, C.ADMISSION_LAB_COLUMNS[1:])
    # hadm_id depends on the stay, so grouping by it too does not split groups.
    return (coded.groupBy("hadm_id", "icustay_id", "hr").agg(*aggs)
            .select("hadm_id", *C.ADMISSION_LAB_COLUMNS))


def _binned_events(icustays: DataFrame, events: DataFrame, cols: list[str]) -> DataFrame:
    """Events joined to their stay (no time bound) with the hour bin."""
    ev = events.select("icustay_id", "charttime", *cols)
    joined = join_dimension(ev, icustays.select("icustay_id", "intime"), "icustay_id")
    return joined.withColumn("hr", hour_bin(F.col("intime"), F.col("charttime")))


def inputs_hourly(icustays: DataFrame, inputevents_cv: DataFrame, *,
                  min_hr: int | None = 0, max_hr: int | None = 30, totals: bool = True) -> DataFrame:
    """JOB-3 / JOB-3b: hourly fluid input sums by item set, plus the 'ml' total."""
    binned = _hour_window(_binned_events(icustays, inputevents_cv, ["itemid", "amount", "amountuom"]),
                          min_hr, max_hr)
    aggs = [F.sum(F.when(C.item_in("itemid", items), F.col("amount"))).alias(name)
            for name, items in C.INPUT_SETS]
    if totals:
        aggs.append(F.sum(F.when(F.col("amountuom") == F.lit(C.TOTAL_UNIT), F.col("amount"))).alias("in_total"))
    return binned.groupBy("icustay_id", "hr").agg(*aggs)


def outputs_hourly(icustays: DataFrame, outputevents: DataFrame, *,
                   urine_items: tuple[int, ...] = C.URINE_14, unit: str | None = C.TOTAL_UNIT,
                   min_hr: int | None = 0, max_hr: int | None = 30) -> DataFrame:
    """JOB-4 / JOB-4b: hourly urine output and total output.

    ``unit=None`` totals every row regardless of unit (older variant).
    """
    binned = _hour_window(_binned_events(icustays, outputevents, ["itemid", "value", "valueuom"]),
                          min_hr, max_hr)
    total = F.col("value") if unit is None else F.when(F.col("valueuom") == F.lit(unit), F.col("value"))
    return binned.groupBy("icustay_id", "hr").agg(
        F.sum(F.when(C.item_in("itemid", urine_items), F.col("value"))).alias("out_urine"),
        F.sum(total).alias("out_total"))
