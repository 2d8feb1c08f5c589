"""Hand-made edge tables: one test per semantic rule of the jobs."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import at, rows_of, table

from hourgrid.functions.timebin import hour_bin
from hourgrid.operators import features as FE
from hourgrid.operators.cohort import hourly_cohort
from hourgrid.operators.stays import with_stay_ranks
from hourgrid.operators.vent import vent_flag
from hourgrid.plans import summary as SU

STAY = [(1, 10, 100, at(0), at(48))]


def stays(spark, rows=STAY):
    return table(spark, "icustays", rows)


def test_hour_bin_edges(spark):
    df = spark.createDataFrame(
        [(at(0), at(0)), (at(0), at(micros=1)), (at(0), at(1)), (at(0), at(1, micros=1)),
         (at(0), at(minutes=-59)), (at(0), at(minutes=-61)), (at(0), at(24))],
        "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(hour_bin(F.col("a"), F.col("b"))).collect()]
    assert got == [0, 1, 1, 2, 0, -1, 24]


def _chart(spark, rows, stay=100):
    return table(spark, "chartevents", [(r[4] if len(r) > 4 else stay, *r[:4]) for r in rows])


def test_vitals_window_closed_and_error_flag(spark):
    ce = _chart(spark, [
        (at(0), 211, 80.0, None),          # hr 0, error NULL kept
        (at(24), 211, 90.0, 0),            # window end is inclusive -> hr 24
        (at(24, micros=1), 211, 70.0, 0),  # beyond 24 h: dropped
        (at(minutes=-1), 211, 60.0, 0),    # before intime: dropped
        (at(2), 211, 100.0, 1),            # error = 1: dropped
        (at(2), 211, 50.0, 0),
    ])
    got = rows_of(FE.vitals_hourly(stays(spark), ce), ["hr", "heart_rate"])
    assert got == [(0, 80.0), (2, 50.0), (24, 90.0)]


def test_vitals_plausibility_gates_keep_the_row(spark):
    ce = _chart(spark, [
        (at(1), 211, 0.0, 0), (at(1), 211, 299.9, 0), (at(1), 211, 300.0, 0),
        (at(2), 646, 100.0, 0), (at(2), 646, 100.1, 0),
        (at(3), 678, 70.0, 0), (at(3), 678, 98.6, 0), (at(3), 676, 37.0, 0), (at(3), 678, 120.0, 0),
        (at(4), 807, 0.1, 0),
        (at(5), 211, 300.0, 0),   # only an implausible value: the hour still exists
    ])
    got = {r["hr"]: r for r in FE.vitals_hourly(stays(spark), ce).collect()}
    assert got[1]["heart_rate"] == 299.9
    assert got[2]["spo2"] == 100.0
    assert abs(got[3]["temperature"] - 37.0) < 1e-9       # 98.6 F -> 37 C averaged with 37 C
    assert got[4]["glucose"] == 0.1
    assert 5 in got and all(got[5][c] is None for c in ("heart_rate", "spo2", "temperature"))


def test_unlisted_items_are_not_rows(spark):
    ce = _chart(spark, [(at(1), 1, 80.0, 0)])
    assert FE.vitals_hourly(stays(spark), ce).count() == 0


def _labs(spark, rows):
    return table(spark, "labevents", rows)


def test_lab_values_and_limits(spark):
    le = _labs(spark, [
        (10, at(1), 50862, None), (10, at(1), 50862, 0.0), (10, at(1), 50862, -1.0),  # dropped rows
        (10, at(2), 50862, 10.0),        # at the limit: kept
        (10, at(3), 50862, 10.5),        # above: NULL, row kept
        (10, at(4), 51300, 5.0), (10, at(4), 51301, 7.0),  # WBC from both items
        (10, at(5), 51144, 5.0),         # BANDS only: all-NULL row
    ])
    got = {r["hr"]: r for r in FE.labs_hourly(stays(spark), le).collect()}
    assert 1 not in got
    assert got[2]["albumin"] == 10.0
    assert got[3]["albumin"] is None
    assert got[4]["white_cell_count"] == 6.0
    assert set(got) == {2, 3, 4, 5}
    assert all(v is None for k, v in got[5].asDict().items() if k not in ("icustay_id", "hr"))


def test_lab_matches_every_stay_of_its_admission(spark):
    st = stays(spark, [(1, 10, 100, at(0), at(10)), (1, 10, 101, at(5), at(20)), (1, 11, 102, at(0), at(10))])
    le = _labs(spark, [
        (10, at(6), 50862, 3.0),    # inside both stays of admission 10
        (10, at(0), 50862, 4.0),    # on intime of 100
        (10, at(20), 50862, 5.0),   # on outtime of 101
        (10, at(30), 50862, 6.0),   # outside every stay
    ])
    got = rows_of(FE.labs_hourly(st, le), ["icustay_id", "hr", "albumin"])
    assert got == [(100, 0, 4.0), (100, 6, 3.0), (101, 1, 3.0), (101, 15, 5.0)]


def test_fluid_units_and_negative_hours(spark):
    iec = table(spark, "inputevents_cv", [
        (100, at(minutes=-59), 30018, 100.0, "ml"),   # hr 0, kept
        (100, at(minutes=-61), 30018, 50.0, "ml"),    # hr -1, dropped
        (100, at(1), 30018, 10.0, "mL"),              # saline counted, not in total
        (100, at(1), 1, 20.0, "ml"),                  # unlisted item counts in total
        (100, at(1), 30021, 5.0, None),
    ])
    got = {r["hr"]: r for r in FE.inputs_hourly(stays(spark), iec).collect()}
    assert set(got) == {0, 1}
    assert got[0]["in_saline"] == 100.0 and got[0]["in_total"] == 100.0
    assert got[1]["in_saline"] == 10.0 and got[1]["in_csl"] == 5.0 and got[1]["in_total"] == 20.0
    assert got[1]["in_albumin"] is None and got[1]["in_starch"] is None


def test_outputs_unit_variants(spark):
    oe = table(spark, "outputevents", [
        (100, at(1), 40055, 100.0, "ml"), (100, at(1), 50055, 10.0, "mL"), (100, at(1), 50055, 1.0, None)])
    cur = rows_of(FE.outputs_hourly(stays(spark), oe), ["hr", "out_urine", "out_total"])
    old = rows_of(FE.outputs_hourly(stays(spark), oe, urine_items=FE.C.URINE_11, unit=None,
                                    min_hr=None, max_hr=None), ["hr", "out_urine", "out_total"])
    assert cur == [(1, 100.0, 100.0)]
    assert old == [(1, 11.0, 111.0)]


def test_cohort_stay_times(spark):
    st = stays(spark, [
        (1, 10, 100, at(0), None),                   # NULL outtime: no rows
        (1, 10, 101, at(0), at(-2)),                 # 2 h before: no rows
        (1, 10, 102, at(0), at(minutes=-30)),        # 30 min before: hr 0 only
        (1, 10, 103, at(0), at(3)),                  # exactly 3 h: 0..3
        (1, 10, 104, at(0), at(3, micros=1)),        # just over: 0..4
    ])
    got = rows_of(hourly_cohort(st), ["icustay_id", "hr"])
    assert got == [(102, 0), (103, 0), (103, 1), (103, 2), (103, 3),
                   (104, 0), (104, 1), (104, 2), (104, 3), (104, 4)]


def test_dense_ranks_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, 10, 100, dt.datetime(2024, 1, 1), at(0)), (1, 11, 101, dt.datetime(2024, 1, 1), at(5)),
         (1, 12, 102, None, at(1)), (1, 13, 103, dt.datetime(2023, 1, 1), at(2)),
         (1, 13, 104, dt.datetime(2023, 1, 1), at(1))],
        "subject_id bigint, hadm_id bigint, icustay_id bigint, admittime timestamp_ntz, intime timestamp_ntz")
    got = rows_of(with_stay_ranks(df), ["icustay_id", "hospstay_seq", "first_hosp_stay", "icustay_seq", "first_icu_stay"])
    assert got == [(100, 2, "N", 1, "Y"), (101, 2, "N", 1, "Y"), (102, 3, "N", 1, "Y"),
                   (103, 1, "Y", 2, "N"), (104, 1, "Y", 1, "Y")]


def test_vent_flag(spark):
    vd = table(spark, "ventdurations", [(100, dt.datetime(2024, 1, 1, 0, 59)), (100, dt.datetime(2024, 1, 1, 1, 0)),
                                        (100, None), (999, dt.datetime(2024, 1, 1, 5, 0))])
    got = rows_of(vent_flag(vd, stays(spark)), ["icustay_id", "isventilated"])
    assert got == [(100, 0), (100, 0), (100, 1)]


def test_summary_numbering_and_hour(spark):
    st = stays(spark, [(1, 10, 100, at(0), at(3)), (1, 10, 101, at(10), at(11)), (2, 20, 200, at(0), at(2))])
    adm = table(spark, "admissions", [(1, 10, at(-1), at(30), "E", "A", 0), (2, 20, at(-1), at(30), "E", "B", 1)])
    pat = table(spark, "patients", [(1, "M", dt.datetime(1950, 1, 1)), (2, "F", dt.datetime(1960, 1, 1))])
    ce = _chart(spark, [(at(1), 211, 80.0, 0), (at(3), 211, 90.0, 0), (at(10), 211, 70.0, 0, 101),
                        (at(10), 211, 60.0, 0)])   # stay 100 hour 10: beyond its cohort hours
    vit = FE.vitals_hourly(st, ce)
    empty_labs = FE.labs_hourly(st, _labs(spark, []).where("false"))
    empty_in = FE.inputs_hourly(st, table(spark, "inputevents_cv", []))
    empty_out = FE.outputs_hourly(st, table(spark, "outputevents", []))
    out = SU.hourly_summary(st, adm, pat, vit, empty_labs, empty_in, empty_out)
    got = [(r["icustay_id"], r["hr"], r["rn"], r["heart_rate"]) for r in out.collect()]
    # matched hours numbered within their stay; the others globally in output order
    assert got == [(100, None, 1, None), (100, 1, 1, 80.0), (100, None, 2, None), (100, 3, 2, 90.0),
                   (101, 0, 1, 70.0), (101, None, 3, None),
                   (200, None, 4, None), (200, None, 5, None), (200, None, 6, None)]
    assert len(out.columns) == 63


def test_hour_bin_is_wall_clock_in_any_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 1, 0), dt.datetime(2024, 3, 10, 3, 0))],
                                   "a timestamp_ntz, b timestamp_ntz")
        assert df.select(hour_bin(F.col("a"), F.col("b"))).first()[0] == 2   # clocks skip 02:00 here
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_dense_ranks_equal_window_with_null_groups_and_a_hot_group(spark):
    """NULL groups and NULL times are kept, ties share a rank, and the group that
    holds most rows ranks as a plain window does."""
    from pyspark.sql import Window

    from hourgrid.plans.ranking import with_dense_ranks
    rows = [(g, at(hours=(i * 7) % 100, minutes=i % 3) if i % 6 else None, i) for g in (1, 2, None) for i in range(30)]
    rows += [(7, at(hours=i % 83), i) for i in range(400)]
    df = spark.createDataFrame(rows, "g long, v timestamp_ntz, i long")
    w = Window.partitionBy("g").orderBy(F.col("v").asc_nulls_last())
    want = rows_of(df.withColumn("r", F.dense_rank().over(w)), ["g", "v", "i", "r"])
    got = rows_of(with_dense_ranks(df, [("g", "v", "r")]), ["g", "v", "i", "r"])
    assert len(got) == len(rows) and got == want
