"""One scan a table, bounded windows and lists, filters in front of shuffles."""

import datetime as dt
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from helpers import at, canon, rows_of, table

from conftest import SF_SMALL
from hourgrid.operators import features as FE
from hourgrid.operators.vent import vent_flag
from hourgrid.plans import summary as SU
from hourgrid.plans import variants as VA
from hourgrid.plans.joins import join_interval, listed_intervals
from hourgrid.plans.numbering import number_within
from hourgrid.plans.ranking import with_dense_ranks
from hourgrid.sources.proxy import load_proxy
from hourgrid.sources.tables import TABLES, read_table


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    """The base tables as stored Parquet folders."""
    folder, t = str(tmp_path_factory.mktemp("base")), load_proxy(spark, SF_SMALL)
    for name in TABLES:
        getattr(t, name).write.parquet(f"{folder}/{name}")
    return {name: read_table(spark, folder, name) for name in TABLES}


@pytest.fixture()
def static_plans(monkeypatch):
    """The static physical plans of all tables that a job stores."""
    plans, parquet = [], DataFrameWriter.parquet

    def recorded(self, *args, **kwargs):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return parquet(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", recorded)
    return plans


def scans(plans, name):
    return sum(len(re.findall(rf"FileScan parquet .*/{name}\]", p)) for p in plans)


def test_stay_ranks_scan_each_table_once(base, static_plans):
    out = SU.stay_ranks(base["icustays"], base["admissions"], base["patients"])
    plans = [*static_plans, out._jdf.queryExecution().executedPlan().toString()]
    assert {n: scans(plans, n) for n in ("icustays", "admissions", "patients")} == {"icustays": 1, "admissions": 1, "patients": 1}


@pytest.mark.parametrize("job", ["stay", "stay_top", "inout", "labs_top"])
def test_variants_scan_the_events_once(base, static_plans, job):
    b = base
    dims = (b["icustays"], b["chartevents"], b["admissions"], b["patients"])
    out = {
        "stay": lambda: VA.vitals_with_stay(*dims, limit=None),
        "stay_top": lambda: VA.vitals_with_stay(*dims, limit=100),
        "inout": lambda: VA.vitals_with_inout(*dims, b["inputevents_cv"], b["outputevents"],
                                              FE.inputs_hourly(b["icustays"], b["inputevents_cv"], min_hr=None, max_hr=None, totals=False),
                                              FE.outputs_hourly(b["icustays"], b["outputevents"], min_hr=None, max_hr=None)),
        "labs_top": lambda: VA.vitals_with_admission_labs(*dims, b["labevents"], limit=100),
    }[job]()
    plans = [*static_plans, out._jdf.queryExecution().executedPlan().toString()]
    assert scans(plans, "chartevents") == 1 and scans(plans, "admissions") == 1 and scans(plans, "patients") == 1
    assert scans(plans, "labevents") == (job == "labs_top")


def test_summary_meets_its_features_in_one_join(spark, base, static_plans):
    b = base
    out = SU.hourly_summary(b["icustays"], b["admissions"], b["patients"], FE.vitals_hourly(b["icustays"], b["chartevents"]),
                            FE.labs_hourly(b["icustays"], b["labevents"]), FE.inputs_hourly(b["icustays"], b["inputevents_cv"]),
                            FE.outputs_hourly(b["icustays"], b["outputevents"]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Join \[icustay_id#\d+L, co_hr#\d+\]", plan)) == 1
    for name in ("chartevents", "labevents", "inputevents_cv", "outputevents"):
        assert scans([*static_plans, plan], name) == 1


def test_number_within_equals_a_window(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.when(F.col("id") % 11 > 0, F.col("id") % 90)).alias("g"),
        F.when(F.col("id") % 13 > 0, F.col("id") * 7919 % 3001).alias("v"), "id")
    got = number_within(df, ["g"], ["v", "id"], "n")
    w = Window.partitionBy("g").orderBy(F.col("v").asc_nulls_last(), F.col("id").asc_nulls_last())
    cols = ["g", "v", "id", "n"]
    assert got.columns == cols and rows_of(got) == rows_of(df.withColumn("n", F.row_number().over(w)).select(*cols))
    assert number_within(df.where("false"), ["g"], ["v"], "n").count() == 0


def test_ranks_of_microsecond_times_of_one_day(spark, static_plans):
    """One group has thousands of times within one second: no window sees more than
    one row per block of it."""
    rows = spark.range(20000).select(F.lit(1).cast("long").alias("g"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, (id * 7919 % 20000) / 1000000)").alias("v"), "id")
    ranked = with_dense_ranks(rows, [("g", "v", "r")])
    w = Window.partitionBy("g").orderBy("v")
    assert rows_of(ranked, ["id", "r"]) == rows_of(rows.withColumn("r", F.dense_rank().over(w)), ["id", "r"])
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    windows = re.findall(r"Window \[[^\n]*", plan)
    assert windows and all("__blk" in x for x in windows) and not any("Window [" in p for p in static_plans)


LONG_STAYS = [(10, 1, at(0), at(24 * 365 * 1000)),                     # a thousand years
              (10, 2, at(0), dt.datetime(9999, 12, 31)), (10, 3, at(24 * 3), at(24 * 60)), (10, 4, at(24 * 5), at(24 * 5)),
              (10, 5, dt.datetime(1, 1, 1), at(24)), (11, 6, at(24), at(24 * 900)), (11, 7, at(48), at(24)), (11, 8, at(0), None)]


def test_a_stay_of_a_thousand_years_lists_few_blocks(spark):
    small = spark.createDataFrame(LONG_STAYS, "k long, s long, a timestamp_ntz, b timestamp_ntz")
    counts = dict(map(tuple, listed_intervals(small, "a", "b").groupBy("s").count().collect()))
    assert set(counts) == {1, 2, 3, 4, 5, 6} and max(counts.values()) <= 34 and counts[4] == 1
    events = [(k, at(24 * d, minutes=m), float(d)) for k in (10, 11, 12) for d in (-400000, -30, 0, 1, 2, 3, 5, 40, 60, 61, 900, 901, 300000, 2900000) for m in (0, 1)]
    big = spark.createDataFrame(events, "k long, t timestamp_ntz, v double")
    got = rows_of(join_interval(big, small, "k", "t", "a", "b"), ["k", "t", "v", "s"])
    want = [(k, t, v, s) for k, t, v in events for j, s, a, b in LONG_STAYS if k == j and b and a <= t <= b]
    assert got == canon(want)


def test_events_are_not_repeated_where_stays_are_short(spark):
    """Only the levels that some stay uses are looked up."""
    big = spark.createDataFrame([(1, at(h), float(h)) for h in range(200)], "k long, t timestamp_ntz, v double")

    def looked_up(stays):
        small = spark.createDataFrame(stays, "k long, s long, a timestamp_ntz, b timestamp_ntz")
        out = join_interval(big, small, "k", "t", "a", "b")
        out.collect()
        found = []

        def walk(node):
            if node.nodeName() == "Generate" and "__at_level" in node.simpleString(100):
                found.append(node.metrics().apply("numOutputRows").value())
            plan = {"AdaptiveSparkPlan": "executedPlan"}.get(node.nodeName()) or ("plan" if node.nodeName().endswith("QueryStage") else None)
            if plan:
                walk(getattr(node, plan)())
            for i in range(node.children().size()):
                walk(node.children().apply(i))

        walk(out._jdf.queryExecution().executedPlan())
        return found

    assert looked_up([(1, 1, at(0), at(30 * 24)), (1, 2, at(5), at(6))]) == [200]
    assert looked_up([(1, 1, at(0), at(30 * 24)), (1, 2, at(5), at(24 * 365 * 1000))]) == [400]


def test_labs_of_a_thousand_year_stay(spark):
    st = table(spark, "icustays", [(1, 10, 100, at(0), at(24 * 365 * 1000)), (1, 10, 101, at(1), at(10))])
    le = table(spark, "labevents", [(10, at(2), 50862, 3.0), (10, at(24 * 300000), 50862, 4.0)])
    got = rows_of(FE.labs_hourly(st, le, min_hr=None, max_hr=None), ["icustay_id", "hr", "albumin"])
    assert got == [(100, 2, 3.0), (100, 24 * 300000, 4.0), (101, 1, 3.0)]


def test_events_of_unknown_stays_are_not_shuffled(spark, base):
    """With stays too many to broadcast, a runtime Bloom filter of their keys stands
    in front of the event shuffle."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        known = base["icustays"].where("icustay_id % 5 = 0")
        n_known = base["ventdurations"].join(known.select("icustay_id"), "icustay_id", "left_semi").count()
        out = vent_flag(base["ventdurations"], known)
        assert len(out.collect()) == n_known < base["ventdurations"].count() / 2
        shuffled = []

        def walk(node):
            name = node.nodeName()
            if name == "Exchange":
                shuffled.append((node.toString(), node.metrics().apply("shuffleRecordsWritten").value()))
            if name == "AdaptiveSparkPlan":
                walk(node.executedPlan())
            elif name.endswith("QueryStage"):
                walk(node.plan())
            for i in range(node.children().size()):
                walk(node.children().apply(i))

        walk(out._jdf.queryExecution().executedPlan())
        filtered = [n for text, n in shuffled if "might_contain" in text and "starttime" in text]
        assert filtered and max(filtered) <= n_known + 3     # false positives are rare
        for df in (FE.vitals_hourly(base["icustays"], base["chartevents"]), FE.inputs_hourly(base["icustays"], base["inputevents_cv"])):
            assert "might_contain" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
