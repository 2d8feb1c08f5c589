"""Plan shape, alternative physical paths and the Parquet source/sink."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import canon, rows_of

from conftest import SF_SMALL
from hourgrid import oracle as O
from hourgrid import queries as Q
from hourgrid.operators import features as FE
from hourgrid.plans import variants as VA
from hourgrid.plans.joins import join_dimension, join_interval
from hourgrid.plans.numbering import exclusive_prefix_sum
from hourgrid.queries import round_doubles
from hourgrid.sources.proxy import load_proxy
from hourgrid.sources.tables import read_table, write_feature

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_no_product_joins(spark, name):
    plan = physical(Q.queries()[name](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name} plans a {bad}"


def _oracle_rows(duck, sql, cols):
    rel = duck.sql(sql)
    idx = [rel.columns.index(c) for c in cols]
    return canon([tuple(r[i] for i in idx) for r in rel.fetchall()])


@pytest.fixture()
def shuffled_joins(spark):
    """Nothing is broadcast: every join takes the path of large stay tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_join_dimension_with_hot_keys_nulls_and_equal_rows(spark, shuffled_joins):
    big = spark.createDataFrame([(7 if i % 3 == 0 else i % 2500 if i % 5 else None, i % 10) for i in range(6000)], "k long, v long")
    small = spark.createDataFrame([(k, f"s{k}") for k in range(2600)], "k long, s string")
    joined = join_dimension(big, small, "k")
    want = [(k, v, f"s{k}") for k, v in map(tuple, big.collect()) if k is not None]
    assert rows_of(joined, ["k", "v", "s"]) == canon(want)
    semi = join_dimension(big, small.where("k < 100"), "k", how="left_semi")
    assert rows_of(semi, ["k", "v"]) == canon([(k, v) for k, v, _ in want if k < 100])


def test_interval_join_equals_range_join(spark):
    import datetime as dt
    import random

    rnd, t0 = random.Random(5), dt.datetime(2024, 1, 1)
    when = lambda: t0 + dt.timedelta(minutes=rnd.randrange(60 * 24 * 9))
    # one admission with many stays, an empty interval, NULLs, one moment
    stays = [(10, i, *sorted((when(), when()))) for i in range(60)] + [(11, 90, t0, t0), (11, 91, when(), None), (12, 92, t0 + dt.timedelta(2), t0)]
    events = [(rnd.choice((10, 10, 11, 12, None)), when(), float(i)) for i in range(300)] + [(11, t0, -1.0), (10, None, -2.0)]
    small = spark.createDataFrame(stays, "k long, s long, a timestamp_ntz, b timestamp_ntz")
    big = spark.createDataFrame(events, "k long, t timestamp_ntz, v double")
    got = rows_of(join_interval(big, small, "k", "t", "a", "b"), ["k", "t", "v", "s"])
    want = [(k, t, v, s) for k, t, v in events for j, s, a, b in stays if k == j and t and b and a <= t <= b]
    assert got == canon(want)


@pytest.mark.parametrize("name", ["vitals_hourly", "labs_hourly", "inputs_hourly", "outputs_hourly", "hourly_summary",
                                  "stay_ranks", "vitals_with_stay"])
def test_shuffle_path_matches_oracle(spark, duck, shuffled_joins, name):
    df = Q.queries()[name](spark, SF_SMALL)
    plan = physical(df)
    if name in ("vitals_hourly", "labs_hourly", "inputs_hourly"):
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    cols = sorted(df.columns)
    assert rows_of(df, cols) == _oracle_rows(duck, O.oracle_sql()[name], cols)


def test_prefix_sum_equals_plain_window(spark):
    df = spark.range(0, 2000).select((F.col("id") % 37).alias("a"), (F.col("id") * 7 % 101).alias("b"),
                                     (F.col("id") % 5).alias("v"))
    got = exclusive_prefix_sum(df, ["a", "b"], "v", "off", num_blocks=7)
    w = Window.orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("off", F.coalesce(F.sum("v").over(w), F.lit(0)))
    # (a, b) is not unique here, so compare the multiset of (a, b, v, off) for unique keys only
    uniq = df.groupBy("a", "b").count().where("count = 1").select("a", "b")
    cols = ["a", "b", "v", "off"]
    assert rows_of(got.join(uniq, ["a", "b"]), cols) == rows_of(want.join(uniq, ["a", "b"]), cols)


@pytest.mark.parametrize("limit", [1, 7, 40, 100000])
def test_admission_labs_topk_against_full_product(spark, duck, limit):
    t = load_proxy(spark, SF_SMALL)
    df = round_doubles(VA.vitals_with_admission_labs(
        t.icustays, t.chartevents, t.admissions, t.patients, t.labevents, limit=limit))
    cols = sorted(df.columns)
    want = _oracle_rows(duck, O.vitals_with_admission_labs_sql(limit), cols)
    assert rows_of(df, cols) == want


def test_cutoff_ranks_count_the_filtered_stays(spark, duck):
    t = load_proxy(spark, SF_SMALL)
    k = sorted(r[0] for r in t.icustays.select("icustay_id").collect())[4]
    df = round_doubles(VA.vitals_with_stay(t.icustays, t.chartevents, t.admissions, t.patients,
                                           max_icustay_id=k, limit=None))
    cols = sorted(df.columns)
    assert rows_of(df, cols) == _oracle_rows(duck, O.vitals_with_stay_sql(None, cutoff=k), cols)
    assert df.select("icustay_id").distinct().count() <= 4


def test_parquet_sink_round_trip_and_pushdown(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    t = load_proxy(spark, SF_SMALL)
    base = str(tmp_path)
    for name in ("icustays", "chartevents", "labevents"):
        write_feature(getattr(t, name), f"{base}/{name}")
    st, ce, le = (read_table(spark, base, n) for n in ("icustays", "chartevents", "labevents"))
    assert st.count() == t.icustays.count()
    vit = FE.vitals_hourly(st, ce)
    assert rows_of(vit) == rows_of(FE.vitals_hourly(t.icustays, t.chartevents))
    plan = physical(vit)
    assert "PushedFilters: [In(itemid" in plan or "PushedFilters: [IsNotNull(itemid), In(itemid" in plan
    assert "ReadSchema: struct<icustay_id:bigint,charttime:timestamp_ntz,itemid:int,valuenum:double,error:int>" in plan
    lab_plan = physical(FE.labs_hourly(st, le))
    assert "GreaterThan(valuenum,0.0)" in lab_plan and "In(itemid, [50813" in lab_plan
    out = f"{base}/vitals_out"
    write_feature(vit, out)
    assert rows_of(spark.read.parquet(out)) == rows_of(vit)


def test_refresh_then_summary_reads_buckets(spark, tmp_path):
    from hourgrid.plans.refresh import refresh_features, summary_from_features
    from hourgrid.plans.summary import hourly_summary

    t = load_proxy(spark, SF_SMALL)
    names = refresh_features(t.icustays, t.chartevents, t.labevents, t.inputevents_cv, t.outputevents,
                             str(tmp_path), num_buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = summary_from_features(spark, t.icustays, t.admissions, t.patients, names)
        plan = physical(stored)
        inline = hourly_summary(t.icustays, t.admissions, t.patients, FE.vitals_hourly(t.icustays, t.chartevents),
                                FE.labs_hourly(t.icustays, t.labevents),
                                FE.inputs_hourly(t.icustays, t.inputevents_cv),
                                FE.outputs_hourly(t.icustays, t.outputevents))
        assert rows_of(round_doubles(stored)) == rows_of(round_doubles(inline))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the feature tables are bucketed on the join key: only the cohort side is shuffled for the joins
    assert plan.count("Bucketed: true") >= 3
    import re
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert not [k for k in keys if re.match(r"icustay_id#\d+L?, hr#", k)], keys
    assert plan.count("SortMergeJoin") >= 4


BOUNDED_SINGLE_PARTITION_INPUTS = ("HashAggregate(keys=[__blk", "LocalLimit", "TakeOrderedAndProject")


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_single_partition_exchanges_only_over_bounded_inputs(spark, name):
    """No row-level data is ever moved into one task: a SinglePartition
    exchange may only sit over the per-block totals of the numbering or over
    a limit."""
    plan = physical(Q.queries()[name](spark, SF_SMALL))
    if name == "vitals_with_admission_labs_top100":   # its one window runs over the stored first ``limit`` stays
        assert plan.count("hourgrid-first-stays") and plan.count("Exchange SinglePartition") == 1
        return
    lines = plan.split("\n")
    skip = ("WholeStageCodegen", "InputAdapter", "ColumnarToRow", "Project", "Filter", "Sort [", "HashAggregate(keys=[__blk], functions=[sum")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" not in line:
            continue
        child = next((nxt for nxt in lines[i + 1:] if not any(s in nxt for s in skip[:5])), "")
        assert any(b in child for b in BOUNDED_SINGLE_PARTITION_INPUTS), (name, child[:200])


def test_hot_key_rows_spread_over_tasks(spark, shuffled_joins):
    """AQE splits the join partition of a hot key although an aggregate on finer
    keys follows, because that aggregate shuffles its own partial sums."""
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        # key 0 holds a third of all rows
        big = spark.range(0, 300000, 1, 24).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
        small = spark.range(0, 300000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        out = join_dimension(big, small, "k").groupBy("k", (F.col("v") % 7).alias("h")).agg(F.sum("w").alias("w"))
        assert out.where("k = 0").count() == 7
        out.write.format("noop").mode("overwrite").save()
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
