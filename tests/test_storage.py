"""Refreshed tables: a failed refresh never costs the version before it."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import rows_of

from conftest import SF_SMALL
from hourgrid.plans.refresh import FEATURES, refresh_features, store_features, summary_from_paths
from hourgrid.plans.summary import hourly_summary
from hourgrid.queries import round_doubles
from hourgrid.sources.proxy import load_proxy
from hourgrid.sources.tables import publish_bucketed, publish_feature, read_feature, write_feature


def numbers(spark, n, bad=None):
    """n rows in four tasks, one of which fails midway if ``bad`` is its row."""
    rows = spark.range(0, n, 1, 4).withColumn("v", F.col("id") * 2)
    if bad is None:
        return rows
    return rows.withColumn("v", F.when(F.col("id") == bad, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("v")))


def versions(path):
    return sorted(d for d in os.listdir(path) if os.path.isdir(f"{path}/{d}"))


def test_published_table_survives_a_failed_refresh(spark, tmp_path):
    path = f"{tmp_path}/t"
    publish_feature(numbers(spark, 10), path)
    with pytest.raises(Exception, match="killed"):
        publish_feature(numbers(spark, 1000, bad=990), path)
    assert rows_of(read_feature(spark, path)) == [(i, 2 * i) for i in range(10)]
    publish_feature(numbers(spark, 20), path)
    assert read_feature(spark, path).count() == 20


def test_a_crash_before_the_swap_changes_nothing(spark, tmp_path, monkeypatch):
    from hourgrid.sources import tables as T

    path = f"{tmp_path}/t"
    publish_feature(numbers(spark, 10), path)
    monkeypatch.setattr(T, "_file_system", lambda *a: (_ for _ in ()).throw(OSError("driver lost")))
    with pytest.raises(OSError):
        publish_feature(numbers(spark, 20), path)
    assert read_feature(spark, path).count() == 10 and len(versions(path)) == 2


def test_readers_that_have_begun_keep_their_version(spark, tmp_path):
    path = f"{tmp_path}/t"
    publish_feature(numbers(spark, 10), path)
    begun = read_feature(spark, path)
    publish_feature(numbers(spark, 20), path)
    assert begun.count() == 10 and read_feature(spark, path).count() == 20
    for n in (30, 40, 50):
        publish_feature(numbers(spark, n), path)
    assert len(versions(path)) == 2 and read_feature(spark, path).count() == 50


def test_plain_folder_survives_a_failed_write(spark, tmp_path):
    path = f"{tmp_path}/plain"
    write_feature(numbers(spark, 10), path)
    with pytest.raises(Exception, match="killed"):
        write_feature(numbers(spark, 1000, bad=990), path)
    assert spark.read.parquet(path).count() == 10
    write_feature(numbers(spark, 30), path + "/")
    assert spark.read.parquet(path).count() == 30
    assert not [d for d in os.listdir(tmp_path) if d.startswith("plain.old")]


def test_bucketed_table_survives_a_failed_refresh(spark, tmp_path):
    path, name = f"{tmp_path}/b", "hourgrid_test_bucketed"
    publish_bucketed(numbers(spark, 10), path, name, ("id",), 4)
    with pytest.raises(Exception, match="killed"):
        publish_bucketed(numbers(spark, 1000, bad=990), path, name, ("id",), 4)
    assert rows_of(spark.table(name)) == [(i, 2 * i) for i in range(10)]
    for n in (20, 30, 40):
        publish_bucketed(numbers(spark, n), path, name, ("id",), 4)
    assert spark.table(name).count() == 40
    assert len([r for r in spark.sql(f"SHOW TABLES LIKE '{name}__v*'").collect()]) == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(name).join(spark.table(name).withColumnRenamed("v", "w"), "id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 40
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _inline(t):
    from hourgrid.operators import features as FE

    return hourly_summary(t.icustays, t.admissions, t.patients, FE.vitals_hourly(t.icustays, t.chartevents), FE.labs_hourly(t.icustays, t.labevents),
                          FE.inputs_hourly(t.icustays, t.inputevents_cv), FE.outputs_hourly(t.icustays, t.outputevents))


def test_summary_over_published_tables(spark, tmp_path):
    t = load_proxy(spark, SF_SMALL)
    for _ in range(2):   # the second refresh replaces the first
        paths = store_features(t.icustays, t.chartevents, t.labevents, t.inputevents_cv, t.outputevents, str(tmp_path))
    assert set(paths) == set(FEATURES) and all(len(versions(p)) == 2 for p in paths.values())
    got = summary_from_paths(spark, t.icustays, t.admissions, t.patients, paths)
    assert rows_of(round_doubles(got)) == rows_of(round_doubles(_inline(t)))


def test_a_failed_refresh_of_one_feature_is_told(spark, tmp_path):
    t = load_proxy(spark, SF_SMALL)
    broken = t.labevents.withColumn("valuenum", F.raise_error(F.lit("killed")).cast("double"))
    with pytest.raises(Exception, match="killed"):
        refresh_features(t.icustays, t.chartevents, broken, t.inputevents_cv, t.outputevents, str(tmp_path), prefix="hourgrid_broken_", num_buckets=2)
