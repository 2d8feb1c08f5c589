"""Base-table schemas, readers and the full-refresh feature sink.

The jobs only touch the columns listed here; reading with an explicit schema
keeps the scan pruned to them and avoids schema inference on large folders.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_L, _I, _D, _S, _TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


SCHEMAS: dict[str, T.StructType] = {
    "icustays": _schema(("subject_id", _L), ("hadm_id", _L), ("icustay_id", _L),
                        ("intime", _TS), ("outtime", _TS)),
    "admissions": _schema(("subject_id", _L), ("hadm_id", _L), ("admittime", _TS),
                          ("dischtime", _TS), ("admission_type", _S), ("ethnicity", _S),
                          ("hospital_expire_flag", _I)),
    "patients": _schema(("subject_id", _L), ("gender", _S), ("dob", _TS)),
    "chartevents": _schema(("icustay_id", _L), ("charttime", _TS), ("itemid", _I),
                           ("valuenum", _D), ("error", _I)),
    "labevents": _schema(("hadm_id", _L), ("charttime", _TS), ("itemid", _I), ("valuenum", _D)),
    "inputevents_cv": _schema(("icustay_id", _L), ("charttime", _TS), ("itemid", _I),
                              ("amount", _D), ("amountuom", _S)),
    "outputevents": _schema(("icustay_id", _L), ("charttime", _TS), ("itemid", _I),
                            ("value", _D), ("valueuom", _S)),
    "ventdurations": _schema(("icustay_id", _L), ("starttime", _TS)),
}

TABLES = tuple(SCHEMAS)


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Scan one base table stored as Parquet under ``path/<name>`` with its fixed schema."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{path.rstrip('/')}/{name}")


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _new_version() -> str:
    return f"v{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"


def write_feature(df: DataFrame, path: str) -> None:
    """A derived table as one plain Parquet folder that any reader can open.

    The rows are written beside ``path`` and moved there when they are complete; a
    table that was there is moved aside first and deleted last, so a write that
    fails leaves it as it was.  Between the two moves ``path`` is missing; readers
    that may run meanwhile use ``publish_feature``."""
    spark, version = df.sparkSession, _new_version()
    base = path.rstrip("/")
    df.write.parquet(f"{base}.{version}")
    fs, target = _file_system(spark, base)
    _, made = _file_system(spark, f"{base}.{version}")
    _, aside = _file_system(spark, f"{base}.old-{version}")
    replaced = fs.exists(target)
    if replaced and not fs.rename(target, aside):
        raise OSError(f"{base} could not be moved aside")
    if not fs.rename(made, target):
        raise OSError(f"{base}.{version} could not be moved to {base}")
    if replaced:
        fs.delete(aside, True)


def publish_feature(df: DataFrame, path: str, keep: int = 2) -> str:
    """Full refresh of a derived table (drop + create as select) that readers never
    see half done: the rows go to a folder of their own under ``path``, and the file
    ``CURRENT``, which names the folder to read, is then replaced in one rename.  A
    refresh that fails, at any point, leaves the version before it in place.  The
    newest ``keep`` versions stay for readers that have begun; older ones go.
    Returns the new version's folder."""
    spark, version = df.sparkSession, _new_version()
    base = path.rstrip("/")
    folder = f"{base}/{version}"
    df.write.parquet(folder)
    jvm = spark._jvm
    fs, pointer = _file_system(spark, f"{base}/CURRENT")
    _, staged = _file_system(spark, f"{base}/CURRENT.{version}")
    stream = fs.create(staged)
    stream.writeBytes(version)
    stream.close()
    replace = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    replace[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(staged), fs.makeQualified(pointer), replace)
    _, root = _file_system(spark, base)
    old = sorted(x.getPath().getName() for x in fs.listStatus(root) if x.isDirectory() and x.getPath().getName() <= version)
    for name in old[:-keep]:
        fs.delete(_file_system(spark, f"{base}/{name}")[1], True)
    return folder


def read_feature(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table refreshed by ``publish_feature``."""
    base = path.rstrip("/")
    version = spark.read.text(f"{base}/CURRENT").first()[0]
    return spark.read.parquet(f"{base}/{version}")


def publish_bucketed(df: DataFrame, path: str, name: str, bucket_cols: tuple[str, ...], num_buckets: int | None = None, keep: int = 2) -> str:
    """Full refresh of a derived table, bucketed and sorted by ``bucket_cols``, so
    joins on exactly those columns read co-partitioned buckets.

    Each refresh saves a table of its own (``name`` and a version) with its files
    under ``path``; the view ``name`` is then replaced, in one catalog step, to read
    it.  A refresh that fails leaves the view and its table as they were.  The
    newest ``keep`` versions stay for queries that have begun; older tables are
    dropped with their files.  Returns ``name``."""
    spark, version = df.sparkSession, _new_version()
    buckets = num_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = path.rstrip("/")
    (df.write.format("parquet").bucketBy(buckets, *bucket_cols).sortBy(*bucket_cols)
     .option("path", f"{base}/{version}").saveAsTable(f"{name}__{version}"))
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {name}__{version}")
    made = sorted(r["tableName"] for r in spark.sql(f"SHOW TABLES LIKE '{name}__v*'").collect())
    for old in made[:-keep]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")
        fs, place = _file_system(spark, f"{base}/{old.removeprefix(f'{name}__')}")
        fs.delete(place, True)
    return name
