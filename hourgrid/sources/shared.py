"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own; on a cluster an
    unset folder is an error, since no machine-local folder would do.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="hourgrid-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage is cut at
    files that survive the loss of any executor, and later readers of the table
    prune columns."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/hourgrid-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, *runs: Callable[[], Any]) -> list:
    """The results of independent runs, begun together: the cluster need not wait for
    the last tasks of one before it begins the next."""
    with ThreadPoolExecutor(len(runs)) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(run)) for run in runs]
    return [run.result() for run in begun]
