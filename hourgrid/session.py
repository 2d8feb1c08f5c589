"""Session settings.

On a cluster the session is created by the platform and already names a
shared ``spark.checkpoint.dir``; the jobs only read it (``sources.shared``).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Configs the jobs are tuned for.  AQE coalesces the many small shuffle
# partitions of the per-hour aggregates and splits skewed join partitions
# of hot keys.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    # Plans that read cached tables print each cached plan inside them; AQE
    # rebuilds that description after every stage.  Cap its length so the
    # driver does not spend seconds formatting strings nobody reads.
    "spark.sql.maxPlanStringLength": "20000",
    "spark.sql.ui.explainMode": "simple",
}


def cluster_conf(largest_shuffle_bytes: int, *, target_partition_bytes: int = 256 << 20,
                 executor_cores: int = 4, executors: int = 1000) -> dict[str, str]:
    """Partition sizing for a cluster run.

    ``largest_shuffle_bytes`` is the size of the biggest exchange, which is
    the pruned, item-filtered event side of a stay join when the stay table
    is too large to broadcast (a fraction of the raw event bytes).  The
    initial shuffle width gives each reduce partition about
    ``target_partition_bytes`` of it, and never fewer than two waves of the
    cluster's cores.  AQE then coalesces the small per-hour aggregates and
    splits skewed join partitions.  Scan splits are 128 MB, so a task reads a
    bounded slice of any one file.
    """
    cores = executor_cores * executors
    partitions = max(2 * cores, -(-largest_shuffle_bytes // target_partition_bytes))
    return {
        **{k: v for k, v in RECOMMENDED_CONF.items() if not k.startswith("spark.ui.")},
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 2),
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        # runtime Bloom filters of stay keys too many to broadcast: up to a tenth of
        # false positives at 100 million stays, in 64 MB
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(16 << 30),
        "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": str(100_000_000),
        "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": str(100_000_000),
        "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(64 << 23),
    }


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "hourgrid",
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
