"""Global and grouped numbering without a window over unbounded rows.

``number_within`` numbers the rows of each group: the rows are range-partitioned
and sorted by group and order, a sorted block numbers its own rows, and the counts
of a group's earlier blocks are summed up, which takes one row per block and group.

``exclusive_prefix_sum`` gives every row the sum of ``value_col`` over all
rows before it in a total order.  It is computed in two levels:

1. ``repartitionByRange`` cuts the rows into contiguous, similarly sized
   blocks (a hot leading key is still split, since the cut points are on the
   full composite key) and the block id is ``spark_partition_id()``.  The
   blocked rows are written to the shared folder and read back, so the block
   totals and the rows can never disagree about the cut points, whatever
   executors are lost later.
2. Block totals (one row per block) are prefix-summed - the only window
   without a partition key, over at most ``num_blocks`` rows - and broadcast
   back (a bounded broadcast: ``num_blocks`` rows); within a block a window
   partitioned by block id adds the running sum.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import materialise


def exclusive_prefix_sum(df: DataFrame, order_cols: list[str], value_col: str, out_col: str,
                         num_blocks: int | None = None) -> DataFrame:
    n = num_blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocked = materialise(df.repartitionByRange(n, *[F.col(c).asc_nulls_last() for c in order_cols])
                          .withColumn("__blk", F.spark_partition_id()), "blocks")
    totals = blocked.groupBy("__blk").agg(F.sum(value_col).alias("__blk_total"))
    before = Window.orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__blk", F.coalesce(F.sum("__blk_total").over(before), F.lit(0))
                            .cast("bigint").alias("__blk_offset"))
    inside = (Window.partitionBy("__blk").orderBy(*[F.col(c).asc_nulls_last() for c in order_cols])
              .rowsBetween(Window.unboundedPreceding, -1))
    joined = blocked.join(F.broadcast(offsets), "__blk")
    keep = [c for c in joined.columns if c not in ("__blk", "__blk_offset")]
    return joined.select(*keep, (F.col("__blk_offset") + F.coalesce(F.sum(value_col).over(inside), F.lit(0))
                                 .cast("bigint")).alias(out_col))


def number_within(df: DataFrame, group_cols: list[str], order_cols: list[str], out_col: str) -> DataFrame:
    """``row_number() OVER (PARTITION BY group_cols ORDER BY order_cols)``, NULLs last.

    The sorted blocks are stored, so the numbers and the rows cannot disagree about
    the cut points."""
    keys = [F.col(c).asc_nulls_last() for c in [*group_cols, *order_cols]]
    blocks = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    blocks = materialise(blocks.withColumns({"__blk": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}), "blocks")
    counts = blocks.groupBy(*group_cols, "__blk").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    earlier = Window.partitionBy(*group_cols).orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    named = {c: f"__s_{c}" for c in [*group_cols, "__blk"]}
    starts = counts.withColumn("__shift", F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first") + 1)
    starts = starts.withColumnsRenamed(named).drop("__n", "__first")
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(s)) for c, s in named.items()])
    return blocks.join(starts, same).select(*df.columns, (F.col("__at") + F.col("__shift")).cast("bigint").alias(out_col))
