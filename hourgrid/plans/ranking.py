"""Dense ranks of times within groups, without a window over a whole group.

``with_dense_ranks`` adds ``dense_rank() OVER (PARTITION BY g ORDER BY v ASC
NULLS LAST)`` columns.  The rows are stored once; the distinct (group, time)
pairs of all wanted ranks are numbered together by sorted blocks
(``numbering.number_within``), so no window sees more than one row per block of a
group, whatever the resolution of the times, and the plan under the rows runs
once.  NULL times come last and NULL groups are a group of their own, as in the
window; every join is null-safe.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialise
from .numbering import number_within


def with_dense_ranks(df: DataFrame, specs: list[tuple[str, str, str]]) -> DataFrame:
    """``specs``: (partition column, timestamp column, output column) triples."""
    rows = materialise(df, "ranked-rows")
    pairs = reduce(DataFrame.union, [
        rows.select(F.lit(n).alias("__k"), F.col(group).cast("string").alias("__g"), F.col(time).alias("__v"))
        for n, (group, time, _) in enumerate(specs)])
    places = number_within(pairs.distinct(), ["__k", "__g"], ["__v"], "__place")
    for n, (group, time, out) in enumerate(specs):
        own = places.where(F.col("__k") == F.lit(n)).select("__g", "__v", F.col("__place").alias(out))
        same = F.col(group).cast("string").eqNullSafe(F.col("__g")) & F.col(time).eqNullSafe(F.col("__v"))
        rows = rows.join(own, same).drop("__g", "__v")
    return rows
