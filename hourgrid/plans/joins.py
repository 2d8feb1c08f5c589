"""Fact-to-dimension joins that stay balanced when one key is hot.

Every feature job joins a very large event table to the stay table on an equi
key, sometimes with a time range as residual predicate.  Nothing is measured,
sampled or collected while a plan is built, and no broadcast is forced:

* Spark broadcasts the stay side where its own size check
  (``spark.sql.autoBroadcastJoinThreshold``, and at run time AQE's measured size
  of the shuffled rows) allows it; the event side is then not shuffled at all.
* Otherwise the join is a sort-merge join on ``(key, hash of key)``.  The second
  key says nothing new, but a later aggregate by stay and hour can no longer
  take the join's partitioning for its own.  It combines map-side and shuffles
  its own small partial sums, and AQE is free to split a join partition that a
  hot key makes too large, at any number of hot keys and however many of its
  rows are alike.  In front of that shuffle Spark may put a runtime Bloom filter of
  the stay keys, so events of unknown stays are not shuffled.  It builds one only
  from a side that it takes for filtered: the comparison on the hash of the stay
  key, which holds for every key, marks the side so.  ``session.cluster_conf``
  sizes the filter; below Spark's own limit on the event side (10 GB) there is none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_LEAST = -(2**63)


def join_dimension(
    big: DataFrame,
    small: DataFrame,
    key: str,
    condition: Callable[[], Column] | None = None,
    how: str = "inner",
) -> DataFrame:
    """``big`` joined to ``small`` on ``big[key] == small[key]`` (plus an optional
    residual ``condition`` over columns whose names are unique across both sides).

    ``how`` is ``inner`` or ``left_semi``.  The key column appears once in the
    output.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError(f"unsupported join type {how!r}")
    rkey = f"__{key}_r"
    right = small.withColumnRenamed(key, rkey).where(F.xxhash64(rkey) >= F.lit(_LEAST))
    cond = (F.col(key) == F.col(rkey)) & (F.xxhash64(F.col(key)) == F.xxhash64(F.col(rkey)))
    if condition is not None:
        cond = cond & condition()
    out = big.join(right, cond, how)
    return out.drop(rkey) if how == "inner" else out


STEP_BITS = 5  # a level's blocks are 2**5 blocks of the level below; level 0 has days
LEVELS = 5  # 32**4 days are more than the calendar has


def _block(day: Column, level: Column) -> Column:
    return F.floor(day / F.pow(F.lit(2.0), level * STEP_BITS)).cast("int")


def _with_levels(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows with a non-empty interval, their first and last day and the lowest level
    at which those are at most 33 steps apart."""
    first, last = F.unix_date(F.to_date(start)), F.unix_date(F.to_date(end))
    level = F.lit(LEVELS - 1)
    for n in reversed(range(LEVELS - 1)):
        level = F.when(last - first <= 1 << (STEP_BITS * (n + 1)), F.lit(n)).otherwise(level)
    return df.where(F.col(start) <= F.col(end)).withColumns({"__first": first, "__last": last, "__level": level})


def listed_intervals(df: DataFrame, start: str, end: str) -> DataFrame:
    """``df`` with one row per (``__level``, ``__block``) that an interval touches: at
    most 34, however long it is.  Rows without a time and empty intervals are not
    listed."""
    blocks = F.sequence(_block(F.col("__first"), F.col("__level")), _block(F.col("__last"), F.col("__level")))
    return _with_levels(df, start, end).withColumn("__block", F.explode(blocks)).drop("__first", "__last")


def _levels_in_use(df: DataFrame, start: str, end: str) -> Column:
    """array<int> of the levels some interval takes, as a scalar subquery (its limit
    names the bound and cuts nothing)."""
    levels = _with_levels(df.select(start, end), start, end).select("__level").distinct().limit(LEVELS)
    return levels.agg(F.collect_list("__level")).scalar()


def join_interval(big: DataFrame, small: DataFrame, key: str, at: str, start: str, end: str) -> DataFrame:
    """Rows of ``big`` with every row of ``small`` that has the same key and an
    interval ``start <= at <= end`` (both ends included).

    Intervals are listed under blocks of days, long ones under larger blocks
    (``listed_intervals``), and an event looks at its own block of each level that
    some interval uses: intervals of up to a month use the days alone, so events
    are not repeated, and one interval of a thousand years adds one level.  The
    events of a key with many intervals so meet those of their own blocks only.  An
    event has one block a level and an interval one level, so no pair is found
    twice.  Rows with a null key or time and empty intervals match nothing, as in
    the plain range join.
    """
    listed = listed_intervals(small, start, end).withColumnRenamed(key, f"__{key}_r")
    dated = big.withColumns({"__day": F.unix_date(F.to_date(at)), "__at_level": F.explode(_levels_in_use(small, start, end))})
    cond = ((F.col(key) == F.col(f"__{key}_r")) & (F.col("__at_level") == F.col("__level"))
            & (_block(F.col("__day"), F.col("__at_level")) == F.col("__block"))
            & (F.col(at) >= F.col(start)) & (F.col(at) <= F.col(end)))
    return dated.join(listed, cond).drop("__day", "__at_level", "__level", "__block", f"__{key}_r")
