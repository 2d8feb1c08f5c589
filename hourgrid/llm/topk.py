"""Exact top-k search by distributed histogram selection.

Candidates stay where they are stored; a bounded block of queries at a time goes to
all of them, and every score is computed (a tile of candidates, one matrix product).
Instead of ranking scores, each round counts them: per query a global histogram over
the current score interval is summed up, the bin that holds the k-th highest score
becomes the next interval, and after a few rounds the interval is one integer wide,
the exact k-th value.  A last pass keeps the scores from that value on and breaks ties
by the smaller id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, read_table

SCALE = 256
BINS = 4096  # bins of a histogram round
NONE = np.iinfo(np.int64).min  # below every score
CANDIDATE_BLOCK = 2048  # candidates of a tile
QUERY_BLOCK = 4096  # queries that go to the candidates together, on average


def usable(vector: str) -> Column:
    """True for a vector without null and non-finite components."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def by_length(ids: np.ndarray, vectors: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, ids, matrix) of the vectors of each length, floor(SCALE * x) as integers."""
    lengths = np.diff(vectors.offsets.to_numpy())
    whole = np.floor(SCALE * vectors.flatten().to_numpy().astype(np.float64))
    if len(whole) and np.abs(whole).max() >= 2.0**63:
        raise ArithmeticError("a component is beyond 64 bits")
    ends = np.cumsum(lengths)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, ids[rows], whole[(ends[rows] - length)[:, None] + np.arange(length)].astype(np.int64)


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: in floating point where that is exact, in
    64-bit or unbounded integers beyond; a product that is no long is an error."""
    largest = [int(np.abs(x.astype(object)).max()) if x.size and x.min() == NONE else int(np.abs(x).max()) if x.size else 0 for x in (left, right)]
    bound = left.shape[1] * largest[0] * largest[1]
    if bound < 2**53:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    if bound < 2**63:
        return left @ right.T
    exact = left.astype(object) @ right.T.astype(object)
    if exact.size and (exact.max() >= 2**63 or exact.min() <= -(2**63)):
        raise ArithmeticError("a score is beyond 64 bits")
    return exact.astype(np.int64)


def best_mask(scores: np.ndarray, k: int) -> np.ndarray:
    """Mask of each row's scores from its own k-th highest on (NONE: no score)."""
    if scores.shape[1] <= k:
        return scores > NONE
    least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    return (scores > NONE) & (scores >= least[:, None])


Columns = tuple[np.ndarray, ...]


class Pass:
    """One pass over all candidates with a block of queries.

    ``tile`` makes columns of a tile's (places, query ids, candidate ids, scores);
    ``merge`` makes one such set of several, and is applied as they gather, so a task
    holds and returns what its merged columns take."""

    def __init__(self, queries: pa.Table, names: list[str], kinds: str, tile: Callable[..., Columns], merge: Callable[[Columns], Columns]):
        self.queries, self.names, self.kinds, self.tile, self.merge = queries, names, kinds, tile, merge

    def over(self, candidates: DataFrame, size: int) -> DataFrame:
        ids, vectors, tile, merge, names = self.queries["vec_id"].to_numpy(), self.queries["vector"].combine_chunks(), self.tile, self.merge, self.names

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked = {m.shape[1]: (places, own, m) for places, own, m in by_length(ids, vectors)}
            gathered: list[Columns] = []
            for batch in batches:
                for _, held, matrix in by_length(batch.column(0).to_numpy(), batch.column(1)):
                    if matrix.shape[1] not in asked:
                        continue
                    places, own, rows = asked[matrix.shape[1]]
                    for at in range(0, len(held), size):
                        scores = inner_products(rows, matrix[at : at + size])
                        gathered.append(tile(places, own, held[at : at + size], np.where(own[:, None] != held[at : at + size], scores, NONE)))
                        if len(gathered) >= 16:
                            gathered = [merge(tuple(map(np.concatenate, zip(*gathered, strict=True))))]
            if gathered:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in merge(tuple(map(np.concatenate, zip(*gathered, strict=True))))], names)

        return candidates.mapInArrow(score, self.kinds)


def _extremes(places, own, held, scores) -> Columns:
    some = scores > NONE
    kept = some.any(axis=1)
    least = np.where(some, scores, np.iinfo(np.int64).max).min(axis=1)
    return places[kept], least[kept], scores.max(axis=1)[kept], some.sum(axis=1)[kept]


def _merged_extremes(columns: Columns) -> Columns:
    place, least, most, n = columns
    found, at = np.unique(place, return_inverse=True)
    low, high, count = np.full(len(found), np.iinfo(np.int64).max), np.full(len(found), NONE), np.zeros(len(found), np.int64)
    np.minimum.at(low, at, least)
    np.maximum.at(high, at, most)
    np.add.at(count, at, n)
    return found, low, high, count


def _merged_counts(columns: Columns) -> Columns:
    place, bin_no, n = columns
    cell, at = np.unique(place * BINS + bin_no, return_inverse=True)
    count = np.zeros(len(cell), np.int64)
    np.add.at(count, at, n)
    return cell // BINS, cell % BINS, count


def _best(columns: Columns, k: int) -> Columns:
    """The k best of each place, ties to the smaller id."""
    place, held, value = columns
    order = np.lexsort((held, -value.astype(np.float64), place)) if not len(value) or np.abs(value).max() < 2**53 else np.array(
        sorted(range(len(value)), key=lambda i: (place[i], -int(value[i]), held[i])), np.int64)
    place, held, value = place[order], held[order], value[order]
    first = np.arange(len(place)) - np.searchsorted(place, place, side="left") < k
    return place[first], held[first], value[first]


def _width(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Of a bin, so that BINS of them reach from low to high: (high - low) // BINS + 1
    without leaving 64 bits."""
    return ((high.astype(np.uint64) - low.astype(np.uint64)) // np.uint64(BINS)).astype(np.int64) + 1


def kth_scores(candidates: DataFrame, queries: pa.Table, k: int, size: int) -> np.ndarray:
    """Per query the score of rank k among all candidates (the lowest, if fewer; NONE
    without any), by rounds of global histograms."""
    n = queries.num_rows
    low, high, rest = np.full(n, NONE), np.full(n, NONE), np.zeros(n, np.int64)
    found = Pass(queries, ["place", "least", "most", "n"], "place long, least long, most long, n long", _extremes, _merged_extremes).over(candidates, size)
    for r in found.groupBy("place").agg(F.min("least").alias("low"), F.max("most").alias("high"), F.sum("n").alias("n")).collect():  # a row per query
        low[r["place"]], high[r["place"]], rest[r["place"]] = r["low"], r["high"], min(k, r["n"])
    while (low < high).any():
        bounds = low.copy(), high.copy(), _width(low, high)

        def histogram(places, own, held, scores, bounds=bounds) -> Columns:
            lowest, highest, width = (b[places] for b in bounds)
            inside = (scores >= lowest[:, None]) & (scores <= highest[:, None]) & (lowest < highest)[:, None]
            # the k-th highest of all is not below a tile's own: lower scores need no bin
            row, col = np.nonzero(best_mask(np.where(inside, scores, NONE), k))
            steps = (scores[row, col].astype(np.uint64) - lowest[row].astype(np.uint64)) // width[row].astype(np.uint64)
            return places[row], steps.astype(np.int64), np.ones(len(row), np.int64)

        counts = Pass(queries, ["place", "bin", "n"], "place long, bin long, n long", histogram, _merged_counts).over(candidates, size)
        counts = counts.groupBy("place", "bin").agg(F.sum("n").alias("n"))
        # per query the bin, from the highest down, in which ``rest`` scores are reached
        above = F.sum("n").over(Window.partitionBy("place").orderBy(F.col("bin").desc()))
        ranks = candidates.sparkSession.createDataFrame([(i, int(x)) for i, x in enumerate(rest)], "p long, rest long")
        reached = counts.withColumn("upto", above).join(F.broadcast(ranks), F.col("place") == F.col("p")).filter("upto >= rest AND upto - n < rest")
        for r in reached.collect():  # a row per query
            i, width = r["place"], int(bounds[2][r["place"]])
            low[i], high[i], rest[i] = int(low[i]) + r["bin"] * width, min(int(high[i]), int(low[i]) + (r["bin"] + 1) * width - 1), r["rest"] - (r["upto"] - r["n"])
    return low


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, query_block: int = QUERY_BLOCK,
          candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products of the
    floored vectors (all, if fewer), ties to the smaller vec_id.

    Both tables are (vec_id, vector array<float or double>).  A query never meets
    candidates of its own vec_id, and vectors of different lengths never meet.
    Vectors that are null or hold null or non-finite components and rows without
    vec_id take no part; an empty vector scores 0 with every other one.  Repeated
    queries are asked once; candidates that repeat a vec_id count as separate rows.
    Empty tables give an empty result.  Scores are exact; one that is no long is an
    error.  No vector is shuffled: the driver holds one block of queries, and their
    intervals, at a time."""

    def clean(table: DataFrame) -> DataFrame:
        vector = F.col("vector").cast("array<double>")
        return table.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")).filter(F.col("vec_id").isNotNull() & usable("vector"))

    held = materialise(clean(candidates), "candidates")
    asked = clean(queries).distinct().withColumn("hash", F.xxhash64("vec_id", "vector"))
    asked = materialise(asked, "queries")
    blocks = max(1, -(-asked.count() // query_block))
    found = []
    for n in range(blocks):
        block = asked.filter(F.pmod("hash", F.lit(blocks)) == n).orderBy("vec_id", "vector").select("vec_id", "vector").toArrow()
        least = kth_scores(held, block, k, candidate_block)

        def chosen(places, own, ids, scores, least=least) -> Columns:
            row, col = np.nonzero((scores > NONE) & (scores >= least[places][:, None]))
            return _best((places[row], ids[col], scores[row, col]), k)

        rows = Pass(block, ["place", "vec_id", "score"], "place long, vec_id long, score long", chosen, lambda c: _best(c, k)).over(held, candidate_block)
        order = Window.partitionBy("place").orderBy(F.col("score").desc(), "vec_id")
        ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        ids = held.sparkSession.createDataFrame(list(enumerate(block["vec_id"].to_pylist())), "p long, query_id long")
        ranked = ranked.join(F.broadcast(ids), F.col("place") == F.col("p"))  # a block of queries
        found.append(materialise(ranked.select("query_id", "rank", "vec_id", "score"), "top-k"))
    return reduce(DataFrame.union, found)


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return top_k(vectors.filter("vec_id % 50 = 0"), vectors)


OP7_SQL = """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = len(embedding)),
scored AS (
  SELECT a.vec_id AS query_id, a.q, b.vec_id, coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])), 0) AS score
  FROM (SELECT DISTINCT vec_id, q FROM v WHERE vec_id % 50 = 0) a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id, q ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM ranked WHERE place <= 5"""
