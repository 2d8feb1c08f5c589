"""Centroid clustering over subvector dictionaries.

Vectors of integers are stored in tiles.  A tile cuts its dimensions into blocks
and keeps, without loss, each block's distinct subvectors once and one code per
vector.  A round computes the exact distances of the distinct subvectors to all
centroids, adds them up per vector by code, and counts codes per cluster to get
the exact sums of the new centroids.  Vectors are encoded once and never shuffled;
a round moves one row per task and cluster.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, read_table

DIMS = 64
BLOCK_DIMS = 2  # dimensions of a subvector
TILE = 1 << 15  # vectors of a tile, at most
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
LARGEST = 1 << 27  # of a component: distances then fit 64 bits up to 127 dimensions


@dataclass
class Tile:
    """``subvectors[b]`` holds block b's distinct subvectors (m, width), ``codes[b]``
    every vector's row there."""

    vec_ids: pa.Array
    subvectors: list[np.ndarray]
    codes: list[np.ndarray]

    @classmethod
    def encode(cls, vec_ids: pa.Array, vectors: np.ndarray, width: int) -> Tile:
        subvectors, codes = [], []
        for at in range(0, vectors.shape[1], width):
            distinct, code = np.unique(vectors[:, at : at + width], axis=0, return_inverse=True)
            subvectors.append(distinct)
            codes.append(code.reshape(-1))
        return cls(vec_ids, subvectors, codes)

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        """(vectors, centroids) exact squared distances: each distinct subvector
        meets each centroid once."""
        total = np.zeros((len(self.vec_ids), len(centroids)), np.int64)
        at = 0
        for distinct, code in zip(self.subvectors, self.codes, strict=True):
            part = np.zeros((len(distinct), len(centroids)), np.int64)
            for column in range(distinct.shape[1]):
                part += (distinct[:, column, None] - centroids[None, :, at + column]) ** 2
            total += part[code]
            at += distinct.shape[1]
        return total

    def sums(self, cluster: np.ndarray, clusters: int) -> np.ndarray:
        """(clusters, dims) exact sums of the vectors of each cluster."""
        found = []
        for distinct, code in zip(self.subvectors, self.codes, strict=True):
            times = np.bincount(cluster * len(distinct) + code, minlength=clusters * len(distinct))
            found.append(times.reshape(clusters, len(distinct)) @ distinct)
        return np.concatenate(found, axis=1)


_TILE_SCHEMA = "vec_ids array<long>, n_distinct array<int>, subvectors array<int>, codes array<int>"


def _to_row(tile: Tile) -> list[pa.Array]:
    def one(values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values.astype(np.int32)))

    ids = pa.ListArray.from_arrays(pa.array([0, len(tile.vec_ids)], pa.int32()), tile.vec_ids)
    counts = np.array([len(x) for x in tile.subvectors])
    return [ids, one(counts), one(np.concatenate([x.ravel() for x in tile.subvectors])), one(np.concatenate(tile.codes))]


def _from_rows(batch: pa.RecordBatch, dims: int, width: int) -> Iterator[Tile]:
    for i in range(batch.num_rows):
        ids, *parts = (batch.column(c)[i].values for c in range(4))
        counts, flat, codes = (p.to_numpy() for p in parts)
        widths = [min(width, dims - at) for at in range(0, dims, width)]
        ends = np.cumsum(counts * np.array(widths))
        subvectors = [x.reshape(-1, w).astype(np.int64) for x, w in zip(np.split(flat, ends[:-1]), widths, strict=True)]
        yield Tile(ids, subvectors, list(codes.reshape(len(widths), len(ids))))


def _kept(vectors: Column, dims: int) -> Column:
    finite = F.forall(vectors, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vectors) == dims) & finite, F.lit(False))


def integer_vectors(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, vector array<long>): floor(scale * x) of the vectors with exactly
    ``dims`` components, none of them null or non-finite."""
    exact = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    whole = F.transform("vector", lambda x: F.floor(x * F.lit(float(scale))))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), exact.alias("vector"))
    return rows.filter(_kept(F.col("vector"), dims)).select("vec_id", whole.alias("vector"))


def encode_tiles(vectors: DataFrame, dims: int = DIMS, width: int = BLOCK_DIMS, tile: int = TILE) -> DataFrame:
    """Tiles of the integer vectors of a table (vec_id, vector)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split(" ")[0] for x in _TILE_SCHEMA.split(", ")]
        waiting: list[tuple[pa.Array, np.ndarray]] = []

        def tiles(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal waiting
            while waiting and (n := sum(len(x) for x, _ in waiting)) >= least:
                ids, values = pa.concat_arrays([x for x, _ in waiting]), np.concatenate([v for _, v in waiting])
                yield pa.RecordBatch.from_arrays(_to_row(Tile.encode(pa.concat_arrays([ids[:tile]]), values[:tile], width)), names)
                waiting = [(ids[tile:], values[tile:])] if n > tile else []

        for batch in batches:
            values = batch.column(1).flatten().to_numpy().reshape(-1, dims)
            if len(values):
                if values.max() >= LARGEST or values.min() <= -LARGEST:
                    raise ArithmeticError(f"a component of {LARGEST} or beyond: distances would not fit 64 bits")
                waiting.append((batch.column(0), values))
                yield from tiles(tile)
        yield from tiles(1)

    return vectors.mapInArrow(encode, _TILE_SCHEMA)


def first_centroids(vectors: DataFrame, clusters: int, seed: str) -> list[list[int]]:
    """The vectors with the smallest sha256 of ``<seed>:<vec_id>``, by that hash;
    vectors of one id by their components, those without an id last."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [list(r["vector"]) for r in vectors.orderBy(order.asc_nulls_last(), "vector").limit(clusters).collect()]


def _next_centroids(tiles: DataFrame, centroids: np.ndarray, width: int) -> np.ndarray:
    clusters, dims = centroids.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(clusters, np.int64), np.zeros((clusters, dims), np.int64)
        for batch in batches:
            for tile in _from_rows(batch, dims, width):
                nearest = tile.distances(centroids).argmin(axis=1)  # the first of equals
                count += np.bincount(nearest, minlength=clusters)
                sums += tile.sums(nearest, clusters)
        held = np.flatnonzero(count)
        offsets = pa.array(np.arange(len(held) + 1) * dims, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(count[held]), pa.ListArray.from_arrays(offsets, pa.array(sums[held].ravel()))], ["cluster", "n", "sums"])

    parts = tiles.mapInArrow(assign, "cluster int, n long, sums array<long>")
    # decimals, so that no sum of many tasks overflows
    whole = lambda c: F.sum(F.col(c).cast("decimal(19,0)")).alias(c)
    totals = parts.select("cluster", "n", F.posexplode("sums").alias("dim", "total")).groupBy("cluster", "dim").agg(whole("n"), whole("total"))
    moved = centroids.copy()
    for r in totals.collect():  # clusters x dims rows, whatever the number of vectors
        moved[r["cluster"], r["dim"]] = int(r["total"]) // int(r["n"])
    return moved


def cluster_vectors(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = "2", dims: int = DIMS, scale: int = SCALE,
                    width: int = BLOCK_DIMS, tile: int = TILE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256,
    centroid array<long>), one row per vector that takes part.

    Vectors that are null, of another length, or hold null or non-finite components
    take no part; extra columns are not read.  Repeated rows count once each; equal
    vectors share a cluster; of equally near centroids the smallest number wins; a
    null vec_id takes part but starts a centroid only after all others.  Fewer
    vectors than clusters give that many clusters, an empty table no rows.  Results
    are exact; a component whose distances may not fit 64 bits (2**27 after
    scaling), or a sum of distances that does not, is an error, never a wrong
    number.  The driver holds the centroids only."""
    spark = vectors.sparkSession
    whole = integer_vectors(vectors, dims, scale, id_col, vector_col)
    centroids = np.array(first_centroids(whole, clusters, seed), np.int64).reshape(-1, dims)
    if len(centroids) and np.abs(centroids).max() >= LARGEST:
        raise ArithmeticError(f"a component of {LARGEST} or beyond: distances would not fit 64 bits")
    tiles = materialise(encode_tiles(whole, dims, width, tile), "tiles")
    for _ in range(rounds if len(centroids) else 0):
        centroids = _next_centroids(tiles, centroids, width)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in _from_rows(batch, dims, width):
                distances = t.distances(centroids)
                nearest = distances.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [t.vec_ids, pa.array(nearest, pa.int32()), pa.array(distances[np.arange(len(nearest)), nearest])], ["vec_id", "cluster", "distance"])

    assigned = materialise(tiles.mapInArrow(assign, "vec_id long, cluster int, distance long"), "assigned")
    inertia = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(19,0)")).alias("s")).collect()  # a row per cluster
    total = sum(int(r["s"]) for r in inertia)
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(r["cluster"], int(r["s"]), total, shas[r["cluster"]], centroids[r["cluster"]].tolist()) for r in inertia]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<long>"
    facts = F.broadcast(spark.createDataFrame(rows, schema))  # at most ``clusters`` rows
    return assigned.join(facts, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid")


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(read_table(spark, sf_dir, "embeddings")).drop("centroid")


def op12_sql(dims: int = DIMS, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """The query in DuckDB's SQL, a pair of tables per round."""
    steps = [f"""v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = {dims})""",
             "k AS MATERIALIZED (SELECT vec_id, generate_subscripts(q, 1) AS d, unnest(q) AS x FROM v)",
             f"""c0 AS MATERIALIZED (
  SELECT c, generate_subscripts(q, 1) AS d, unnest(q) AS x FROM (
    SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), q) - 1 AS c, q FROM v ORDER BY 1 LIMIT {clusters}))"""]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
  SELECT vec_id, min_by(c, s * {clusters} + c) AS c, min(s) AS s FROM (
    SELECT vec_id, c, sum((k.x - o.x) * (k.x - o.x)) AS s FROM k JOIN c{n} o USING (d) GROUP BY vec_id, c) GROUP BY vec_id)""")
        if n < rounds:
            steps.append(f"""c{n + 1} AS MATERIALIZED (
  SELECT o.c, o.d, coalesce(m.x, o.x) AS x FROM c{n} o LEFT JOIN (
    SELECT c, d, CAST((t - ((t % m) + m) % m) // m AS BIGINT) AS x FROM (
      SELECT c, d, sum(x) AS t, count(*) AS m FROM a{n} JOIN k USING (vec_id) GROUP BY c, d)) m USING (c, d))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(s AS BIGINT) AS distance, CAST(sum(s) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(s) OVER () AS BIGINT) AS inertia, sha AS centroid_sha256
FROM a{rounds} JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS sha FROM c{rounds} GROUP BY c) USING (c)"""
