import hashlib
import math
import random

import numpy as np
import pytest

from hourgrid.llm.clusters import Tile, cluster_vectors, encode_tiles, integer_vectors
from hourgrid.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, tile string, cluster string, codes string"


def brute(rows, clusters, rounds, dims):
    """(vec_id, cluster, distance, cluster_inertia, inertia, sha) by plain loops over Python integers."""
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "~", v) for i, v in kept)
    centroids = [v for _, v in named[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, own in groups.items():
            centroids[n] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    total = sum(d for _, _, d in found)
    own = {c: sum(d for _, k, d in found if k == c) for _, c, _ in found}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted([(i, c, d, own[c], total, sha[c]) for i, c, d in found], key=str)


def shown(df):
    return sorted([tuple(r)[:6] for r in df.collect()], key=str)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = QUERIES["op12_clusters"](spark, SMALL)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert shown(got) == brute(rows, 40, 5, 64)


@pytest.mark.parametrize(("width", "tile", "dims"), [(1, 7, 6), (2, 1000, 6), (4, 3, 6), (9, 50, 5)])
def test_any_blocks_and_tiles_give_the_same_clusters(spark, width, tile, dims):
    """Null, short, long and non-finite vectors, ties, copies, repeated and null ids."""
    rnd = random.Random(dims)
    rows = [(i, [rnd.choice([-1.5, -0.25, 0.0, 0.125, 1.0, rnd.random()]) for _ in range(dims)]) for i in range(150)]
    rows += [(200 + i, [0.5] * dims) for i in range(60)] + [(5, rows[5][1]), (5, rows[6][1]), (None, rows[3][1]), (None, [9.0] * dims)]
    bad = [(300, None), (301, []), (302, [0.5] * (dims + 1)), (303, [None] + [0.5] * (dims - 1)), (304, [float("nan")] + [0.5] * (dims - 1)),
           (305, [float("inf")] + [0.5] * (dims - 1)), (306, [float("-inf")] + [0.5] * (dims - 1)), (307, [0.5])]
    df = spark.createDataFrame([(i, v, 1, "x", "y", "z") for i, v in rows + bad], SCHEMA).repartition(5)
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows + bad]
    got = cluster_vectors(df, clusters=8, rounds=3, dims=dims, width=width, tile=tile)
    assert shown(got) == brute(exact, 8, 3, dims)


def test_few_and_no_vectors(spark):
    two = spark.createDataFrame([(1, [0.5, 0.25]), (2, [-0.5, 2.0])], "vec_id long, embedding array<double>")
    rows = cluster_vectors(two, dims=2).collect()
    assert sorted((r["vec_id"], r["distance"]) for r in rows) == [(1, 0), (2, 0)] and {r["cluster"] for r in rows} == {0, 1}
    assert sorted(r["centroid"] for r in rows) == [[-128, 512], [128, 64]]
    assert cluster_vectors(two, dims=3).collect() == [] and cluster_vectors(two.where("false"), dims=2).collect() == []


def test_components_beyond_exact_sums_are_an_error(spark):
    large = spark.createDataFrame([(1, [1e6, 0.0]), (2, [0.0, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        cluster_vectors(large, dims=2).collect()


def test_tiles_keep_each_distinct_subvector_once(spark):
    rows = [(i, [float(i % 3), float(i % 2), 0.0, 1.0]) for i in range(500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    tiles = encode_tiles(integer_vectors(df, 4), 4, 2, 200).collect()
    assert [len(t["vec_ids"]) for t in tiles] == [200, 200, 100] and all(t["n_distinct"] == [6, 1] for t in tiles)
    back = {}
    for t in tiles:
        first, second = t["codes"][: len(t["vec_ids"])], t["codes"][len(t["vec_ids"]):]
        for i, a, b in zip(t["vec_ids"], first, second, strict=True):
            back[i] = t["subvectors"][2 * a : 2 * a + 2] + t["subvectors"][12 + 2 * b : 14 + 2 * b]
    assert back == {i: [int(256 * x) for x in v] for i, v in rows}


def test_tile_distances_and_sums_are_exact():
    rng = np.random.default_rng(5)
    import pyarrow as pa

    vectors = rng.integers(-(2**27) + 1, 2**27, (50, 7))
    centroids = rng.integers(-(2**27) + 1, 2**27, (4, 7))
    tile = Tile.encode(pa.array(range(50)), vectors, 3)
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids] for v in vectors]
    assert tile.distances(centroids).tolist() == want
    cluster = rng.integers(0, 4, 50)
    assert tile.sums(cluster, 4).tolist() == [vectors[cluster == c].sum(axis=0).tolist() for c in range(4)]
