import zlib

from hourgrid.llm.quality import classify_quality, isotonic
from hourgrid.llm.registry import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op9_quality"](spark, SF).collect()}
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect()]
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows.values():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(i, q) for i, q in labels if rows[i]["held_out"]]
    assert sum(rows[i]["predicted"] == q for i, q in held) >= 0.95 * len(held) > 0


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.selectExpr("doc_id", "IF(crc32(CAST(doc_id AS STRING)) % 5 = 0, 1 - quality, quality) AS quality", "toxic")
    a, b = ({r["doc_id"]: round(r["score"], 6) for r in classify_quality(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (6, 1, 0), (6, 0, 0), (7, 1, 0), (9, None, 1), (None, 0, 0), (77, 0, 0)], "doc_id long, quality int, toxic int")
    rows = classify_quality(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in classify_quality(edge_docs, labels.where("false")).collect()} == {0.5}
    assert classify_quality(no_docs, labels).collect() == []


def test_isotonic():
    assert isotonic([1, 3, 2, 4], [1, 1, 1, 1]) == [1, 2.5, 2.5, 4]
    assert isotonic([3, 2, 1], [1, 1, 2]) == [1.75] * 3 and isotonic([], []) == []


def test_scores_equal_one_process_linear_algebra(spark):
    """The whole model by numpy alone: all rows in one matrix, ridge as an augmented
    least-squares problem, isotonic levels by the max-min formula."""
    import numpy as np
    import zstandard

    from hourgrid.llm import quality as Q

    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    marks = {r["doc_id"]: float(r["quality"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r["quality"] is not None}
    packer = zstandard.ZstdCompressor(level=1)
    stats = np.array([Q.statistics_of(t, packer) for _, t in docs], float)
    learn = np.array([i in marks and zlib.crc32(str(i).encode()) % 5 != 0 for i, _ in docs])
    y = np.array([marks.get(i, 0.0) for i, _ in docs])[learn]
    z = np.clip((stats - stats[learn].mean(axis=0)) / np.maximum(stats[learn].std(axis=0), 1e-6), -8, 8)
    rng = np.random.default_rng(7)
    directions = rng.standard_normal((z.shape[1], Q.RANDOM_FEATURES)) * np.sqrt(2 / z.shape[1])
    phases = rng.uniform(0, 2 * np.pi, Q.RANDOM_FEATURES)
    x = np.hstack([np.sqrt(2 / Q.RANDOM_FEATURES) * np.cos(z @ directions + phases), np.ones((len(z), 1))])
    ridge = np.sqrt(Q.RIDGE) * np.eye(x.shape[1])
    weights = np.linalg.lstsq(np.vstack([x[learn], ridge]), np.concatenate([y, np.zeros(x.shape[1])]), rcond=None)[0]
    raw = x @ weights
    at = np.clip(np.floor(raw[learn] * Q.BINS), -Q.BINS, 2 * Q.BINS)
    bins, place, n = np.unique(at, return_inverse=True, return_counts=True)
    total = np.bincount(place, weights=y)
    mean = lambda a, b: total[a : b + 1].sum() / n[a : b + 1].sum()
    levels = [max(min(mean(a, b) for b in range(i, len(bins))) for a in range(i + 1)) for i in range(len(bins))]
    want = np.clip(np.interp(raw, (bins + 0.5) / Q.BINS, levels), 0, 1)
    got = {r["doc_id"]: r for r in QUERIES["op9_quality"](spark, sf).collect()}
    assert len(got) == len(docs)
    for (i, _), score in zip(docs, want.tolist(), strict=True):
        assert abs(got[i]["score"] - score) < 1e-6 and got[i]["predicted"] == int(got[i]["score"] >= 0.3)
