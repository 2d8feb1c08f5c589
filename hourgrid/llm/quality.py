"""Quality classifier on document statistics.

Random Fourier features approximate a Gaussian kernel over the statistics of a
text; each partition sums its share of the normal equations, Spark adds the
shares up, and the solved ridge scores are calibrated by isotonic regression.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, read_table

RANDOM_FEATURES = 256
RIDGE = 1.0
BINS = 1000  # score bins of the calibration
THRESHOLD = 0.3

_CLASSES = {"lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789",
            "space": b" \t\r\x0b\x0c", "line": b"\n", "stop": b".", "comma": b",;:", "shout": b"!?", "bar": b"|/\\",
            "symbol": b"#$%&*@^~=+<>_", "quote": b"\"'`()[]{}-"}
STATISTICS = [*_CLASSES, "high", "length", "words", "word_length", "distinct_words", "repeated_words",
              "distinct_lines", "short_lines", "capitals", "compression", "longest_word"]
_CLASS_OF = np.full(256, len(_CLASSES), np.uint8)
for _n, _chars in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_chars)] = _n
_CAPITALS = re.compile(r"(?:^|\s)[A-ZÀ-ÖØ-Þ]{2,}")


def statistics_of(text: str | None, packer: zstandard.ZstdCompressor) -> list[float]:
    """The statistics of one whole text; null counts as empty, and an empty text
    has zeros throughout."""
    raw = (text or "").encode("utf-8", "replace")
    if not raw:
        return [0.0] * len(STATISTICS)
    kinds = np.bincount(_CLASS_OF[np.frombuffer(raw, np.uint8)], minlength=len(_CLASSES) + 1)
    share = np.log1p(1000.0 * kinds / len(raw))  # small shares must count
    words, lines = raw.split(), raw.split(b"\n")
    n = max(1, len(words))
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    return [
        *share.tolist(), np.log(len(raw)), np.log1p(len(words)), (len(raw) - int(kinds[3]) - int(kinds[4])) / n,
        len(set(words)) / n, np.log1p(1000.0 * repeats / n), len(set(lines)) / len(lines),
        sum(len(x) < 20 for x in lines) / len(lines), np.log1p(1000.0 * len(_CAPITALS.findall(text)) / n),
        len(packer.compress(raw)) / len(raw), np.log1p(max(map(len, words), default=0)),
    ]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, stats array<double>) per row of ``docs``."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            stats = [statistics_of(t.as_py(), packer) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(stats, pa.list_(pa.float64()))], ["doc_id", "stats"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(measure, "doc_id long, stats array<double>")


@dataclass
class QualityModel:
    """Everything a score needs, of a size fixed by the parameters."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray  # raw scores and their calibrated values, ascending
    levels: np.ndarray

    def expand(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases)
        return np.hstack([waves, np.ones((len(stats), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.expand(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.levels), 0, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, len(STATISTICS))


def isotonic(values: list[float], weights: list[float]) -> list[float]:
    """Pool-adjacent-violators: the closest non-decreasing sequence."""
    blocks: list[list[float]] = []
    for value, weight in zip(values, weights, strict=True):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, n = blocks.pop()
            u, x, m = blocks.pop()
            blocks.append([(u * x + v * w) / (x + w), x + w, m + n])
    return [v for v, _, n in blocks for _ in range(int(n))]


def fit_quality(labelled: DataFrame, random_features: int = RANDOM_FEATURES, ridge: float = RIDGE, seed: int = 7) -> QualityModel:
    """Fits a model to a stored table (stats, label).

    Only fixed-size results reach the driver: two moments per statistic, the
    (features + 1)^2 normal equations and at most BINS calibration bins.  Without
    labelled rows every score is 0.5."""
    d = len(STATISTICS)
    moments = labelled.select(*[F.element_at("stats", i + 1).alias(f"s{i}") for i in range(d)]).agg(
        *[f(f"s{i}") for f in (F.avg, F.stddev_pop) for i in range(d)]).first()
    found = np.array([x if x is not None else 0.0 for x in moments], dtype=np.float64)
    rng = np.random.default_rng(seed)
    directions = rng.standard_normal((d, random_features)) * np.sqrt(2 / d)
    model = QualityModel(found[:d], np.maximum(found[d:], 1e-6), directions, rng.uniform(0, 2 * np.pi, random_features),
                         np.zeros(random_features + 1), np.array([0.0]), np.array([0.5]))
    size = random_features + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((size, size + 1))
        for batch in batches:
            if batch.num_rows:
                x = model.expand(_matrix(batch.column(0)))
                gram += x.T @ np.column_stack([x, np.asarray(batch.column(1), dtype=np.float64)])
        cell = np.flatnonzero(gram)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(gram.ravel()[cell])], ["cell", "value"])

    sums = labelled.select("stats", "label").mapInArrow(equations, "cell long, value double").groupBy("cell").agg(
        F.sum("value").alias("value")).toPandas()
    gram = np.zeros(size * (size + 1))
    gram[sums["cell"].to_numpy("int64")] = sums["value"].to_numpy()
    gram = gram.reshape(size, size + 1)
    if not gram.any():
        return model
    model.weights = np.linalg.solve(gram[:, :size] + ridge * np.eye(size), gram[:, size])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = np.clip(np.floor(model.raw(_matrix(batch.column(0))) * BINS), -BINS, 2 * BINS)
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), batch.column(1)], ["bin", "label"])

    bins = sorted(labelled.select("stats", F.col("label").cast("double").alias("label")).mapInArrow(binned, "bin long, label double")
                  .groupBy("bin").agg(F.count("*"), F.avg("label")).collect())
    model.knots = np.array([(b + 0.5) / BINS for b, _, _ in bins])
    model.levels = np.array(isotonic([v for _, _, v in bins], [float(n) for _, n, _ in bins]))
    return model


def score_quality(stats: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score) for a table (doc_id, stats)."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = model.score(_matrix(batch.column(1))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["doc_id", "score"])

    return stats.select("doc_id", "stats").mapInArrow(scored, "doc_id long, score double")


def held_out(id_col: str = "doc_id", modulus: int = 5, fold: int = 0) -> Column:
    """True for rows outside the learning folds; a null id hashes as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % modulus == fold


def classify_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``.

    Learns ``labels.quality`` of the documents outside the held-out fold; a
    document with several labels counts with their mean, labels that are null or
    name no document count nothing.  Null and empty texts get a score like any
    other; repeated rows get equal scores; an empty table gives an empty result,
    and without labels every score is 0.5."""
    stats = materialise(document_statistics(docs, id_col, text_col), "statistics")
    marks = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("label"))
    learn = stats.filter(~held_out()).join(marks.filter(~held_out()), "doc_id").select("stats", "label")
    model = fit_quality(materialise(learn, "labelled"))
    return score_quality(stats, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
