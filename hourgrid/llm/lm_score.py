"""Stupid-backoff language-model scores against the corpus itself.

Word n-grams are exploded per block of documents, partitioned by their hash and
counted over the whole corpus; the counts are joined back to the n-grams of each
block and summed per document.  A document is scored with the counts of all
other documents (its own are taken off), so an n-gram that only it has backs off.

The n-gram tables are kept column-wise: a row holds the sorted keys that one
block has in one hash partition, so an n-gram costs its key and count, not a row.
Rows are blocks times partitions until each holds one key, one row per n-gram of a
block at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, read_table
from .tokens import mixed, slices, word_hashes

ALPHA = 0.4  # factor of a backoff step
ORDER = 2  # longest n-gram
BLOCK_WORDS = 1_000_000  # words of a block of documents, about
BUCKET_KEYS = 2_000_000  # n-gram entries of a hash partition, about

_STEP = np.uint64(0x9E3779B97F4A7C15)


def gram_keys(words: np.ndarray, n_words: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n = 1, 2, ... order: the places where the n-grams inside one document end,
    and their keys."""
    owner = np.repeat(np.arange(len(n_words)), n_words)
    keys = words
    yield np.arange(len(words)), keys
    for n in range(2, order + 1):
        keys = mixed(keys[:-1] * _STEP + mixed(words[n - 1 :] + _STEP)) if len(keys) else keys
        inside = owner[: max(0, len(words) - n + 1)] == owner[n - 1 :]
        yield np.flatnonzero(inside) + n - 1, keys[inside]


def _pack_words(words: np.ndarray) -> bytes:
    """Word hashes as a vocabulary and the places in it, compressed."""
    vocabulary, place = np.unique(words, return_inverse=True)
    head = np.array([len(vocabulary)], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + vocabulary.tobytes() + place.astype("<u4").tobytes())


def _unpack_words(payload: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    return np.frombuffer(raw, "<u8", n, 8)[np.frombuffer(raw, "<u4", -1, 8 + 8 * n)]


def word_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(block, doc_ids, n_words, words): runs of whole documents with about
    BLOCK_WORDS words each (one document at least)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        base, made = (task.partitionId() if task else 0) << 32, 0
        ids: list = []
        counts: list[int] = []
        parts: list[np.ndarray] = []

        def row() -> pa.RecordBatch:
            words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            return pa.RecordBatch.from_arrays(
                [pa.array([base + made]), pa.array([ids], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())),
                 pa.array([_pack_words(words)], pa.binary())], ["block", "doc_ids", "n_words", "words"])

        for batch in batches:
            names, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for cut in slices(texts):
                words, owner = word_hashes(texts[cut])
                ids += names[cut]
                counts += np.bincount(owner, minlength=cut.stop - cut.start).tolist()
                parts.append(words)
                if sum(map(len, parts)) >= BLOCK_WORDS:
                    yield row()
                    made += 1
                    ids, counts, parts = [], [], []
        if ids:
            yield row()

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(build, "block long, doc_ids array<long>, n_words array<long>, words binary")


def _bucket_bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each hash partition begins in sorted keys."""
    edges = [(i << 64) // buckets for i in range(1, buckets)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(edges, dtype=np.uint64)), [len(keys)]]).astype(np.int64)


def gram_counts(blocks: DataFrame, buckets: int, order: int) -> DataFrame:
    """(block, grams, bucket, totals): corpus counts of every block's n-grams, in the
    order of the block's sorted keys in that hash partition."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, n_words, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = _unpack_words(payload)
                for grams, (_, keys) in enumerate(gram_keys(words, np.array(n_words, np.int64), order), 1):
                    unique, counts = np.unique(keys, return_counts=True)
                    bounds = _bucket_bounds(unique, buckets)
                    spans = [(i, a, b) for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if a < b]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block] * len(spans), pa.int64()), pa.array([grams] * len(spans), pa.int32()), pa.array([i for i, _, _ in spans], pa.int32()),
                         pa.array([unique[a:b].tobytes() for _, a, b in spans], pa.binary()),
                         pa.array([counts[a:b].astype("<u4").tobytes() for _, a, b in spans], pa.binary())],
                        ["block", "grams", "bucket", "keys", "counts"])

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        sizes = [len(k) // 8 for k in frame["keys"]]
        keys = np.frombuffer(b"".join(frame["keys"]), "<u8")
        _, place = np.unique(keys, return_inverse=True)
        totals = np.bincount(place, weights=np.frombuffer(b"".join(frame["counts"]), "<u4"))[place].astype("<i8")
        ends = np.cumsum(sizes)
        packed = [zstandard.ZstdCompressor(level=1).compress(totals[e - n : e].tobytes()) for e, n in zip(ends, sizes, strict=True)]
        return frame[["block", "grams", "bucket"]].assign(totals=packed)

    exploded = blocks.select("block", "n_words", "words").mapInArrow(explode, "block long, grams int, bucket int, keys binary, counts binary")
    return exploded.groupBy("grams", "bucket").applyInPandas(count, "block long, grams int, bucket int, totals binary")


def block_scores(words: np.ndarray, n_words: np.ndarray, totals: dict[int, np.ndarray], n_corpus: int, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """Per document the sum of its words' log scores and its number of backoff steps.

    ``totals`` has, by n-gram length, the corpus counts of the block's sorted
    unique keys."""
    n_docs, order = len(n_words), max(totals)
    owner = np.repeat(np.arange(n_docs), n_words)
    rest = (n_corpus - n_words)[owner].astype(float)  # words in other documents
    log = lambda x: np.log(np.maximum(x, 1e-300))
    value, level = np.zeros(len(words)), np.ones(len(words), np.int64)
    context = np.zeros(0)
    for n, (end, keys) in enumerate(gram_keys(words, n_words, order), 1):
        unique, place = np.unique(keys, return_inverse=True)
        _, at, own = np.unique(owner[end] * max(1, len(unique)) + place, return_inverse=True, return_counts=True)
        others = totals[n][place] - own[at]  # corpus count without the own document's
        if n == 1:
            # a word that no other document has counts like half an occurrence
            value = log(np.where(others > 0, others, 0.5)) - log(np.maximum(rest, 1))
        else:
            seen = others > 0
            value[end[seen]] = log(others[seen]) - log(context[end[seen] - 1])
            level[end[seen]] = n
        context = np.zeros(len(words))
        context[end] = others
    starts = np.cumsum(n_words) - n_words
    longest = np.minimum(order, np.arange(len(words)) - np.repeat(starts, n_words) + 1)  # that ends at each word
    value += (longest - level) * np.log(alpha)
    return np.bincount(owner, weights=value, minlength=n_docs).astype(float), np.bincount(owner, weights=longest - level, minlength=n_docs).astype(np.int64)


def score_documents(docs: DataFrame, alpha: float = ALPHA, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """(doc_id, n_words, n_backoff, log_score, mean_log_score) per row of ``docs``.

    A word is scored by the longest n-gram up to ``order`` that ends there and that
    some other document has, times ``alpha`` for each step from the longest one that
    the text allows (``n_backoff`` counts the steps); a word of no other document
    counts half an occurrence.  Every row is a document
    of its own, so repeated rows are evidence for each other.  Null and empty
    texts have no words and score 0; an empty table gives an empty result.  A word
    is a run of ASCII letters and digits and of non-ASCII characters, lower-cased."""
    blocks = materialise(word_blocks(docs, id_col, text_col), "blocks")
    size = F.aggregate("n_words", F.lit(0).cast("long"), lambda a, n: a + n)
    n_corpus = blocks.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, -(-n_corpus // BUCKET_KEYS))
    counts = materialise(gram_counts(blocks, buckets, order), "gram-counts")
    gathered = counts.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("grams", "bucket", "totals"))).alias("counts"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, sizes, payload, rows = (batch.column(c)[i].as_py() for c in range(4))
                n_words = np.array(sizes, np.int64)
                unpacked = {n: [np.zeros(0, np.int64)] for n in range(1, order + 1)}
                for x in rows or ():
                    unpacked[x["grams"]].append(np.frombuffer(zstandard.ZstdDecompressor().decompress(x["totals"]), "<i8"))
                totals = {g: np.concatenate(parts) for g, parts in unpacked.items()}
                sums, backoffs = block_scores(_unpack_words(payload), n_words, totals, n_corpus, alpha)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(n_words, pa.int64()), pa.array(backoffs, pa.int64()), pa.array(sums, pa.float64()), pa.array(sums / np.maximum(1, n_words), pa.float64())],
                    ["doc_id", "n_words", "n_backoff", "log_score", "mean_log_score"])

    joined = blocks.join(gathered, "block", "left").select("doc_ids", "n_words", "words", "counts")
    return joined.mapInArrow(score, "doc_id long, n_words long, n_backoff long, log_score double, mean_log_score double")


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"))
