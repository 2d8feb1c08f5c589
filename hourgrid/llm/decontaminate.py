"""Benchmark decontamination by spaced-seed hashing.

Masks over a window of words ignore some positions, so a benchmark passage with
substituted words still shares a masked hash with its original: for every choice
of words that a verified overlap may substitute, some mask ignores them all.
The masked hashes of all benchmark windows are one table, those of the documents'
windows another; they are joined by hash, and the words of the windows that meet
are compared.  Documents keep only hashes that pass a filter of bounded size, made
of all benchmark hashes, so few of their rows are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.joins import join_dimension
from .common import materialise, read_table
from .tokens import mixed, slices, word_hashes

SPAN = 12  # least words that the masks of longer items span
WINDOW = 16  # words of a verified overlap; shorter items: the whole item
SHARE = 0.8  # of the window's words that must agree
FILTER_BITS = 26  # the hash filter has at most 2**26 bits (8 MB)
BITS_A_HASH = 64  # of the filter, as long as it is below that size
_CHUNK = 1 << 15  # bits that Spark's bitmap aggregate holds

_FACTORS = mixed(np.arange(1, WINDOW + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
#: Scripts that are written without spaces: each of their characters is a word.
_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")


def text_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, owner) of the words of all texts, as ``word_hashes``; characters of
    scripts without spaces are words of their own."""
    return word_hashes([t if t.isascii() else _UNSPACED.sub(r" \1 ", t) for t in texts])


def allowed(size: int) -> int:
    """Words of a verified overlap of ``size`` words that may be substituted."""
    return max(k for k in range(size + 1) if size - k >= SHARE * size)


def seed_span(words: int) -> int:
    """Words that the masks of an item of so many words span: an item allows no
    more substitutions than its span does, so its first span is covered."""
    size = min(words, WINDOW)
    return next(s for s in range(SPAN if size >= SPAN else size, size + 1) if allowed(s) == allowed(size))


@lru_cache(maxsize=64)
def masks(span: int) -> tuple[tuple[int, ...], ...]:
    """Masks over ``span`` words, as the groups of places that each compares.  With k
    substitutions allowed, place i is in group i % (k + 2) and each choice of k
    groups is ignored by one mask: any k substitutions lie in k groups at most."""
    groups = range(allowed(span) + 2)
    return tuple(tuple(g for g in groups if g not in ignored) for ignored in combinations(groups, allowed(span)))


def _seeds(span: int) -> np.ndarray:
    """A number of its own for each mask of a span."""
    return mixed(np.arange(len(masks(span)), dtype=np.uint64) + np.uint64(100 * span))


def masked_hashes(words: np.ndarray, span: int) -> Iterator[np.ndarray]:
    """For each mask one hash per window of ``span`` words: sums over its groups."""
    n, step = max(0, len(words) - span + 1), allowed(span) + 2
    sums = []
    for group in range(step):
        total = np.zeros(n, np.uint64)
        for i in range(group, span, step):
            total += words[i : i + n] * _FACTORS[i]
        sums.append(total)
    for compared, seed in zip(masks(span), _seeds(span), strict=True):
        yield reduce(np.add, [sums[g] for g in compared], seed)


def _windows(words: np.ndarray, ends: np.ndarray, place: np.ndarray) -> pa.ListArray:
    """The words from each place on, WINDOW at most and none from ``ends`` on."""
    counts = np.minimum(WINDOW, ends - place)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1], counts) + np.repeat(place, counts)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(words[at].view(np.int64)))


def benchmark_seeds(benchmark: DataFrame) -> DataFrame:
    """(hash, span, item_id, size, item_window): the masked hashes of every window of
    every item.  Null texts and null ids name no item, and a text without words has
    no window."""

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words, _ = text_words([text])
                if not len(words):
                    continue
                size, span = min(WINDOW, len(words)), seed_span(len(words))
                n = len(words) - size + 1
                window = _windows(words, np.full(n, len(words)), np.arange(n))
                for hashes in masked_hashes(words, span):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashes[:n].view(np.int64)), pa.array(np.full(n, span), pa.int32()),
                         pa.array(np.full(n, item_id), pa.int64()), pa.array(np.full(n, size), pa.int32()), window],
                        ["hash", "span", "item_id", "size", "item_window"])

    items = benchmark.filter("text IS NOT NULL AND item_id IS NOT NULL").select(F.col("item_id").cast("long"), "text").distinct()
    return items.mapInArrow(seeds, "hash long, span int, item_id long, size int, item_window array<long>")


def probes(bits: int) -> tuple[int, ...]:
    """Shifts of a hash that give its places in a filter of 2**bits."""
    return (64 - bits, 0, 19)


def hash_filter(hashes: DataFrame) -> np.ndarray:
    """2**b bools, true at the places that the probes of some ``hash`` give.

    What reaches the driver is the filter, 2**FILTER_BITS bits at most, however many
    hashes there are; where they are too many for it, more of the documents' rows
    pass and are shuffled, and none is lost."""
    wanted = max(1, hashes.count()) * BITS_A_HASH
    bits = min(FILTER_BITS, max(15, (wanted - 1).bit_length()))
    places = F.array(*[F.expr(f"shiftrightunsigned(hash, {shift}) & {(1 << bits) - 1}") for shift in probes(bits)])
    at = hashes.select(F.explode(places).alias("at")).selectExpr(f"at div {_CHUNK} AS chunk", f"at % {_CHUNK} AS bit")
    allows = np.zeros(1 << bits, bool)
    for r in at.groupBy("chunk").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        allows[r["chunk"] * _CHUNK : (r["chunk"] + 1) * _CHUNK] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
    return allows


def document_seeds(texts: DataFrame, spans: list[int], allows: np.ndarray) -> DataFrame:
    """(hash, k1, k2, doc_window): the masked hashes of every window of the texts
    (k1, k2, text) that the filter lets through.

    Where no substitution is allowed, the hash covers a whole short item and finds
    equal words only, so one row a text and hash is enough."""
    packed, bits = np.packbits(allows), len(allows).bit_length() - 1

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there, low = np.unpackbits(packed).view(bool), np.uint64(len(allows) - 1)
        first, *others = (np.uint64(shift) for shift in probes(bits))
        for batch in batches:
            held = [t or "" for t in batch.column(2).to_pylist()]
            for cut in slices(held):
                words, owner = text_words(held[cut])
                ends = np.searchsorted(owner, np.arange(cut.stop - cut.start), side="right")
                for span in spans:
                    for hashes in masked_hashes(words, span):
                        place = np.flatnonzero(there[hashes >> first])
                        for shift in others:
                            place = place[there[(hashes[place] >> shift) & low]]
                        place = place[owner[place] == owner[place + span - 1]]  # not across texts
                        if not allowed(span):
                            place = place[np.unique(np.stack([owner[place], hashes[place].view(np.int64)]), axis=1, return_index=True)[1]]
                        if len(place):
                            text = pa.array(cut.start + owner[place])
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(hashes[place].view(np.int64)), batch.column(0).take(text), batch.column(1).take(text), _windows(words, ends[owner[place]], place)],
                                ["hash", "k1", "k2", "doc_window"])

    return texts.mapInArrow(seeds, "hash long, k1 long, k2 long, doc_window array<long>")


def _keys(text: Column) -> tuple[Column, Column]:
    """128 bits that stand for a text: equal texts have equal overlaps."""
    return F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")


def contaminated_texts(texts: Column, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(k1, k2, items, share) of the texts that overlap a benchmark item: the sorted
    ids of the items, and the share of agreeing words in the best window.

    A window of an item is verified with each window of a text that shares a masked
    hash with it; the masks leave out no window that the share accepts.  A passage
    that very many texts hold makes its hashes hot: the join is open to skew splits,
    and its rows are combined by text before they are shuffled."""
    seeds = materialise(benchmark_seeds(benchmark), "benchmark-seeds")
    spans = sorted(r["span"] for r in seeds.select("span").distinct().collect())  # WINDOW values at most
    found = document_seeds(docs.select(*_keys(texts), texts.alias("text")), spans, hash_filter(seeds.select("hash")))
    met = join_dimension(found, seeds.select("hash", "item_id", "size", "item_window"), "hash")
    same = F.size(F.filter(F.zip_with("doc_window", "item_window", lambda x, y: x == y), lambda equal: equal))
    verified = met.filter(F.size("doc_window") >= F.col("size")).withColumn("share", same / F.col("size")).filter(F.col("share") >= SHARE)
    best = verified.groupBy("k1", "k2", "item_id").agg(F.max("share").alias("share"))
    return best.groupBy("k1", "k2").agg(F.sort_array(F.collect_list("item_id")).alias("items"), F.max("share").alias("share"))


def mark_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with two columns more: ``contaminated_by`` (sorted ids of the
    benchmark items that overlap the text) and ``overlap`` (share of agreeing
    words in the best window, 0 without one).

    Every whole text meets every benchmark item: 16-word windows of an item, shorter
    items whole, with at least 80 % of equal words; so an item of up to four words
    must occur word for word.  In scripts without spaces each character is a word.
    Null and empty texts have no overlap; repeated rows and equal texts are marked
    alike; items of equal texts are all named; an empty benchmark marks nothing;
    columns of ``docs`` with those two names are replaced, others may have any name."""
    marks = contaminated_texts(F.col(text_col), docs, benchmark)
    row = docs.select(F.struct(*docs.columns).alias("row"), *_keys(F.col(text_col)))
    marks = marks.withColumnsRenamed({"k1": "m1", "k2": "m2"})
    joined = row.join(marks, (F.col("k1") == F.col("m1")) & (F.col("k2") == F.col("m2")), "left")
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("contaminated_by", "overlap")]
    none = F.array().cast("array<long>")
    return joined.select(*kept, F.coalesce("items", none).alias("contaminated_by"), F.coalesce("share", F.lit(0.0)).alias("overlap"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item, with their columns."""
    marks = contaminated_texts(F.col(text_col), docs, benchmark).select(F.col("k1").alias("m1"), F.col("k2").alias("m2"))
    row = docs.select(F.struct(*docs.columns).alias("row"), *_keys(F.col(text_col)))
    return row.join(marks, (F.col("k1") == F.col("m1")) & (F.col("k2") == F.col("m2")), "left_anti").select("row.*")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = mark_contamination(
        read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", (F.size("contaminated_by") > 0).alias("contaminated"), "contaminated_by", "overlap")
