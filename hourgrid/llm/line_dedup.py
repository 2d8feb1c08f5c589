"""Fuzzy line dedup by MinHash.

Each distinct line gets MinHash values over its character shingles.  Bands of
values post a line under keys that similar lines share; every posted line is
compared with its key's representative by the exact Jaccard similarity of the
shingle sets.  Keys whose lines are not one component after that are compared in
full, block against block, so no link is lost while most groups of near copies
cost one comparison a line.  Distributed union-find joins the links, and of each
component the first line in document order stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.joins import join_dimension
from .common import connected_components, materialise, read_table
from .tokens import mixed, slices

SHINGLE = 7  # characters
BANDS = 12
ROWS = 5  # MinHash values of a band
SIMILARITY = 0.8
CHUNK = 1 << 17  # characters hashed at a time
BLOCK = 512  # lines of a block of a key's lines
COLUMNS = 4096  # shingles of a matrix product
FEW_PAIRS = 64  # up to here pairs of different parts are compared one by one
SEEN_LINES = 1 << 20  # line hashes that a task remembers, to post a line once

_RNG = np.random.default_rng(11)
_SCALE = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_SHIFT = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)


def _shingle_hashes(chars: np.ndarray) -> np.ndarray:
    """A well-mixed 32-bit hash of the shingle that starts at each character."""
    n = len(chars) - SHINGLE + 1
    h = np.zeros(n, np.uint32)
    for i in range(SHINGLE):
        h *= np.uint32(0x01000193)
        h += chars[i : i + n]
        h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(16)
    return h


def _chunk_minima(lines: list[str]) -> np.ndarray:
    """(hash functions, lines) minima."""
    lengths = np.array([len(x) for x in lines])
    chars = np.frombuffer(("".join(lines) + "\0" * SHINGLE).encode("utf-32-le", "replace"), "<u4")
    starts = np.cumsum(lengths) - lengths
    h = _shingle_hashes(chars)
    for i in np.flatnonzero(lengths < SHINGLE):
        h[starts[i]] = xxhash.xxh32_intdigest(lines[i].encode("utf-8", "replace"))
    ends = starts + np.maximum(1, lengths - SHINGLE + 1)
    bounds = np.stack([starts, ends], axis=1).ravel()  # of each line's shingles, and of the gap behind them
    minima = np.empty((len(_SCALE), len(lines)), np.uint32)
    y = np.empty_like(h)
    for j in range(len(_SCALE)):
        np.multiply(h, _SCALE[j], out=y)
        y += _SHIFT[j]
        minima[j] = np.minimum.reduceat(y, bounds)[::2]
    return minima


def band_keys(lines: list[str]) -> np.ndarray:
    """(lines, BANDS) keys; equal lines have equal keys.  Lines must not be empty;
    a line shorter than a shingle is one shingle."""
    keys = np.zeros((len(lines), BANDS), np.uint64)
    for cut in slices(lines, CHUNK):
        minima = _chunk_minima(lines[cut]).astype(np.uint64).reshape(BANDS, ROWS, -1)
        h = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[:, None], minima.shape[2], axis=1)
        for j in range(ROWS):
            h = mixed(h * np.uint64(31) + minima[:, j])
        keys[cut] = h.T
    return keys.view(np.int64)


def _distinct(codes: np.ndarray) -> np.ndarray:
    """The sorted distinct codes; for arrays as short as a line's far quicker than np.unique."""
    codes = np.sort(codes)
    return codes[np.append(True, codes[1:] != codes[:-1])]


def shingle_codes(lines: list[str]) -> list[np.ndarray]:
    """The set of a line's character shingles, as sorted 64-bit codes; a line
    shorter than a shingle is one shingle."""
    found: list[np.ndarray] = []
    for cut in slices(lines, CHUNK):
        own = lines[cut]
        chars = np.frombuffer(("".join(own) + "\0" * SHINGLE).encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
        h = np.zeros(len(chars) - SHINGLE + 1, np.uint64)
        for i in range(SHINGLE):
            h *= np.uint64(0x9E3779B97F4A7C15)
            h += chars[i : i + len(h)]
        h = mixed(h)
        at = 0
        for line in own:
            if len(line) < SHINGLE:
                found.append(np.array([xxhash.xxh3_64_intdigest(line.encode("utf-8", "replace"))], np.uint64))
            else:
                found.append(_distinct(h[at : at + len(line) - SHINGLE + 1]))
            at += len(line)
    return found


def reaches(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """Whether two shingle sets have at least that Jaccard similarity."""
    if len(x) > len(y):
        x, y = y, x
    if len(x) < similarity * len(y):
        return False
    place = np.searchsorted(y, x)
    place[place == len(y)] = 0
    shared = int(np.count_nonzero(y[place] == x))
    return shared >= similarity * (len(x) + len(y) - shared)


def posted_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line with a visible character: doc_id, text_key, line_no (from
    0), line_id and its band keys.  Of equal lines that a task remembers
    only the first carries keys, so the postings of a very frequent line stay few."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for cut in slices(texts):
                if len(seen) > SEEN_LINES:
                    seen.clear()
                row, number, line_id, first, fresh = [], [], [], [], []
                for n in range(cut.start, cut.stop):
                    for i, line in enumerate(texts[n].split("\n")):
                        if line and not line.isspace():
                            h = xxhash.xxh3_64_intdigest(line.encode("utf-8", "replace"))
                            first.append(h not in seen)
                            if first[-1]:
                                seen.add(h)
                                fresh.append(line)
                            row.append(n)
                            number.append(i)
                            line_id.append(h)
                if not row:
                    continue
                bands = band_keys(fresh)
                counts = np.array(first) * BANDS
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(take), keys.take(take), pa.array(number, pa.int32()),
                     pa.array(np.array(line_id, np.uint64).view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands.ravel()))],
                    ["doc_id", "text_key", "line_no", "line_id", "bands"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    return source.mapInArrow(post, "doc_id long, text_key long, line_no int, line_id long, bands array<long>")


def _line_texts(docs: DataFrame, lines: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(line_id, line) of the wanted line ids, cut out of one document each."""
    place = join_dimension(lines, wanted, "line_id", how="left_semi").groupBy("line_id").agg(F.min(F.struct("doc_id", "text_key", "line_no")).alias("at"))
    held = place.groupBy("at.doc_id", "at.text_key").agg(F.collect_list(F.struct("at.line_no", "line_id")).alias("lines"))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    match = source.doc_id.eqNullSafe(held.doc_id) & (source.text_key == held.text_key)
    cut = F.expr("transform(lines, x -> struct(x.line_id AS line_id, parts[x.line_no] AS line))")
    found = source.join(held, match).select(F.split("text", "\n", -1).alias("parts"), "lines").select(F.inline(cut))
    return found.dropDuplicates(["line_id"])


def _links(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of line ids whose lines reach the similarity."""

    @F.pandas_udf("boolean")
    def similar(left: pd.Series, right: pd.Series) -> pd.Series:
        lines = list({*left, *right})
        known = dict(zip(lines, shingle_codes(lines), strict=True))
        return pd.Series([reaches(known[x], known[y], similarity) for x, y in zip(left, right, strict=True)], dtype=bool)

    left = texts.select(F.col("line_id").alias("a"), F.col("line").alias("left"))
    right = texts.select(F.col("line_id").alias("b"), F.col("line").alias("right"))
    return pairs.join(left, "a").join(right, "b").filter(similar("left", "right")).select("a", "b")


def joining_pairs(sets: list[np.ndarray], parts: list[int], left: np.ndarray, right: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Pairs of places (i in left, j in right) whose sets reach the similarity, as
    many as it takes to join the parts that such pairs connect."""
    found: list[tuple[int, int]] = []
    parent = {p: p for p in parts}

    def root(p: int) -> int:
        while parent[p] != p:
            parent[p] = parent[parent[p]]
            p = parent[p]
        return p

    def join(i: int, j: int) -> None:
        parent[root(parts[i])] = root(parts[j])
        found.append((i, j))

    number = np.unique(np.array(parts), return_inverse=True)[1]
    apart = number[left][:, None] != number[right]
    if np.array_equal(left, right):
        apart = np.triu(apart)
    if np.count_nonzero(apart) <= FEW_PAIRS:
        for i, j in zip(*(side[at].tolist() for side, at in zip((left, right), np.nonzero(apart), strict=True)), strict=True):
            if root(parts[i]) != root(parts[j]) and reaches(sets[i], sets[j], similarity):
                join(i, j)
        return found
    sizes = np.array([len(x) for x in sets])
    codes, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = np.cumsum(count > 1) - 1  # only codes of two lines or more can be shared
    row = np.repeat(np.arange(len(sets)), sizes)[count[column] > 1]
    column = several[column[count[column] > 1]]
    shared = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, int((count > 1).sum()), COLUMNS):
        here = (column >= at) & (column < at + COLUMNS)
        matrix = np.zeros((len(sets), COLUMNS), np.float32)
        matrix[row[here], column[here] - at] = 1
        shared += matrix[left] @ matrix[right].T
    for i, j in np.argwhere(shared >= similarity * (sizes[left][:, None] + sizes[right][None, :] - shared)).tolist():
        if root(parts[left[i]]) != root(parts[right[j]]):
            join(int(left[i]), int(right[j]))
    return found


def _links_in_keys(members: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that join the parts of (band, n, line_id, part) within a key.

    A key's lines are cut into blocks of about BLOCK lines, and every pair of its
    blocks is compared in some task by one matrix product, so a key of any size is
    spread and every pair of its lines is compared."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("line_id"), blocks).cast("int")
    sides = F.transform(F.sequence(F.lit(0), blocks - 1), lambda other: F.struct(
        F.least(own, other).alias("i"), F.greatest(own, other).alias("j")))
    dealt = members.withColumn("block", own).withColumn("pair", F.explode(sides)).select("band", "line_id", "part", "block", "pair.i", "pair.j")
    groups = max(1, -(-dealt.count() // (4 * BLOCK)))
    dealt = dealt.withColumn("task", F.pmod(F.xxhash64("band", "i", "j"), F.lit(groups)).cast("int")).join(texts, "line_id")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        lines = list(set(frame["line"]))
        known = dict(zip(lines, shingle_codes(lines), strict=True))
        frame = frame.sort_values(["band", "i", "j"])
        keys = frame[["band", "i", "j"]].to_numpy()
        starts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]])
        block, ids, parts = (frame[c].to_numpy() for c in ("block", "line_id", "part"))
        sets = [known[x] for x in frame["line"]]
        for at, to in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            left, right = np.flatnonzero(block[at:to] == keys[at, 1]), np.flatnonzero(block[at:to] == keys[at, 2])
            pairs = joining_pairs(sets[at:to], parts[at:to].tolist(), left, right, similarity)
            out += [(ids[at + x], ids[at + y]) for x, y in pairs]
        return pd.DataFrame({"a": [int(x) for x, _ in out], "b": [int(y) for _, y in out]}, dtype="int64")

    return dealt.groupBy("task").applyInPandas(compare, "a long, b long").distinct()


def _with_links(parts: DataFrame, extra: DataFrame) -> DataFrame:
    """Components (node, component) after further links (a, b): union-find over the
    components that the links meet only."""
    ends = extra.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    named = materialise(ends.join(parts, "node", "left").select("node", F.coalesce("component", "node").alias("part")), "link-ends")
    a, b = (named.select(F.col("node").alias(x), F.col("part").alias(f"{x}_part")) for x in "ab")
    joined = connected_components(extra.join(a, "a").join(b, "b").select(F.col("a_part").alias("a"), F.col("b_part").alias("b")))
    joined = joined.select(F.col("node").alias("part"), F.col("component").alias("whole"))
    every = parts.union(named).withColumnsRenamed({"component": "part"}).distinct()
    return every.join(joined, "part", "left").select("node", F.coalesce("whole", "part").alias("component"))


def duplicate_lines(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, removed array<int>): line numbers (from 0) to remove.

    Every line with a visible character counts; of each component of lines that
    are equal or reach the similarity, the line of the smallest (doc_id, line
    number) stays, null doc_ids first.  Rows that repeat a document under the
    same doc_id and text are one document.  Documents without a removed line are
    not returned; null and empty texts and empty tables have no lines."""
    lines = materialise(posted_lines(docs, id_col, text_col), "lines")
    bucket = Window.partitionBy("band")
    posted = lines.select(F.explode("bands").alias("band"), "line_id").withColumns(
        {"low": F.min("line_id").over(bucket), "high": F.max("line_id").over(bucket)})
    posted = materialise(posted.filter("low < high").distinct(), "postings")
    near = posted.selectExpr("low AS a", "line_id AS b").union(posted.selectExpr("line_id AS a", "high AS b")).filter("a < b").distinct()
    texts = materialise(_line_texts(docs, lines, posted.select("line_id").distinct(), id_col, text_col), "line-texts")
    links = materialise(_links(near, texts, similarity), "links")
    parts = connected_components(links)
    # pairs with a key's lowest or highest line have all been compared: of the other
    # lines, those that are not one component meet each other
    inner = posted.filter("low < line_id AND line_id < high")
    named = inner.join(parts.withColumnRenamed("node", "line_id"), "line_id", "left").select(
        "band", "line_id", F.coalesce("component", "line_id").alias("part"))
    several = named.groupBy("band").agg(F.min("part").alias("p"), F.max("part").alias("q"), F.count("*").alias("n")).filter("p < q")
    open_keys = materialise(join_dimension(named, several.select("band", "n"), "band"), "open-keys")
    extra = materialise(_links_in_keys(open_keys, texts, similarity), "links")
    parts = _with_links(parts, extra)
    # a line may be on a third of all rows: the joins below keep AQE free to split it
    own = (F.col("line_id") == F.col("node")) & (F.xxhash64("line_id") == F.xxhash64("node"))
    whole = lines.select("doc_id", "text_key", "line_no", "line_id").join(parts, own, "left").select(
        "doc_id", "text_key", "line_no", F.coalesce("component", "line_id").alias("part"))
    kept = whole.groupBy("part").agg(F.min(F.struct("doc_id", "line_no", "text_key")).alias("kept"), F.count("*").alias("n")).filter("n > 1")
    gone = join_dimension(whole, kept, "part").filter(
        ~(F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("line_no") == F.col("kept.line_no")) & (F.col("text_key") == F.col("kept.text_key"))))
    return gone.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("line_no")).alias("removed"))


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without its duplicate lines (see ``duplicate_lines``), all rows and
    columns kept: a text loses the removed lines and their line feeds, and may
    become empty.  Null texts stay null."""
    gone = duplicate_lines(docs, similarity, id_col, text_col).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("removed").alias("__removed"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).cast("long").alias("__doc"), F.xxhash64(text_col).alias("__text"))
    joined = rows.join(gone, rows["__doc"].eqNullSafe(gone["__id"]) & (rows["__text"] == gone["__key"]), "left")
    text = F.col("row").getField(text_col)
    left = F.filter(F.split(text, "\n", -1), lambda _, i: ~F.array_contains("__removed", i))
    shorter = F.when(F.col("__removed").isNull(), text).otherwise(F.array_join(left, "\n"))
    return joined.select(*[(shorter if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns])


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed) per document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    gone = duplicate_lines(docs).withColumnsRenamed({"doc_id": "id", "text_key": "key"})
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).alias("n_lines"))
    joined = rows.join(gone, rows.doc_id.eqNullSafe(gone["id"]) & (rows.text_key == gone["key"]), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return joined.select("doc_id", "n_lines", F.size(removed).alias("n_removed"), removed.alias("removed"))
