"""SimHash near-dedup with a byte-position inverted index.

Two 64-bit fingerprints within three bits differ in at most three of their
eight bytes, so they share at least five positional bytes.  Every 5-subset of
the eight positions contains one of the eight triples inside {0,1,2,3} or
inside {4,5,6,7}; the index therefore posts each distinct fingerprint under its
eight (positions, three bytes) keys, and every pair that can reach five shared
bytes meets in a posting list.  (A list per single byte would hold 1/256 of all
fingerprints and its pair tally would grow with the square of the corpus.)
For each meeting pair the shared positional bytes are tallied, pairs below the
guaranteed minimum go, and the rest are verified by their exact bit distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.joins import join_dimension
from .common import connected_components, materialise, read_table

BLOCK = 1 << 16  # shingles whose bits are unpacked at a time


def fingerprint_of(text: str | None, shingle_words: int = 3, seed: int = 42) -> int:
    """SimHash of one text as a signed 64-bit integer (see ``fingerprints``)."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle_words:
        hashes = [digest(joined, seed)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        spans = zip(starts[: len(words) - shingle_words + 1].tolist(), ends[shingle_words - 1 :].tolist(), strict=True)
        hashes = [digest(joined[a:b], seed) for a, b in spans]
    values = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(values), BLOCK):
        ones += np.unpackbits(values[at : at + BLOCK], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, fp) for every row; equal texts have equal keys.  Only A-Z is lower-cased; words are runs of
    bytes other than space and \\t..\\r; shingles are joined by one space; a text
    of fewer words is one shingle; no words (or null): fingerprint zero."""

    def simhash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint_of(t.as_py(), shingle_words) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(marks, pa.int64())], ["doc_id", "text_key", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    return rows.mapInArrow(simhash, "doc_id long, text_key long, fp long")


def _shared_bytes() -> str:
    same = " + ".join(f"int((x & {hex_mask(p)}) = 0)" for p in range(8))
    return f"({same})"


def hex_mask(position: int) -> str:
    """SQL literal of the byte mask at a position (0: lowest byte)."""
    return f"shiftleft(255L, {8 * position})"


def fingerprint_links(distinct: DataFrame, max_distance: int = 3) -> DataFrame:
    """Links (a, b), a < b, between distinct fingerprints of a table (fp).

    A fingerprint has at most C(64,1)+C(64,2)+C(64,3) neighbours within three
    bits, so links grow in proportion to the fingerprints at worst."""
    if not 0 <= max_distance <= 3:
        raise ValueError("the triples of positions guarantee a shared list up to three differing bytes")
    triples = [t for half in (range(4), range(4, 8)) for t in combinations(half, 3)]
    postings = F.array(*[
        F.expr(f"shiftleft({n}L, 24)" + "".join(f" | shiftleft(shiftright(fp, {8 * p}) & 255L, {8 * i})" for i, p in enumerate(t)))
        for n, t in enumerate(triples)
    ])
    index = distinct.select("fp", F.explode(postings).alias("posting"))
    meet = index.alias("l").join(
        index.alias("r"),
        F.expr("l.posting = r.posting AND l.fp < r.fp AND "
               + _shared_bytes().replace("x &", "(l.fp ^ r.fp) &") + f" >= {8 - max_distance}"
               + f" AND bit_count(l.fp ^ r.fp) <= {max_distance}"),
    )
    return meet.selectExpr("l.fp AS a", "r.fp AS b").distinct()


def near_groups(docs: DataFrame, shingle_words: int = 3, max_distance: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, fp, component, component_id) per row of ``docs``: the
    smallest fingerprint of its group of linked fingerprints, and the smallest doc_id
    in that group."""
    marks = materialise(fingerprints(docs, shingle_words, id_col, text_col), "fingerprints")
    distinct = marks.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    parts = connected_components(fingerprint_links(distinct.select("fp"), max_distance))
    linked = parts.join(distinct, parts.node == distinct.fp).select("component", "fp", "first_id")
    smallest = linked.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = linked.join(smallest, "component").select("fp", "component", "component_id")
    group = distinct.join(named, "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("component"), F.coalesce("component_id", "first_id").alias("component_id"))
    # one fingerprint may be that of a third of all rows
    return join_dimension(marks, group, "fp")


def simhash_dedup(docs: DataFrame, shingle_words: int = 3, max_distance: int = 3,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links, itself
    included.  Rows without text (null, empty or white space) share fingerprint
    zero and link like any other; repeated rows come back once each with the
    same component; a null doc_id never names a component unless the component
    has no other id; an empty table gives an empty result.  Copies meet as one
    fingerprint, so a group of copies of any size is one index entry."""
    found = near_groups(docs, shingle_words, max_distance, id_col, text_col)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(read_table(spark, sf_dir, "documents"))
