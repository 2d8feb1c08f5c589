"""Language identification by compression.

Every language has a zstandard raw-content dictionary made of learned text; a
text belongs to the language whose dictionary compresses it best, and the
decision is marked as rejected when the margin to the next language is narrow.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table
from .quality import held_out

SAMPLE_ROWS = 40  # learned rows per language, each with its whole text
REJECT_MARGIN = 0.02
LEVEL = 9  # zstandard's level for every text
TAIL = b" " * 64  # behind every text: a run that compresses, so that the frames of short texts do too
PADDING = b" " * 16  # behind every dictionary, whose last bytes are never matched
_WORD = re.compile(r"[^\W_]+")


def normalise(text: str | None) -> str:
    """Lower-cased words of letters, single spaces between them; words with a
    digit go, unless there are no others."""
    words = _WORD.findall((text or "").lower())
    return " ".join([w for w in words if w.isalpha()] or words)


def learn_dictionaries(labelled: DataFrame, rows: int = SAMPLE_ROWS) -> dict[str, str]:
    """Dictionary text per language from (doc_id, text, lang): the whole texts of the
    ``rows`` rows of smallest hash per language.  The sample is bounded by that
    number of rows; Spark cuts it per task before the shuffle."""
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", "text"), "text")
    picked = (
        labelled.filter("lang IS NOT NULL AND text IS NOT NULL AND text <> ''")
        .select("doc_id", "lang", "text").withColumn("n", F.row_number().over(order)).filter(F.col("n") <= rows)
        .orderBy("lang", F.col("n").desc()).select("lang", "text").collect()
    )
    found: dict[str, list[str]] = {}
    for lang, text in picked:
        found.setdefault(lang, []).append(normalise(text))
    return {lang: " " + " ".join(x for x in texts if x) + " " for lang, texts in found.items()}


class CompressionClassifier:
    """Every text is compressed by the same coders: one per language, all of one level."""

    def __init__(self, dictionaries: dict[str, str]):
        self.langs = sorted(dictionaries)
        self.coders = [self._coder(dictionaries[x]) for x in self.langs]

    @staticmethod
    def _coder(text: str) -> zstandard.ZstdCompressor:
        data = zstandard.ZstdCompressionDict(text.encode("utf-8", "replace") + PADDING, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)

    def classify(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, margin): the language of the smallest size, of equal ones
        the first by name, with margin 0.  ``und`` with score 0 without a letter."""
        if not self.langs or not any(map(str.isalpha, text or "")):
            return "und", 0.0, 0.0
        raw = f" {normalise(text)} ".encode("utf-8", "replace") + TAIL
        sizes = np.array([len(c.compress(raw)) for c in self.coders], dtype=float)
        best = int(sizes.argmin())
        others = np.delete(sizes, best)
        margin = float((others.min() - sizes[best]) / others.min()) if len(others) else 1.0
        score = 1.0 / (1.0 + float(np.exp2(np.clip(sizes[best] - others, -60, 0)).sum()))
        return self.langs[best], score, margin


def identify_language(docs: DataFrame, dictionaries: dict[str, str], reject_margin: float = REJECT_MARGIN,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, margin, rejected) per row of ``docs``.

    The whole text is compressed, however long.  ``rejected`` marks a margin below
    ``reject_margin``; the best language stays in ``lang_pred``, of equal ones the
    first by name.  Null, empty and letterless texts are ``und`` (rejected, score 0);
    repeated rows come back once each, alike; a null doc_id stays null; extra columns
    are not read; an empty table gives an empty result; with nothing learned every
    text is ``und``."""

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = CompressionClassifier(dictionaries)
        for batch in batches:
            rows = [model.classify(t.as_py()) for t in batch.column(1)]
            langs, scores, margins = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(margins, pa.float64()),
                 pa.array([m < reject_margin for m in margins], pa.bool_())],
                ["doc_id", "lang_pred", "score", "margin", "rejected"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(classify, "doc_id long, lang_pred string, score double, margin double, rejected boolean")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    unseen = held_out(modulus=4, fold=2)
    learned = learn_dictionaries(docs.filter(~unseen).select("doc_id", "text", "lang"))
    return identify_language(docs, learned).select("doc_id", unseen.alias("held_out"), "lang_pred", "score", "margin", "rejected")
