"""The corpus pipeline: documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result as Parquet in the shared folder and hands the reread table
to the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import materialise, read_table
from hourgrid.llm.decontaminate import decontaminate
from hourgrid.llm.line_dedup import dedup_lines
from hourgrid.llm.packing import pack_documents
from hourgrid.llm.quality import classify_quality
from hourgrid.llm.simhash import near_groups


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects.

    Rows are judged by doc_id: rows that share one stay if any of them passes, and
    rows with a null doc_id are judged together as well."""
    marks = classify_quality(docs, read_table(spark, sf_dir, "labels"))
    kept = marks.filter("predicted = 1").select(marks.doc_id.alias("kept_id")).distinct()
    return docs.join(kept, docs.doc_id.eqNullSafe(kept.kept_id), "left_semi")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes all but the first of each group of equal or similar lines; a text
    that changes gets its new n_chars."""
    lines = dedup_lines(docs)
    return lines.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else lines


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each group, the document with the smallest doc_id stays,
    of several texts under that doc_id in the group the one of the smallest hash.

    A doc_id that names texts of different groups is judged in each of them.  Rows
    that repeat a doc_id and text stay once, the first by a hash of all columns; a
    null doc_id names no document and such rows stay."""
    first = near_groups(docs).filter("doc_id = component_id").groupBy("component").agg(F.min(F.struct("doc_id", "text_key")).alias("kept"))
    kept = first.select(F.col("kept.doc_id").alias("kept_id"), F.col("kept.text_key").alias("kept_key")).distinct()
    rows = docs.filter("doc_id IS NOT NULL").select(
        F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("key"), F.xxhash64(*docs.columns).alias("row_key"))
    one = rows.join(kept, (F.col("id") == F.col("kept_id")) & (F.col("key") == F.col("kept_key")), "left_semi")
    place = F.row_number().over(Window.partitionBy("id", "key").orderBy("row_key"))
    once = one.withColumn("place", place).filter("place = 1").select("row.*")
    return once.union(docs.filter("doc_id IS NULL"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that overlap a benchmark item; null and empty texts stay, and
    rows of equal texts share their fate."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs every document that is left into sequences of 2048 tokens: null and empty
    texts as their end id, repeated rows once each."""
    return pack_documents(docs, with_ids=False)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: The stages use trained models, fingerprints and a tokenizer, which SQL does
#: not have; tests/llm/test_pipeline.py holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
