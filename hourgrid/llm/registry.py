"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .best_fit import op11_best_fit
from .clusters import op12_clusters, op12_sql
from .decontaminate import op8_decontamination
from .html_extract import op5_html
from .language import op3_language
from .line_dedup import op2_line_dedup
from .lm_score import op4_lm_score
from .manifest import OP13_SQL, op13_manifest
from .packing import op10_packing
from .pii import op6_pii
from .quality import op9_quality
from .simhash import op1_simhash
from .topk import OP7_SQL, op7_topk

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_line_dedup": op2_line_dedup,
    "op3_language": op3_language,
    "op4_lm_score": op4_lm_score,
    "op5_html": op5_html,
    "op6_pii": op6_pii,
    "op7_topk": op7_topk,
    "op8_decontamination": op8_decontamination,
    "op9_quality": op9_quality,
    "op10_packing": op10_packing,
    "op11_best_fit": op11_best_fit,
    "op12_clusters": op12_clusters,
    "op13_manifest": op13_manifest,
}

ORACLE_SQL: dict[str, str] = {"op7_topk": OP7_SQL, "op12_clusters": op12_sql(), "op13_manifest": OP13_SQL}
