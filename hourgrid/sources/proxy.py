"""Proxy clinical tables derived from the driver's ``events`` table.

Each base table of the jobs is rebuilt from ``events`` with narrow
projections (no joins: the item lookups are array lookups by position), plus
one aggregation for the stay table.  The derivation is the one documented in
FIXTURES.md; the SQL twin used by the DuckDB oracle lives in
``hourgrid.oracle.PROXY_CTES``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import concepts as C

# Item code cycles of the proxy tables (position = event_id % n): every item the
# jobs know, and one they do not.
CHART_ITEMS = (*C.vital_items(C.VITALS_10), 1)
LAB_ITEMS = (*C.lab_items(), 50806)
INPUT_ITEMS = (*(i for _, items in C.INPUT_SETS for i in items), 1)
OUTPUT_ITEMS = (*dict.fromkeys(C.URINE_14 + C.URINE_11), 1)


def _cycle_sql(items: tuple[int, ...]) -> str:
    """items[event_id % len(items)] as int."""
    arr = "array(" + ", ".join(str(i) for i in items) + ")"
    return f"CAST(element_at({arr}, CAST(pmod(event_id, {len(items)}) + 1 AS INT)) AS INT)"


def staged_events(events: DataFrame) -> DataFrame:
    """events + subject / admission / stay keys (subject = user_id // 8, stay = subject x ISO week)."""
    return events.selectExpr(
        "CAST(FLOOR(user_id / 8) AS BIGINT) AS subject_id",
        "CAST(FLOOR(user_id / 8) AS BIGINT) * 10 + CAST(FLOOR((weekofyear(ts) + 1) / 2) AS BIGINT) AS hadm_id",
        "CAST(FLOOR(user_id / 8) AS BIGINT) * 10 + weekofyear(ts) AS icustay_id",
        "event_id", "ts", "event_type", "value")


def _unit_sql() -> str:
    return "CASE pmod(event_id, 5) WHEN 0 THEN 'mg' WHEN 1 THEN 'mL' ELSE 'ml' END"


class ClinicalTables:
    """The eight base tables, each built on first use from the staged events."""

    def __init__(self, events: DataFrame):
        self._events = events

    @cached_property
    def ev(self) -> DataFrame:
        return staged_events(self._events)

    @cached_property
    def icustays(self) -> DataFrame:
        return (self.ev.groupBy("subject_id", "hadm_id", "icustay_id")
                .agg(F.expr("CAST(min(ts) + INTERVAL '90' MINUTE AS TIMESTAMP_NTZ)").alias("intime"),
                     F.expr("CAST(max(ts) - INTERVAL '90' MINUTE AS TIMESTAMP_NTZ)").alias("outtime")))

    @cached_property
    def admissions(self) -> DataFrame:
        # min(intime) - 6 h and max(outtime) + 1 day of the admission's stays,
        # taken straight from the events (one aggregation instead of two)
        return (self.ev.groupBy("subject_id", "hadm_id")
                .agg(F.expr("CAST(min(ts) + INTERVAL '90' MINUTE - INTERVAL '6' HOUR AS TIMESTAMP_NTZ)")
                     .alias("admittime"),
                     F.expr("CAST(max(ts) - INTERVAL '90' MINUTE + INTERVAL '1' DAY AS TIMESTAMP_NTZ)")
                     .alias("dischtime"))
                .selectExpr("subject_id", "hadm_id", "admittime", "dischtime",
                            "CASE WHEN pmod(hadm_id, 3) = 0 THEN 'ELECTIVE' ELSE 'EMERGENCY' END AS admission_type",
                            "CASE WHEN pmod(hadm_id, 2) = 0 THEN 'A' ELSE 'B' END AS ethnicity",
                            "CAST(pmod(hadm_id, 5) = 0 AS INT) AS hospital_expire_flag"))

    @cached_property
    def patients(self) -> DataFrame:
        # the subjects of the stays are the subjects of the events
        return (self.ev.select("subject_id").distinct()
                .selectExpr("subject_id",
                            "CASE WHEN pmod(subject_id, 2) = 0 THEN 'M' ELSE 'F' END AS gender",
                            "CAST(date_add(DATE'1940-01-01', CAST(subject_id * 97 AS INT)) AS TIMESTAMP_NTZ) AS dob"))

    @cached_property
    def chartevents(self) -> DataFrame:
        return self.ev.selectExpr(
            "icustay_id", "ts AS charttime", f"{_cycle_sql(CHART_ITEMS)} AS itemid", "value AS valuenum",
            "CASE WHEN pmod(event_id, 17) = 0 THEN 1 WHEN pmod(event_id, 17) < 9 THEN 0 END AS error")

    @cached_property
    def labevents(self) -> DataFrame:
        return self.ev.selectExpr(
            "hadm_id", "ts AS charttime", f"{_cycle_sql(LAB_ITEMS)} AS itemid",
            "CASE WHEN pmod(event_id, 11) = 0 THEN CAST(NULL AS DOUBLE) WHEN pmod(event_id, 13) = 0 THEN -value "
            "WHEN pmod(event_id, 5) = 0 THEN value * 3000 ELSE value END AS valuenum")

    @cached_property
    def inputevents_cv(self) -> DataFrame:
        return self.ev.selectExpr(
            "icustay_id", "ts AS charttime", f"{_cycle_sql(INPUT_ITEMS)} AS itemid", "value AS amount",
            f"{_unit_sql()} AS amountuom")

    @cached_property
    def outputevents(self) -> DataFrame:
        return self.ev.selectExpr(
            "icustay_id", "ts AS charttime", f"{_cycle_sql(OUTPUT_ITEMS)} AS itemid", "value",
            f"{_unit_sql()} AS valueuom")

    @cached_property
    def ventdurations(self) -> DataFrame:
        return self.ev.where("event_type = 'signup'").selectExpr("icustay_id", "ts AS starttime")


def proxy_tables(events: DataFrame) -> ClinicalTables:
    return ClinicalTables(events)


# Columns of the driver's events table that the proxies read (no inference job).
EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE"


def load_proxy(spark: SparkSession, sf_dir: str) -> ClinicalTables:
    """Proxy tables for one scale-factor folder of driver test data."""
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return proxy_tables(events)
