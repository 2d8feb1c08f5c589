"""Clinical concept dictionaries and the Column builders that apply them.

Everything in the "FIXED VALUES" block must equal the reference's item codes,
ranges, labels and limits, otherwise results differ.  The builders below turn
the dictionaries into CASE expressions and IN-list predicates, so the work
stays inside Catalyst's generated code (no UDFs).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class VitalRule:
    """One branch of the item -> concept code mapping with its plausibility gate.

    A row gets ``code`` when its item is in ``items`` and its raw value lies in
    ``lo < v < hi`` (``v <= hi`` when ``hi_inclusive``; no upper test when
    ``hi`` is None).  Otherwise the code is NULL but the row is kept.
    """

    code: int
    name: str
    items: tuple[int, ...]
    lo: float
    hi: float | None
    hi_inclusive: bool = False
    agg: str = "avg"


@dataclass(frozen=True)
class LabRule:
    label: str          # label the item maps to
    items: tuple[int, ...]
    limit: float        # value above this -> NULL (row kept)
    column: str | None  # output column of the hourly lab table (None: not output)
    raw_column: str     # column name in the hospital-level lab table


# ----------------------------------------------------------------------------
# FIXED VALUES (must equal the reference)
# ----------------------------------------------------------------------------

# Vital concepts, 10-code version.  Bounds are open unless marked inclusive.
VITALS_10: tuple[VitalRule, ...] = (
    VitalRule(1, "heart_rate", (211, 220045), 0, 300),
    VitalRule(2, "abp_sys", (51, 442, 455, 6701, 220179, 220050), 0, 400),
    VitalRule(3, "abp_dia", (8368, 8440, 8441, 8555, 220180, 220051), 0, 300),
    VitalRule(4, "abp_mean", (456, 52, 6702, 443, 220052, 220181, 225312), 0, 300),
    VitalRule(5, "cardiac_output", (45037, 227543, 228178, 228370, 40909, 41946,
                                     41717, 44970, 224842, 228369, 220088, 44920), 0, 15),
    VitalRule(6, "cvp", (113, 220074, 1103), 0, 35),
    VitalRule(7, "respiratory_rate", (615, 618, 220210, 224690), 0, 70),
    VitalRule(8, "temperature", (223761, 678), 70, 120),   # Fahrenheit items, raw value
    VitalRule(8, "temperature", (223762, 676), 10, 50),    # Celsius items
    VitalRule(9, "spo2", (646, 220277), 0, 100, hi_inclusive=True),
    VitalRule(10, "glucose", (807, 811, 1529, 3745, 3744, 225664, 220621, 226537), 0, None),
)

# Vital concepts, older 8-code version (no cardiac output / CVP); SpO2 and
# glucose are aggregated by MIN.
VITALS_8: tuple[VitalRule, ...] = (
    VitalRule(1, "heart_rate", (211, 220045), 0, 300),
    VitalRule(2, "abp_sys", (51, 442, 455, 6701, 220179, 220050), 0, 400),
    VitalRule(3, "abp_dia", (8368, 8440, 8441, 8555, 220180, 220051), 0, 300),
    VitalRule(4, "abp_mean", (456, 52, 6702, 443, 220052, 220181, 225312), 0, 300),
    VitalRule(5, "respiratory_rate", (615, 618, 220210, 224690), 0, 70),
    VitalRule(6, "temperature", (223761, 678), 70, 120),
    VitalRule(6, "temperature", (223762, 676), 10, 50),
    VitalRule(7, "spo2", (646, 220277), 0, 100, hi_inclusive=True, agg="min"),
    VitalRule(8, "glucose", (807, 811, 1529, 3745, 3744, 225664, 220621, 226537), 0, None, agg="min"),
)

# Fahrenheit temperature items: converted with (v - 32) / 1.8.
FAHRENHEIT_ITEMS: tuple[int, ...] = (223761, 678)

# Lab items -> label, upper plausibility limit, output column names.
LABS: tuple[LabRule, ...] = (
    LabRule("ANION GAP", (50868,), 10000, "aniongap", "aniongap"),
    LabRule("ALBUMIN", (50862,), 10, "albumin", "albumin"),
    LabRule("BANDS", (51144,), 100, None, "bands"),
    LabRule("BICARBONATE", (50882,), 10000, "bicarbonate", "bicarbonate"),
    LabRule("BILIRUBIN", (50885,), 150, "bilirubin", "bilirubin"),
    LabRule("CREATININE", (50912,), 150, "creatinine", "creatinine"),
    LabRule("CHLORIDE", (50902,), 10000, "chloride", "chloride"),
    LabRule("GLUCOSE", (50931,), 10000, "glucose", "glucose"),
    LabRule("HEMATOCRIT", (51221,), 100, "hematocrit", "hematocrit"),
    LabRule("HEMOGLOBIN", (51222,), 50, "hemoglobin", "hemoglobin"),
    LabRule("LACTATE", (50813,), 50, "lactate", "lactate"),
    LabRule("PLATELET", (51265,), 10000, "platelet_count", "platelet"),
    LabRule("POTASSIUM", (50971,), 30, "potassium", "potassium"),
    LabRule("PTT", (51275,), 150, "ptt", "ptt"),
    LabRule("INR", (51237,), 50, "inr", "inr"),
    LabRule("PT", (51274,), 150, "pt", "pt"),
    LabRule("SODIUM", (50983,), 200, "sodium", "sodium"),
    LabRule("BUN", (51006,), 300, "urea", "bun"),
    LabRule("WBC", (51300, 51301), 1000, "white_cell_count", "wbc"),
    LabRule("AST", (50878,), 100000, "ast", "ast"),
    LabRule("ALT", (50861,), 100000, "alt", "alt"),
    LabRule("ALP", (50863,), 100000, "alp", "alp"),
    LabRule("GGT", (50927,), 100000, "ggt", "ggt"),
    LabRule("CALCIUM", (50893,), 100000, "calcium", "calcium"),
    LabRule("MAGNESIUM", (50960,), 100000, "magnesium", "magnesium"),
    LabRule("PHOSPHATE", (50970,), 100000, "phosphate", "phosphate"),
)

# Output column order of the hourly lab table.
LAB_OUTPUT_ORDER: tuple[str, ...] = (
    "hemoglobin", "hematocrit", "white_cell_count", "platelet_count", "sodium",
    "potassium", "chloride", "bicarbonate", "urea", "creatinine", "aniongap",
    "lactate", "ast", "alt", "alp", "ggt", "albumin", "bilirubin", "calcium",
    "magnesium", "phosphate", "inr", "pt", "ptt", "glucose",
)

# Columns (after hadm_id) of the hospital-level lab table, in order.
ADMISSION_LAB_COLUMNS: tuple[str, ...] = (
    "hr", "aniongap", "albumin", "bands", "bicarbonate", "bilirubin", "creatinine",
    "chloride", "glucose", "hematocrit", "hemoglobin", "lactate", "platelet",
    "potassium", "ptt", "inr", "pt", "sodium", "bun", "wbc",
)

# Fluid inputs (CareVue), split by item set; total counts unit 'ml' only.
INPUT_SETS: tuple[tuple[str, tuple[int, ...]], ...] = (
    ("in_saline", (30018, 30020, 30143, 30160, 30168, 30353, 30352, 30296, 30321, 30186, 30185)),
    ("in_csl", (30021, 30159)),
    ("in_albumin", (30009, 30008)),
    ("in_starch", (30011, 30012)),
)

# Urine output items, current list (14 items).
URINE_14: tuple[int, ...] = (40055, 43175, 40069, 40094, 40715, 40473, 40085,
                             40057, 40056, 40405, 40428, 40086, 40096, 40651)
# Urine output items, older list (11 items).
URINE_11: tuple[int, ...] = (50055, 50056, 50057, 50069, 50085, 50096,
                             40405, 40428, 40473, 40651, 40715)

# Unit string that counts towards fluid totals (exact, case-sensitive).
TOTAL_UNIT = "ml"

# Hospital-level lab column -> output name, in output order
LAB_RENAMES = (
    ("hemoglobin", "haemoglobin"), ("hematocrit", "haematocrit"), ("wbc", "white_cell_count"),
    ("platelet", "platelet_count"), ("sodium", "sodium"), ("potassium", "potassium"),
    ("chloride", "chlorine"), ("bun", "urea"), ("bicarbonate", "bicarbonate"),
    ("creatinine", "creatinine"), ("lactate", "lactate"), ("aniongap", "aniongap"),
    ("albumin", "albumin"), ("bilirubin", "bilirubin"), ("inr", "inr"), ("pt", "pt"), ("ptt", "ptt"),
    ("glucose", "glucose_lab"), ("bands", "bands"),
)

# ----------------------------------------------------------------------------
# end of fixed values
# ----------------------------------------------------------------------------


def vital_items(rules: tuple[VitalRule, ...]) -> list[int]:
    """Every item of a concept spec, in spec order, without duplicates."""
    out: list[int] = []
    for r in rules:
        out.extend(i for i in r.items if i not in out)
    return out


def vital_measures(rules: tuple[VitalRule, ...]) -> list[tuple[int, str, str]]:
    """(code, output name, aggregate) per distinct code, in code order."""
    seen: dict[int, tuple[int, str, str]] = {}
    for r in rules:
        seen.setdefault(r.code, (r.code, r.name, r.agg))
    return [seen[k] for k in sorted(seen)]


def lab_items() -> list[int]:
    return [i for r in LABS for i in r.items]


def _sql_in(items) -> str:
    return "(" + ", ".join(str(int(i)) for i in items) + ")"


def _gate_sql(v: str, r: VitalRule) -> str:
    cond = f"{v} > {float(r.lo)!r}"
    if r.hi is not None:
        cond += f" AND {v} {'<=' if r.hi_inclusive else '<'} {float(r.hi)!r}"
    return cond


# The builders below render one SQL expression per rule set and hand it to
# the JVM in a single call: building the same CASE tree literal by literal
# through the Python API costs thousands of gateway round trips per query.

def concept_code(item: str, value: str, rules: tuple[VitalRule, ...]) -> Column:
    """Item + plausibility gate -> concept code (int); NULL when no branch fires."""
    branches = " ".join(f"WHEN {item} IN {_sql_in(r.items)} AND {_gate_sql(value, r)} THEN {r.code}"
                        for r in rules)
    return F.expr(f"CAST(CASE {branches} END AS INT)")


def to_celsius(item: str, value: str) -> Column:
    """Fahrenheit items converted to Celsius; other values unchanged."""
    return F.expr(f"CASE WHEN {item} IN {_sql_in(FAHRENHEIT_ITEMS)} THEN ({value} - 32D) / 1.8D "
                  f"ELSE {value} END")


def lab_label(item: str) -> Column:
    """Lab item -> label text; NULL for unlisted items."""
    branches = " ".join(f"WHEN {item} IN {_sql_in(r.items)} THEN '{r.label}'" for r in LABS)
    return F.expr(f"CASE {branches} END")


def null_implausible_lab(item: str, value: str) -> Column:
    """Lab value above its item's limit -> NULL; the row itself is kept."""
    branches = " ".join(f"WHEN {item} IN {_sql_in(r.items)} AND {value} > {float(r.limit)!r} "
                        f"THEN CAST(NULL AS DOUBLE)" for r in LABS)
    return F.expr(f"CASE {branches} ELSE {value} END")


def item_in(item: str, items) -> Column:
    """Membership test against a fixed item list."""
    return F.expr(f"{item} IN {_sql_in(items)}")
