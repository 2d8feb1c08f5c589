"""The item codes, limits and units, pinned independently of the dictionaries.

Spark side and oracle render from the same dictionaries, so a wrong code there
would pass every comparison; these literals would not.
"""

from hourgrid.functions import concepts as C

# Fixed values.
VITAL_ITEMS = {
    "heart_rate": {211, 220045}, "abp_sys": {51, 442, 455, 6701, 220050, 220179}, "abp_dia": {8368, 8440, 8441, 8555, 220051, 220180},
    "abp_mean": {52, 443, 456, 6702, 220052, 220181, 225312}, "respiratory_rate": {615, 618, 220210, 224690},
    "temperature": {676, 678, 223761, 223762}, "spo2": {646, 220277},
    "glucose": {807, 811, 1529, 3744, 3745, 220621, 225664, 226537},
    "cardiac_output": {40909, 41717, 41946, 44920, 44970, 45037, 220088, 224842, 227543, 228178, 228369, 228370},
    "cvp": {113, 1103, 220074},
}
VITAL_BOUNDS = {"heart_rate": (0, 300), "abp_sys": (0, 400), "abp_dia": (0, 300), "abp_mean": (0, 300), "respiratory_rate": (0, 70),
                "spo2": (0, 100), "glucose": (0, None), "cardiac_output": (0, 15), "cvp": (0, 35)}
LAB_LIMITS = {
    50868: ("ANION GAP", 10000), 50862: ("ALBUMIN", 10), 51144: ("BANDS", 100), 50882: ("BICARBONATE", 10000), 50885: ("BILIRUBIN", 150),
    50912: ("CREATININE", 150), 50902: ("CHLORIDE", 10000), 50931: ("GLUCOSE", 10000), 51221: ("HEMATOCRIT", 100), 51222: ("HEMOGLOBIN", 50),
    50813: ("LACTATE", 50), 51265: ("PLATELET", 10000), 50971: ("POTASSIUM", 30), 51275: ("PTT", 150), 51237: ("INR", 50), 51274: ("PT", 150),
    50983: ("SODIUM", 200), 51006: ("BUN", 300), 51300: ("WBC", 1000), 51301: ("WBC", 1000), 50878: ("AST", 100000), 50861: ("ALT", 100000),
    50863: ("ALP", 100000), 50927: ("GGT", 100000), 50893: ("CALCIUM", 100000), 50960: ("MAGNESIUM", 100000), 50970: ("PHOSPHATE", 100000),
}
INPUTS = {"in_saline": {30018, 30020, 30143, 30160, 30168, 30185, 30186, 30296, 30321, 30352, 30353}, "in_csl": {30021, 30159},
          "in_albumin": {30008, 30009}, "in_starch": {30011, 30012}}
URINE_NOW = {40055, 40056, 40057, 40069, 40085, 40086, 40094, 40096, 40405, 40428, 40473, 40651, 40715, 43175}
URINE_OLDER = {40405, 40428, 40473, 40651, 40715, 50055, 50056, 50057, 50069, 50085, 50096}


def test_vitals():
    for rules, absent in ((C.VITALS_10, set()), (C.VITALS_8, {"cardiac_output", "cvp"})):
        items = {}
        for r in rules:
            items.setdefault(r.name, set()).update(r.items)
            if r.name == "temperature":
                assert (r.lo, r.hi) == ((70, 120) if set(r.items) == {678, 223761} else (10, 50))
            else:
                assert (r.lo, r.hi) == VITAL_BOUNDS[r.name]
            assert r.hi_inclusive == (r.name == "spo2")
        assert items == {k: v for k, v in VITAL_ITEMS.items() if k not in absent}
    assert {r.name for r in C.VITALS_8 if r.agg == "min"} == {"spo2", "glucose"} and all(r.agg == "avg" for r in C.VITALS_10)
    assert set(C.FAHRENHEIT_ITEMS) == {678, 223761}


def test_labs():
    assert {i: (r.label, r.limit) for r in C.LABS for i in r.items} == LAB_LIMITS
    assert [r.label for r in C.LABS if r.column is None] == ["BANDS"]


def test_fluids():
    assert {n: set(i) for n, i in C.INPUT_SETS} == INPUTS
    assert set(C.URINE_14) == URINE_NOW and set(C.URINE_11) == URINE_OLDER and C.TOTAL_UNIT == "ml"
