"""Write PLANS.md: compact physical plans of the main jobs over stored base tables.

usage: python tools/plans.py [sf_dir] [out.md]
The eight clinical tables are derived once from ``events`` and written as
Parquet to a fresh /tmp folder, then each job is planned over ``read_table``
scans twice: with the defaults, and without broadcast joins, as with large stay
tables.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hourgrid.operators import features as FE  # noqa: E402
from hourgrid.plans import summary as SU  # noqa: E402
from hourgrid.plans import variants as VA  # noqa: E402
from hourgrid.session import local_session  # noqa: E402
from hourgrid.sources.proxy import load_proxy  # noqa: E402
from hourgrid.sources.tables import TABLES, read_table, write_feature  # noqa: E402

KEEP = ("Exchange", "Join", "Scan", "HashAggregate", "Window", "Generate", "Sort", "TakeOrdered",
        "Limit", "Expand", "Union")


def _walk(node, depth: int, out: list[str]) -> None:
    """Physical tree from the plan API: descend through adaptive plans and
    query stages, stop at cached-table scans and reused exchanges."""
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        _walk(node.executedPlan(), depth, out)
        return
    if name.endswith("QueryStage") or name in ("ShuffleQueryStage", "BroadcastQueryStage", "TableCacheQueryStage"):
        _walk(node.plan(), depth, out)
        return
    text = re.sub(r"#\d+L?", "", node.simpleString(25))
    text = re.sub(r"functions=\[[^\]]{80,}\]", "functions=[...]", text)
    shown = any(k in name for k in KEEP) or name.startswith("InMemoryTableScan")
    if shown:
        out.append("  " * depth + "- " + text[:170])
    if name.startswith("InMemoryTableScan") or name.startswith("Reused"):
        return
    children = node.children()
    for i in range(children.size()):
        _walk(children.apply(i), depth + (1 if shown else 0), out)


def compact(df) -> str:
    out: list[str] = []
    _walk(df._jdf.queryExecution().executedPlan(), 0, out)
    return "\n".join(out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out_md = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    spark = local_session(8, extra={"spark.sql.maxMetadataStringLength": "300"})
    base = tempfile.mkdtemp(prefix="plans-", dir="/tmp")
    proxy = load_proxy(spark, sf_dir)
    for name in TABLES:
        write_feature(getattr(proxy, name), f"{base}/{name}")
    t = {name: read_table(spark, base, name) for name in TABLES}

    jobs = {
        "vitals_hourly": lambda: FE.vitals_hourly(t["icustays"], t["chartevents"]),
        "labs_hourly": lambda: FE.labs_hourly(t["icustays"], t["labevents"]),
        "inputs_hourly": lambda: FE.inputs_hourly(t["icustays"], t["inputevents_cv"]),
        "hourly_summary": lambda: SU.hourly_summary(
            t["icustays"], t["admissions"], t["patients"], FE.vitals_hourly(t["icustays"], t["chartevents"]),
            FE.labs_hourly(t["icustays"], t["labevents"]), FE.inputs_hourly(t["icustays"], t["inputevents_cv"]),
            FE.outputs_hourly(t["icustays"], t["outputevents"])),
        "vitals_with_admission_labs_top100": lambda: VA.vitals_with_admission_labs(
            t["icustays"], t["chartevents"], t["admissions"], t["patients"],
            t["labevents"], limit=100),
    }
    large = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    parts = ["# Physical plans (compact)\n",
             "Generated by `tools/plans.py` over Parquet base tables (derived once from sf0.01 events). ",
             "Only exchanges, joins, scans, aggregates, windows, generators, sorts and limits are kept; ",
             "a scan of `hourgrid-...` reads a table that the job has stored in the shared folder.\n"]
    for mode, conf in (("defaults", {}), ("no broadcast joins", large)):
        for k, v in conf.items():
            spark.conf.set(k, v)
        parts.append(f"\n## {mode}\n")
        for name, build in jobs.items():
            spark.catalog.clearCache()
            df = build()
            df.write.format("noop").mode("overwrite").save()
            parts.append(f"\n### {name}\n\n```\n{compact(df)}\n```\n")
        for k in conf:
            spark.conf.unset(k)
    with open(out_md, "w") as f:
        f.write("".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
