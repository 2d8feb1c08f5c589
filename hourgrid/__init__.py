"""hourgrid: hourly ICU feature tables on Spark DataFrames.

Sub-packages: ``functions`` (time bins, concept dictionaries), ``sources``
(base-table readers, proxy tables, feature sink), ``operators`` (feature
jobs, hourly cohort, stay attributes, ventilation flag), ``plans`` (skew-safe
joins, distributed numbering, summary and variant jobs), ``streaming``
(nothing: the reference has no streaming work).
"""

__all__ = ["functions", "sources", "operators", "plans"]
