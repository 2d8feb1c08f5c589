import datetime as dt
import math

from hourgrid.sources.tables import SCHEMAS

T0 = dt.datetime(2024, 1, 1, 8, 0, 0)


def at(hours=0.0, minutes=0.0, micros=0):
    return T0 + dt.timedelta(hours=hours, minutes=minutes, microseconds=micros)


def table(spark, name, rows):
    return spark.createDataFrame(rows, SCHEMAS[name])


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    return v


def rows_of(df, cols=None):
    cols = cols or df.columns
    return sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)


def canon(rows):
    return sorted((tuple(norm(x) for x in r) for r in rows), key=repr)


__all__ = ["T0", "at", "table", "rows_of", "canon"]
