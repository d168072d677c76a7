"""Reusable column expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal from a datetime, ISO string or Column."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp_ntz")


def hours(n) -> Column:
    """A day-time interval of ``n`` hours (int or Column)."""
    return F.make_dt_interval(hours=n if isinstance(n, Column) else F.lit(int(n)))


def local_rows(spark, rows: list[tuple], schema: str):
    """A few driver-side rows as a local relation, which plans read without a job (``createDataFrame`` of a list
    makes an RDD)."""
    import pyarrow as pa
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema
    fields = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)
    cols = list(zip(*rows, strict=True)) or [[] for _ in arrow]
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow), fields)


def nullif(c: Column, v) -> Column:
    return F.when(c != F.lit(v), c)


def empty_to_null(c: Column) -> Column:
    """Empty string counts as missing (Python truthiness in the feeds)."""
    return F.when(c != F.lit(""), c)


def safe_div(num: Column, den: Column) -> Column:
    """num / nullif(den, 0): ANSI mode raises on x/0, this yields null."""
    return num / F.when(den != 0, den)


def event_from_raw(raw_col: str = "raw") -> Column:
    """``nullif(raw->>'event_ticker', '')`` on the JSON text column."""
    return empty_to_null(F.get_json_object(F.col(raw_col), "$.event_ticker"))


def epoch_micros(ts: Column) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ value.  The session
    zone is UTC, so the cast to TIMESTAMP reinterprets without shifting."""
    return F.unix_micros(ts.cast("timestamp"))


def hours_between(a: Column, b: Column) -> Column:
    """(b - a) in hours as double; works on TIMESTAMP_NTZ."""
    return (epoch_micros(b) - epoch_micros(a)).cast("double") / 3.6e9


def log_odds(p: Column) -> Column:
    return F.ln(p / (1 - p))


def clamp(v, lo=None, hi=None, cast=int):
    """Argument clamp at plan-build time (the reference clamps in Python)."""
    v = cast(v)
    if lo is not None:
        v = max(lo, v)
    if hi is not None:
        v = min(hi, v)
    return v
