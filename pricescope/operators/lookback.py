"""Snapshot lookback: latest time, base-snapshot lookup (B) and the pair
operator that lines a market up at two snapshot times.

The reference's only as-of operation is B: the newest snapshot at or
before ``latest - h``, falling back to the newest one before ``latest``.
Both are uncorrelated scalar subqueries over the distinct snapshot times,
so Spark evaluates each once and pushes ``snap_ts = <subquery>`` into the
Parquet scan (partition pruning on date-partitioned tables).

The pair operator joins two single-snapshot scans on the market key.
Each side has at most one row per key (``(snap_ts, key)`` is unique), so no
key can be hot here, whatever its share of history; and a snapshot is
bounded per run, so AQE can broadcast it after checking its runtime size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricescope.functions.exprs import hours


def snapshot_times(snaps: DataFrame, times: DataFrame | None = None) -> DataFrame:
    """The distinct snapshot times.  ``times`` is the per-run times table
    the snapshot writer maintains (one row per snapshot time): reading it
    costs one row per run instead of the ``snap_ts`` column of every file
    of the history.  Without it the times are taken from the snapshots."""
    if times is not None:
        return times.select("snap_ts")
    return snaps.select("snap_ts").distinct()


def latest_ts(snaps: DataFrame, times: DataFrame | None = None) -> Column:
    """Scalar subquery: max(snap_ts)."""
    return snapshot_times(snaps, times).agg(F.max("snap_ts")).scalar()


def base_ts(snaps: DataFrame, lookback_hours: int, fallback: bool = True,
            times: DataFrame | None = None, latest: Column | None = None) -> Column:
    """B: newest snap_ts <= latest - h; else newest < latest; else null.
    ``fallback=False`` gives the cookbook's variant without the second step.
    Pass the caller's ``latest`` so one subquery serves the whole plan."""
    t = snapshot_times(snaps, times)
    latest = latest_ts(snaps, times) if latest is None else latest
    first = t.where(F.col("snap_ts") <= latest - hours(lookback_hours)).agg(F.max("snap_ts")).scalar()
    if not fallback:
        return first
    second = t.where(F.col("snap_ts") < latest).agg(F.max("snap_ts")).scalar()
    return F.coalesce(first, second)


def window_start_ts(snaps: DataFrame, window_hours: int = 24,
                    times: DataFrame | None = None, latest: Column | None = None) -> Column:
    """Base of the top-changes queries: the oldest snapshot inside
    [latest - window, latest] (possibly latest itself)."""
    latest = latest_ts(snaps, times) if latest is None else latest
    return (snapshot_times(snaps, times)
            .where((F.col("snap_ts") >= latest - hours(window_hours)) & (F.col("snap_ts") <= latest))
            .agg(F.min("snap_ts")).scalar())


def at_time(snaps: DataFrame, ts: Column) -> DataFrame:
    """Rows of one snapshot time.  On date-partitioned tables the same
    scalar subquery also filters ``snap_date``, which Spark evaluates
    before listing files, so only that date's directory is read."""
    d = snaps.where(F.col("snap_ts") == ts)
    if "snap_date" in snaps.columns:
        d = d.where(F.col("snap_date") == F.to_date(ts))
    return d


def pair(snaps: DataFrame, key: str, now_ts: Column, prev_ts: Column, cols: list[str]) -> DataFrame:
    """Rows present at both ``now_ts`` and ``prev_ts``: key plus
    ``<c>_now``/``<c>_prev`` for every column in ``cols``, plus the two times.

    An inner equi-join of two single-snapshot scans on the key.  A
    snapshot holds one row per picked market (bounded per run by the
    pick cap), so AQE broadcasts a side when its runtime size is under the
    broadcast threshold and falls back to a sort-merge join above it.
    ``now_ts`` may equal ``prev_ts`` (the top-changes base can be latest).
    """
    cur = at_time(snaps, now_ts).select(key, F.col("snap_ts").alias("snap_ts_now"),
                                        *[F.col(c).alias(f"{c}_now") for c in cols])
    prev = at_time(snaps, prev_ts).select(key, F.col("snap_ts").alias("snap_ts_prev"),
                                          *[F.col(c).alias(f"{c}_prev") for c in cols])
    out = [key, "snap_ts_now", "snap_ts_prev"]
    for c in cols:
        out += [f"{c}_now", f"{c}_prev"]
    return cur.join(prev, key, "inner").select(*out)


def latest_rows(snaps: DataFrame, times: DataFrame | None = None) -> DataFrame:
    """Rows of the latest snapshot (pushed down as ``snap_ts = subquery``)."""
    return at_time(snaps, latest_ts(snaps, times))


def base_table(snaps: DataFrame, hours_list: list[int], times: DataFrame | None = None) -> DataFrame:
    """B as a table: one row per lookback (lookback_hours, latest_ts,
    base_ts, used_fallback).  Aggregates the distinct times once; the
    latest time is a scalar subquery in the projection below."""
    t = snapshot_times(snaps, times).withColumn("_latest", latest_ts(snaps, times))
    ts, latest = F.col("snap_ts"), F.col("_latest")
    aggs = [F.max("_latest").alias("latest_ts"), F.max(F.when(ts < latest, ts)).alias("_prev")]
    for h in hours_list:
        aggs.append(F.max(F.when(ts <= latest - hours(h), ts)).alias(f"_b{h}"))
    g = t.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(int(h)).alias("lookback_hours"),
                              F.col("latest_ts").alias("latest_ts"),
                              F.coalesce(F.col(f"_b{h}"), F.col("_prev")).alias("base_ts"),
                              (F.col(f"_b{h}").isNull() & F.col("_prev").isNotNull()).alias("used_fallback"))
                     for h in hours_list])
    return g.select(F.inline(rows))
