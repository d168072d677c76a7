"""Move statistics M1 (tick venue) and M2 (probability venue), and their
keyed upsert K6.

Semantics kept from the reference:
* only snapshots with ``snap_ts > as_of - 7 days`` (strict);
* consecutive pairs are *global* neighbours over the distinct snapshot
  times -- a market absent (or unpriced) in either snapshot yields no
  move, so a gap does not bridge to an older row;
* the 24-hour part is relative to the latest snapshot (strict ``>``);
* volatility_score = std_24h / nullif(avg_24h, 0), from unrounded values.

Plan: the distinct times in the lookback (one row per run) get a dense
index ``i`` with an unpartitioned window -- that frame is tiny by
construction -- and are joined back (Spark broadcasts it at runtime when
small).  Per market, ``lag(price)`` and ``lag(i)`` over ``i``; a move exists
when ``lag(i) = i - 1``.  One shuffle by market key instead of the
reference's three-way self-join.  Rows per market are bounded by the
number of runs in 7 days, so a window partition never grows with data.
"""

from __future__ import annotations

import datetime as dt
from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricescope.functions.exprs import hours, local_rows, safe_div, ts_lit
from pricescope.venues import Venue

from pricescope.constants import MOVE_LOOKBACK_DAYS as LOOKBACK_DAYS  # noqa: E402
from pricescope.constants import MOVE_RECENT_HOURS, SCORE_DIGITS  # noqa: E402


def recent_rows(snaps: DataFrame, as_of, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Snapshot rows with ``snap_ts > as_of - lookback`` (strict).  On
    date-partitioned tables the matching ``snap_date`` bound prunes every
    older partition before any file is opened."""
    cut = ts_lit(as_of) - F.make_dt_interval(days=F.lit(lookback_days))
    if "snap_date" in snaps.columns:
        snaps = snaps.where(F.col("snap_date") >= F.to_date(cut))
    return snaps.where(F.col("snap_ts") > cut)


def moves(snaps: DataFrame, venue: Venue, as_of, lookback_days: int = LOOKBACK_DAYS,
          times: DataFrame | None = None) -> DataFrame:
    """Per (market, snapshot): abs price move from the previous global
    snapshot time, for markets priced at both.  ``times`` is the per-run
    times table, if there is one: it spares a scan for the times."""
    recent = recent_rows(snaps, as_of, lookback_days)
    times = (recent if times is None else recent_rows(times, as_of, lookback_days)).select("snap_ts").distinct()
    times = times.withColumn("i", F.row_number().over(Window.orderBy("snap_ts")))
    w = Window.partitionBy(venue.key).orderBy("i")
    # Prices are numeric in the reference: moves are exact decimal
    # differences, so averages round the same way whatever the sum order.
    # Unpriced rows go before the window; the index check sees the gap.
    x = (recent.select("snap_ts", venue.key, F.col(venue.price).cast("decimal(18,6)").alias("px"))
         .where("px is not null").join(times, "snap_ts")
         .withColumn("prev_px", F.lag("px").over(w))
         .withColumn("prev_i", F.lag("i").over(w)))
    return (x.where(F.col("prev_i") == F.col("i") - 1)
            .select("snap_ts", venue.key, F.abs(F.col("px") - F.col("prev_px")).alias("abs_move")))


def move_stats(snaps: DataFrame, venue: Venue, as_of, lookback_days: int = LOOKBACK_DAYS,
               times: DataFrame | None = None) -> DataFrame:
    """M1/M2: key, avg_move_24h, avg_move_7d, std_move_24h, volatility_score,
    updated_at (= as_of)."""
    recent = recent_rows(snaps, as_of, lookback_days)
    latest = (recent if times is None else recent_rows(times, as_of, lookback_days)).agg(F.max("snap_ts")).scalar()
    m = moves(snaps, venue, as_of, lookback_days, times)
    in_24h = F.col("snap_ts") > latest - hours(MOVE_RECENT_HOURS)
    g = m.groupBy(venue.key).agg(
        F.avg(F.when(in_24h, F.col("abs_move"))).alias("a24"),
        F.avg("abs_move").alias("a7"),
        F.stddev_samp(F.when(in_24h, F.col("abs_move"))).alias("s24"))
    return g.select(venue.key, *_rounded(venue.stat_digits), ts_lit(as_of).alias("updated_at"))


def stats_by_run(snaps: DataFrame, venue: Venue, runs: list, times: list, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """M1/M2 as of each of several runs: ``snap_ts`` (the run) and the columns of ``move_stats``.

    ``times`` are all snapshot times up to the last run (one a run), sorted.
    A market's step between neighbouring times counts for a run if both
    times are in its lookback, so each step goes to the runs of the
    following week among ``runs``; for one run that is each step once.
    """
    spark, day = snaps.sparkSession, dt.timedelta(days=1)
    near = [t for t in times if t > runs[0] - lookback_days * day] if runs else []
    order = local_rows(spark, list(zip(near, range(len(near)))), "snap_ts timestamp_ntz, i int")
    newest = [(r, times[i - 1]) for r in runs if (i := bisect_right(times, r))]
    asked = F.array(*[F.struct(F.lit(r).cast("timestamp_ntz").alias("run"), F.lit(t).cast("timestamp_ntz").alias("newest"))
                      for r, t in newest])
    if not near or not newest:
        return snaps.sparkSession.createDataFrame([], f"snap_ts timestamp_ntz, {venue.key} string, avg_move_24h double, "
                                                  "avg_move_7d double, std_move_24h double, volatility_score double, updated_at timestamp_ntz")
    w = Window.partitionBy(venue.key).orderBy("i")
    steps = (snaps.select("snap_ts", venue.key, F.col(venue.price).cast("decimal(18,6)").alias("px"))
             .where("px is not null").join(F.broadcast(order), "snap_ts")
             .withColumns({"prev_px": F.lag("px").over(w), "prev_i": F.lag("i").over(w), "prev_ts": F.lag("snap_ts").over(w)})
             .where(F.col("prev_i") == F.col("i") - 1))
    back = F.make_dt_interval(days=F.lit(lookback_days))
    for_run = F.filter(asked, lambda a: (a["run"] >= F.col("snap_ts")) & (F.col("prev_ts") > a["run"] - back))
    m = steps.select(venue.key, "snap_ts", F.abs(F.col("px") - F.col("prev_px")).alias("abs_move"), F.explode(for_run).alias("a"))
    recent = F.when(F.col("snap_ts") > F.col("a.newest") - hours(MOVE_RECENT_HOURS), F.col("abs_move"))
    g = m.groupBy(F.col("a.run").alias("snap_ts"), venue.key).agg(
        F.avg(recent).alias("a24"), F.avg("abs_move").alias("a7"), F.stddev_samp(recent).alias("s24"))
    return g.select("snap_ts", venue.key, *_rounded(venue.stat_digits), F.col("snap_ts").alias("updated_at"))


def _rounded(d: int) -> list:
    return [F.round("a24", d).cast("double").alias("avg_move_24h"),
            F.round("a7", d).cast("double").alias("avg_move_7d"),
            F.round("s24", d).cast("double").alias("std_move_24h"),
            F.round(safe_div(F.col("s24"), F.col("a24").cast("double")), SCORE_DIGITS).alias("volatility_score")]


def upsert_move_stats(existing: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """K6: fresh rows replace stored rows by key; stored keys without a
    fresh row stay as they were."""
    kept = existing.join(fresh.select(key), key, "left_anti")
    return kept.unionByName(fresh.select(*existing.columns))
