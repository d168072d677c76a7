"""Global realised-volatility index (T16 tick, P15 prob).

For the newest ``points + 1`` snapshot times, every consecutive pair
(cur, prev) contributes the weighted mean of squared log-odds returns of
markets present in both, with weight (open interest or liquidity) of the
current row >= ``min_weight`` and both prices strictly inside (0.01, 0.99)
after dividing by ``price_scale``.  rv is annualised with the pair spacing:
vol_index = 100 * sqrt(rv * 8760 / dt_hours); points with null or
negative rv or non-positive spacing are dropped.

``price_scale``: the tick venue's mid is in cents while the reference's
filter is written for probabilities, so with the literal 1.0 almost no tick
market qualifies.  100.0 is the useful setting for the tick venue.

Plan: the time selection is a top-(points+1) over distinct times -- at
most 201 rows, a proven bound -- so it is broadcast as a semi-join filter
into the snapshot scan; per market ``lag`` over the dense time index finds
the previous global time (a window partition holds at most 201 rows per
market); the per-time aggregate is a partial + final hash aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricescope.functions.exprs import hours_between, log_odds
from pricescope.venues import Venue

from pricescope.constants import (HOURS_PER_YEAR, VOL_INDEX_SCALE, VOL_PRICE_HIGH,  # noqa: E402
                                  VOL_PRICE_LOW)


def vol_index(snaps: DataFrame, venue: Venue, points: int = 50, min_weight: float = 100.0,
              price_scale: float = 1.0, times: DataFrame | None = None) -> DataFrame:
    from pricescope.operators.lookback import snapshot_times
    points = max(1, int(points))
    min_w = max(0.0, float(min_weight))
    times = snapshot_times(snaps, times).orderBy(F.col("snap_ts").desc()).limit(points + 1)
    times = times.withColumn("i", F.row_number().over(Window.orderBy("snap_ts")))
    w = Window.partitionBy(venue.key).orderBy("i")
    p = F.col(venue.price) / float(price_scale)
    if "snap_date" in snaps.columns:
        # prune to the dates of the selected times (scalar subquery bound)
        snaps = snaps.where(F.col("snap_date") >= F.to_date(times.agg(F.min("snap_ts")).scalar()))
    rows = (snaps.select("snap_ts", venue.key, p.alias("px"), F.col(venue.weight).alias("w"))
            .join(F.broadcast(times), "snap_ts")
            .withColumn("prev_px", F.lag("px").over(w))
            .withColumn("prev_i", F.lag("i").over(w))
            .withColumn("prev_ts", F.lag("snap_ts").over(w)))
    inside = lambda c: (c > VOL_PRICE_LOW) & (c < VOL_PRICE_HIGH)
    rows = rows.where((F.col("prev_i") == F.col("i") - 1) & (F.col("w") >= min_w)
                      & inside(F.col("px")) & inside(F.col("prev_px")))
    rows = rows.withColumn("dt_hours", hours_between(F.col("prev_ts"), F.col("snap_ts")))
    rows = rows.where(F.col("dt_hours") > 0)
    r = log_odds(F.col("px")) - log_odds(F.col("prev_px"))
    stats = rows.groupBy("snap_ts", "dt_hours").agg(
        (F.sum(F.col("w") * r * r) / F.when(F.sum("w") != 0, F.sum("w"))).alias("rv"))
    stats = top_n(stats, points)
    stats = stats.where(F.col("rv").isNotNull() & (F.col("rv") >= 0) & (F.col("dt_hours") > 0))
    ann = F.col("rv") * (HOURS_PER_YEAR / F.col("dt_hours"))
    return stats.select(
        "snap_ts", F.round("dt_hours", 6).alias("dt_hours"),
        F.round("rv", 10).alias("realised_variance"),
        F.round(F.when(ann > 0, VOL_INDEX_SCALE * F.sqrt(ann)).otherwise(0.0), 4).alias("vol_index")
    ).orderBy(F.col("snap_ts").desc())


def top_n(df: DataFrame, n: int) -> DataFrame:
    return df.orderBy(F.col("snap_ts").desc()).limit(n)
