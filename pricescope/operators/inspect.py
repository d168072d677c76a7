"""Cookbook queries over the stored tables (C1-C16) and retention (K7).

These are the ad-hoc inspection queries of the operations guide, as
DataFrame plans: top-k listings, JSON field extraction, stale-row and
failed-run checks, time series of one key, table statistics.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricescope.functions.exprs import epoch_micros, hours, ts_lit
from pricescope.constants import RAW_FIELDS
from pricescope.operators import lookback as lb
from pricescope.operators.ranked import top


def recent_markets(state: DataFrame, limit: int = 50) -> DataFrame:
    """Current markets, most recently updated first."""
    return top(state, limit, F.col("updated_at").desc_nulls_last(), F.col("market_ticker")).select(
        "market_ticker", "series_ticker", "title", "status", "yes_bid", "yes_ask", "no_bid", "no_ask",
        "volume", "open_interest", "updated_at")


def market_by_key(state: DataFrame, key: str, key_col: str = "market_ticker") -> DataFrame:
    """One market by key (all columns)."""
    return state.where(F.col(key_col) == key).drop("snap_date")


def raw_pretty(state: DataFrame, key: str, key_col: str = "market_ticker") -> DataFrame:
    """The raw document of one market, indented.  Nested values are
    rendered as JSON text inside the top-level object."""
    m = F.from_json(F.col("raw"), "map<string,string>")
    return market_by_key(state, key, key_col).select(
        key_col, F.to_json(m, {"pretty": "true"}).alias("raw_pretty"))


def random_sample(state: DataFrame, n: int = 3, seed: int = 7, key_col: str = "market_ticker") -> DataFrame:
    """``n`` markets drawn by a seeded hash of the key: a bounded
    TakeOrderedAndProject whose draw does not change with the partitioning."""
    drawn = state.withColumn("_r", F.md5(F.concat(F.col(key_col), F.lit(str(seed)))))
    return top(drawn, n, F.col("_r"), F.col(key_col)).select(
        key_col, F.col("raw").alias("raw"))


def raw_fields(state: DataFrame, fields: list[str] = RAW_FIELDS, limit: int = 50) -> DataFrame:
    """C4: fields pulled out of the raw JSON of active markets, newest first."""
    d = state.where(F.col("status") == "active")
    cols = [F.get_json_object(F.col("raw"), f"$.{f}").alias(f) for f in fields]
    return top(d.select("market_ticker", "updated_at", *cols), limit,
               F.col("updated_at").desc_nulls_last(), F.col("market_ticker")).drop("updated_at")


def distinct_events(state: DataFrame, limit: int = 100) -> DataFrame:
    """Distinct event tickers from raw, ordered."""
    ev = F.get_json_object(F.col("raw"), "$.event_ticker")
    d = state.select(ev.alias("event_ticker")).where(F.col("event_ticker").isNotNull()).distinct()
    return top(d, limit, F.col("event_ticker"))


def null_keys(state: DataFrame, key_col: str = "market_ticker") -> DataFrame:
    """Rows with a null key (should be empty)."""
    return state.where(F.col(key_col).isNull())


def stale_markets(state: DataFrame, as_of, max_age_hours: int = 24, limit: int = 50) -> DataFrame:
    """Rows not updated for longer than ``max_age_hours``, oldest first,
    with their age in hours."""
    d = state.where(F.col("updated_at") < ts_lit(as_of) - hours(max_age_hours))
    age = (epoch_micros(ts_lit(as_of)) - epoch_micros(F.col("updated_at"))).cast("double") / 3.6e9
    return top(d.select("market_ticker", "updated_at", F.round(age, 6).alias("age_hours")), limit,
               F.col("updated_at").asc(), F.col("market_ticker"))


def latest_globals(glob: DataFrame, limit: int = 50) -> DataFrame:
    """The newest global snapshots."""
    return top(glob, limit, F.col("snap_ts").desc()).select(
        "snap_ts", "run_id", "n_active", "n_priced", "total_volume", "total_open_interest",
        "avg_spread_ticks", "n_wide_spread")


def oi_change(glob: DataFrame, lookback_hours: int = 24) -> DataFrame:
    """Change of total open interest between the latest global snapshot
    and the newest one at least ``lookback_hours`` older (no fallback; no
    row when there is none).  One pass over the global table with the two
    times as scalar subqueries -- no join."""
    latest = glob.agg(F.max("snap_ts")).scalar()
    prev = glob.where(F.col("snap_ts") <= latest - hours(lookback_hours)).agg(F.max("snap_ts")).scalar()
    d = glob.where((F.col("snap_ts") == latest) | (F.col("snap_ts") == prev))
    is_now, is_prev = F.col("snap_ts") == latest, F.col("snap_ts") == prev
    g = d.agg(F.max(F.when(is_now, F.col("snap_ts"))).alias("t_now"),
              F.max(F.when(is_prev, F.col("snap_ts"))).alias("t_prev"),
              F.max_by(F.col("total_open_interest"), F.when(is_now, F.col("run_id"))).alias("_oi_now"),
              F.max_by(F.col("total_open_interest"), F.when(is_prev, F.col("run_id"))).alias("_oi_prev"))
    return g.where(F.col("t_now").isNotNull() & F.col("t_prev").isNotNull()).select(
        "t_now", "t_prev", (F.col("_oi_now") - F.col("_oi_prev")).alias("delta_oi"))


def event_series(series: DataFrame, event: str, limit: int = 100) -> DataFrame:
    """C11: recent snapshots of one event, newest first."""
    d = series.where(F.col("series_ticker") == event).select(
        "snap_ts", "series_ticker", "n_markets", "total_volume", "total_open_interest", "avg_spread_ticks")
    return top(d, limit, F.col("snap_ts").desc())


def market_series(snaps: DataFrame, key: str, key_col: str = "market_ticker") -> DataFrame:
    """C11: the full time series of one market, ascending."""
    return snaps.where(F.col(key_col) == key).select(
        "snap_ts", "yes_bid", "yes_ask", "mid", "volume", "open_interest").orderBy("snap_ts")


def widest_spreads(snaps: DataFrame, limit: int = 50, times: DataFrame | None = None) -> DataFrame:
    """Widest spreads at the latest snapshot (Postgres DESC: nulls first)."""
    d = lb.latest_rows(snaps, times).select(
        "market_ticker", "snap_ts", "spread_ticks", "mid", "volume", "open_interest")
    return top(d, limit, F.col("spread_ticks").desc_nulls_first(), F.col("market_ticker"))


def history_stats(df: DataFrame, ts_col: str = "snap_ts") -> DataFrame:
    """C14: row count and first / last snapshot time of a history table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(ts_col).alias("first_snap"),
                  F.max(ts_col).alias("last_snap"))


def recent_ingest(log: DataFrame, limit: int = 50) -> DataFrame:
    """Newest ingest events."""
    return top(log, limit, F.col("ts_utc").desc(), F.col("id").desc()).select(
        "id", "ts_utc", "source", "host", "note")


def ingest_counts(log: DataFrame, as_of, lookback_hours: int = 24) -> DataFrame:
    """Events per source in the last ``lookback_hours``."""
    d = log.where(F.col("ts_utc") >= ts_lit(as_of) - hours(lookback_hours))
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("n_events")).orderBy(
        F.col("n_events").desc(), F.col("source"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Live row count per table (one aggregate per table, unioned)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


# ----------------------------------------------------------------- K7
from pricescope.constants import RETENTION_DAYS  # noqa: E402


def retain(df: DataFrame, ts_col: str, as_of, days: int) -> DataFrame:
    """K7: the rows kept by a retention of ``days`` before ``as_of``.  On
    date-partitioned tables the predicate on the partition column prunes
    whole directories, so rewriting the kept data (or dropping the expired
    partitions it names) never scans the expired ones."""
    cut = ts_lit(as_of) - F.make_dt_interval(days=F.lit(int(days)))
    if "snap_date" in df.columns:
        df = df.where(F.col("snap_date") >= F.to_date(cut))
    return df.where(F.col(ts_col) >= cut).drop("snap_date")


def expired_partitions(df: DataFrame, ts_col: str, as_of, days: int) -> DataFrame:
    """K7: the snapshot dates that a retention drops whole.  The date the cut falls into still holds
    kept rows and is not among them."""
    cut = F.to_date(ts_lit(as_of) - F.make_dt_interval(days=F.lit(int(days))))
    # A partition value needs no file of its date to be opened.
    date = F.col("snap_date") if "snap_date" in df.columns else F.to_date(F.col(ts_col))
    return df.select(date.alias("snap_date")).where(F.col("snap_date") < cut).distinct().orderBy("snap_date")


def housekeeping(market_snaps: DataFrame, series_snaps: DataFrame, runs: DataFrame, as_of,
                 days: dict | None = None) -> dict[str, DataFrame]:
    """K7, the guide's three retentions at once (90 d market snapshots,
    30 d series snapshots, 365 d runs by default): the kept rows of each."""
    d = dict(RETENTION_DAYS, **(days or {}))
    return {"market_snapshots": retain(market_snaps, "snap_ts", as_of, d["market_snapshots"]),
            "series_snapshots": retain(series_snaps, "snap_ts", as_of, d["series_snapshots"]),
            "export_runs": retain(runs, "started_at", as_of, d["export_runs"])}
