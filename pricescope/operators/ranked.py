"""Ranked analytics over snapshots and current state.

Conventions
* Every top-k ends in ``orderBy(...).limit(k)`` -> TakeOrderedAndProject
  (per-partition top-k, then a merge of at most k x partitions rows).  A
  market-key tie-breaker is always the last sort key so results are
  deterministic.
* Display columns (title, question, category) are attached *after* the
  top-k: the key set is bounded by ``limit`` and broadcast as a semi-join
  filter into the current-state scan, so the full state table is never
  shuffled just to fetch names.
* The reference's scan-then-rank endpoints rank only the ``scan`` newest
  rows; ``scan=None`` (the registered form) ranks the whole table.
* Parameters are clamped at plan-build time exactly as the reference does.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricescope.functions.exprs import clamp, hours, hours_between, safe_div, ts_lit
from pricescope.operators import lookback as lb
from pricescope.constants import (HEAT_MIN_OPEN_INTEREST, INTEGER_METRICS, MOVERS_BASE_HOURS,
                                  SCREENER_SORT_PROB, SCREENER_SORT_TICK, SECOND_TERM_WEIGHT,
                                  TOP_CHANGE_METRICS)
from pricescope.venues import TICK, Venue


# ------------------------------------------------------------------ helpers
def top(df: DataFrame, limit: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(limit)


def attach(topk: DataFrame, dim: DataFrame, key: str, cols: list[str], order: list[Column],
           select: list) -> DataFrame:
    """Left-join display columns of ``dim`` onto an already-limited frame.
    The frame is broadcast (bounded by the limit) into the scan of ``dim``,
    so only matching dimension rows leave it, and then joined with what came
    back.  Its one exchange, of the same columns in both uses, is planned
    once and reused: the frame itself is evaluated once.  Nothing is cached:
    a call always sees the tables as they are."""
    topk = topk.repartition(1)
    names = topk.columns
    found = dim.select(key, *cols).join(F.broadcast(topk), key).select(*[F.col(c).alias(f"_{c}") for c in names], *cols)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names]
    return topk.join(F.broadcast(found), reduce(lambda a, b: a & b, same), "left").orderBy(*order).select(*select)


def _scan(state: DataFrame, scan: int | None, key: str) -> DataFrame:
    """The ``scan`` newest rows, or all of them for None."""
    if scan is None:
        return state
    return top(state, max(1, int(scan)), F.col("updated_at").desc_nulls_last(), F.col(key))


def _f(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


# ================================================================ tick venue
def export_runs(runs: DataFrame, limit: int = 20) -> DataFrame:
    """Most recent export runs."""
    return top(runs, clamp(limit, 1, 100), F.col("run_id").desc()).select(
        "run_id", "started_at", "finished_at", "source", "host", "n_markets", "note")


def failed_runs(runs: DataFrame) -> DataFrame:
    """Runs that never finished (finished_at null), newest first."""
    return runs.where(F.col("finished_at").isNull()).orderBy(F.col("run_id").desc()).select(
        "run_id", "started_at", "finished_at", "n_markets", "note")


def active_markets_tick(state: DataFrame, limit: int = 25) -> DataFrame:
    """Active markets with volume > 0, most recently updated first."""
    d = state.where((F.col("status") == "active") & (F.col("volume") > 0))
    return top(d, clamp(limit, 1, 100), F.col("updated_at").desc_nulls_last(),
               F.col("market_ticker")).select(
        "market_ticker", "title", "status", _f("volume").alias("volume"), "updated_at")


def tradability_tick(state: DataFrame, limit: int = 100, scan: int | None = None,
                     min_spread_ticks: int = 1) -> DataFrame:
    """(ln(1+volume) + 0.7 ln(1+OI)) / spread over priced active rows,
    ranked on the score rounded to 4 digits, spread >= min_spread_ticks."""
    limit = clamp(limit, 1, 200)
    min_spread = max(1, int(min_spread_ticks))
    d = state.where((F.col("status") == "active") & F.col("yes_bid").isNotNull()
                    & F.col("yes_ask").isNotNull())
    d = _scan(d, scan, "market_ticker")
    vol, oi = F.coalesce(F.col("volume"), F.lit(0)), F.coalesce(F.col("open_interest"), F.lit(0))
    spread = F.col("yes_ask") - F.col("yes_bid")
    d = d.where(spread >= min_spread).select(
        "market_ticker", "title", _f(vol).alias("volume"), _f(oi).alias("open_interest"),
        _f("yes_bid").alias("yes_bid"), _f("yes_ask").alias("yes_ask"),
        _f(spread).alias("spread_ticks"),
        F.round((F.log1p(vol) + SECOND_TERM_WEIGHT * F.log1p(oi)) / spread.cast("double"), 4).alias("tradability_score"),
        "updated_at")
    return top(d, limit, F.col("tradability_score").desc(), F.col("updated_at").desc_nulls_last(),
               F.col("market_ticker"))


def opportunity_gap_tick(state: DataFrame, limit: int = 20, scan: int | None = None) -> DataFrame:
    """T4: spread as % of bid (2 digits); bid and ask non-null, non-zero."""
    d = _scan(state.where(F.col("status") == "active"), scan, "market_ticker")
    bid, ask = F.col("yes_bid"), F.col("yes_ask")
    d = d.where(bid.isNotNull() & ask.isNotNull() & (bid != 0) & (ask != 0) & (bid > 0)).select(
        "market_ticker", "title", (ask - bid).alias("spread_points"),
        F.round((ask - bid) / bid.cast("double") * 100, 2).alias("spread_percentage"), "updated_at")
    return top(d, int(limit), F.col("spread_percentage").desc(), F.col("updated_at").desc_nulls_last(),
               F.col("market_ticker")).select("market_ticker", "title", "spread_points", "spread_percentage")


def market_heat_tick(state: DataFrame, limit: int = 200, scan: int | None = None) -> DataFrame:
    """T5: churn = volume / OI (2 digits) where OI > 100 and volume known."""
    d = _scan(state.where(F.col("status") == "active"), scan, "market_ticker")
    d = d.where((F.col("open_interest") > HEAT_MIN_OPEN_INTEREST) & F.col("volume").isNotNull()).select(
        "market_ticker", "title",
        F.round(F.col("volume").cast("double") / F.col("open_interest"), 2).alias("churn_rate"),
        "updated_at")
    return top(d, int(limit), F.col("churn_rate").desc(), F.col("updated_at").desc_nulls_last(),
               F.col("market_ticker")).select("market_ticker", "title", "churn_rate")


def screener_tick(state: DataFrame, limit: int = 50, scan: int | None = None, min_volume=None,
                  min_open_interest=None, max_spread_ticks=None,
                  sort_by: str = "tradability_score") -> DataFrame:
    """Optional volume / OI / spread predicates; score, churn (4 digits).
    A zero spread divides by 1.0; negative spreads are allowed.  Null churn
    sorts last (the reference fails on it)."""
    limit = clamp(limit, 1, 200)
    d = _scan(state.where(F.col("status") == "active"), scan, "market_ticker")
    bid, ask = F.col("yes_bid"), F.col("yes_ask")
    d = d.where(bid.isNotNull() & ask.isNotNull() & (bid > 0))
    vol = F.coalesce(F.col("volume"), F.lit(0)).cast("double")
    oi = F.coalesce(F.col("open_interest"), F.lit(0)).cast("double")
    spread = (ask - bid).cast("double")
    preds = []
    if min_volume is not None:
        preds.append(vol >= float(min_volume))
    if min_open_interest is not None:
        preds.append(oi >= float(min_open_interest))
    if max_spread_ticks is not None:
        preds.append(spread <= float(max_spread_ticks))
    for p in preds:
        d = d.where(p)
    d = d.select(
        "market_ticker", "title", vol.alias("volume"), oi.alias("open_interest"),
        bid.cast("double").alias("yes_bid"), ask.cast("double").alias("yes_ask"),
        spread.alias("spread_ticks"),
        F.round((F.log1p(vol) + SECOND_TERM_WEIGHT * F.log1p(oi)) / F.when(spread != 0, spread).otherwise(1.0), 4)
        .alias("tradability_score"),
        F.round(safe_div(vol, oi), 4).alias("churn_rate"),
        "updated_at")
    col, asc = SCREENER_SORT_TICK.get((sort_by or "tradability_score").lower(),
                                      ("tradability_score", False))
    first = F.col(col).asc_nulls_last() if asc else F.col(col).desc_nulls_last()
    return top(d, limit, first, F.col("updated_at").desc_nulls_last(), F.col("market_ticker"))


def _latest_of(df: DataFrame) -> DataFrame:
    """Rows of the latest snapshot; on date-partitioned tables the newest
    date, a partition value, bounds the search for the latest time."""
    if "snap_date" in df.columns:
        df = df.where(F.col("snap_date") == df.agg(F.max("snap_date")).scalar())
    return lb.latest_rows(df)


def _run_deltas(glob: DataFrame, cols: dict[str, str], limit: int) -> DataFrame:
    """Run-over-run differences of the newest ``limit`` runs: the window sees only limit + 1 rows."""
    from pyspark.sql import Window
    w = Window.orderBy("snap_ts")
    newest = top(glob, limit + 1, F.col("snap_ts").desc())
    g = newest.select("snap_ts", *[(F.col(c) - F.lag(c).over(w)).alias(a) for c, a in cols.items()],
                      F.lag("total_volume").over(w).alias("_pv"))
    return top(g.where(F.col("_pv").isNotNull()).drop("_pv"), limit, F.col("snap_ts").desc())


def top_events_tick(series: DataFrame, by: str = "total_open_interest", limit: int = 50) -> DataFrame:
    """T7 (by OI) / T8 (by volume) / C12: events at the latest series snapshot."""
    d = _latest_of(series).select(F.col("series_ticker").alias("event_ticker"), "n_markets",
                                  "total_volume", "total_open_interest", "avg_spread_ticks")
    return top(d, clamp(limit, 1, 200), F.col(by).desc_nulls_last(), F.col("event_ticker"))


def global_deltas_tick(glob: DataFrame, limit: int = 9) -> DataFrame:
    """Run-over-run deltas of the global snapshot (previous run, whatever
    the spacing)."""
    return _run_deltas(glob, {"total_volume": "d_volume_6h", "total_open_interest": "d_oi_6h",
                              "n_priced": "d_priced_6h", "avg_spread_ticks": "d_spread_6h",
                              "n_wide_spread": "d_wide_6h"}, clamp(limit, 1, 200))


# ------------------------------------------------------- pair-based, both venues
def _pair_cols(venue: Venue) -> list[str]:
    if venue is TICK:
        return ["mid", "volume", "open_interest", "spread_ticks", "series_ticker"]
    return ["outcome_yes_price", "volume", "liquidity", "volume_24hr", "event_id"]


def biggest_moves(snaps: DataFrame, state: DataFrame, stats: DataFrame, venue: Venue,
                  limit: int = 50, lookback_hours: int = 1, min_volume=0,
                  times: DataFrame | None = None) -> DataFrame:
    """Latest vs base snapshot (B); move_score = |move| /
    avg_move_24h (4 digits) when the baseline is positive; ordered by
    move_score desc nulls last, then |move| desc.

    Tick: ``volume >= min_volume`` drops null volume; prob: null volume
    counts as 0."""
    limit = clamp(limit, 1, 200)
    h = clamp(lookback_hours, 1, 168)
    key, px = venue.key, venue.price
    latest = lb.latest_ts(snaps, times)
    base = lb.base_ts(snaps, h, times=times, latest=latest)
    p = lb.pair(snaps, key, latest, base, _pair_cols(venue))
    p = p.where(F.col(f"{px}_now").isNotNull() & F.col(f"{px}_prev").isNotNull())
    if venue is TICK:
        p = p.where(F.col("volume_now") >= int(max(0, int(min_volume))))
    else:
        p = p.where(F.coalesce(F.col("volume_now"), F.lit(0.0)) >= max(0.0, float(min_volume)))
    move = F.col(f"{px}_now") - F.col(f"{px}_prev")
    j = p.join(stats.select(key, "avg_move_24h"), key, "left")
    avg = F.col("avg_move_24h")
    d = j.select(
        key, F.col(f"{px}_now").alias(venue.price_now), F.col(f"{px}_prev").alias(venue.price_prev),
        move.alias("move"), F.abs(move).alias("abs_move"),
        F.when(avg.isNotNull() & (avg > 0), F.round(F.abs(move) / avg, 4)).alias("move_score"),
        "avg_move_24h", F.col("volume_now").alias("volume"),
        *([F.col("open_interest_now").alias("open_interest"), F.col("spread_ticks_now").alias("spread_ticks")]
          if venue is TICK else [F.col("liquidity_now").alias("liquidity")]))
    order = [F.col("move_score").desc_nulls_last(), F.col("abs_move").desc(), F.col(key)]
    t = top(d, limit, *order)
    if venue is TICK:
        return attach(t, state, key, ["title"], order,
                      [key, "title", "mid_now", "mid_prev", "move", "abs_move", "move_score",
                       "avg_move_24h", "volume", "open_interest", "spread_ticks"])
    return attach(t, state, key, ["question", "category"], order,
                  [key, "question", "category", "price_now", "price_prev", "move", "abs_move",
                   "move_score", "avg_move_24h", "volume", "liquidity"])


def market_movers_tick(snaps: DataFrame, limit: int = 100, min_diff: int = 25,
                       times: DataFrame | None = None) -> DataFrame:
    """|mid move| >= min_diff ticks versus ~24 h ago (B, 24 h)."""
    limit, min_diff = clamp(limit, 1, 500), max(1, int(min_diff))
    latest = lb.latest_ts(snaps, times)
    p = lb.pair(snaps, "market_ticker", latest,
                lb.base_ts(snaps, MOVERS_BASE_HOURS, times=times, latest=latest), ["mid"])
    d = p.select("market_ticker", F.col("mid_prev").alias("old_price"),
                 F.col("mid_now").alias("new_price"),
                 F.abs(F.col("mid_now") - F.col("mid_prev")).alias("price_diff"))
    return top(d.where(F.col("price_diff") >= min_diff), limit, F.col("price_diff").desc(),
               F.col("market_ticker"))


def spread_blowouts_tick(snaps: DataFrame, lookback_hours: int = 24, limit: int = 100,
                         times: DataFrame | None = None) -> DataFrame:
    """Spread change latest vs base; Postgres DESC puts nulls first."""
    h, limit = clamp(lookback_hours, 1, 168), clamp(limit, 1, 500)
    latest = lb.latest_ts(snaps, times)
    p = lb.pair(snaps, "market_ticker", latest, lb.base_ts(snaps, h, times=times, latest=latest),
                ["spread_ticks", "mid", "series_ticker"])
    d = p.select("market_ticker", F.col("series_ticker_now").alias("event_ticker"),
                 F.col("spread_ticks_now").alias("spread_now"),
                 F.col("spread_ticks_prev").alias("spread_prev"),
                 (F.col("spread_ticks_now") - F.col("spread_ticks_prev")).alias("d_spread"),
                 "mid_now", "mid_prev", (F.col("mid_now") - F.col("mid_prev")).alias("d_mid"))
    return top(d, limit, F.col("d_spread").desc_nulls_first(), F.col("market_ticker"))


def expiring_tick(snaps: DataFrame, as_of, lookback_hours: int = 48, limit: int = 50,
                  times: DataFrame | None = None) -> DataFrame:
    """Latest-snapshot markets expiring by as_of + h (no lower bound),
    by open interest desc nulls last."""
    h, limit = clamp(lookback_hours, 1, 336), clamp(limit, 1, 200)
    d = lb.latest_rows(snaps, times).where(F.col("expiration_time").isNotNull()
                                    & (F.col("expiration_time") <= ts_lit(as_of) + hours(h)))
    d = d.select("market_ticker", F.col("series_ticker").alias("event_ticker"), "expiration_time",
                 "open_interest", "volume", "spread_ticks", "mid")
    return top(d, limit, F.col("open_interest").desc_nulls_last(), F.col("market_ticker"))


def mid_moves(snaps: DataFrame, state: DataFrame, venue: Venue, lookback_hours: int = 24,
              limit: int = 100, times: DataFrame | None = None) -> DataFrame:
    """T14 (tick: |d_mid| desc nulls first, with spread change) / P13 (prob:
    both prices known, |move| desc)."""
    h, limit = clamp(lookback_hours, 1, 168), clamp(limit, 1, 500)
    key = venue.key
    latest = lb.latest_ts(snaps, times)
    p = lb.pair(snaps, key, latest, lb.base_ts(snaps, h, times=times, latest=latest), _pair_cols(venue))
    if venue is TICK:
        d = p.select(key, F.col("series_ticker_now").alias("event_ticker"), "mid_now", "mid_prev",
                     (F.col("mid_now") - F.col("mid_prev")).alias("d_mid"),
                     F.col("spread_ticks_now").alias("spread_now"),
                     F.col("spread_ticks_prev").alias("spread_prev"),
                     (F.col("spread_ticks_now") - F.col("spread_ticks_prev")).alias("d_spread"))
        order = [F.abs(F.col("d_mid")).desc_nulls_first(), F.col(key)]
        return attach(top(d, limit, *order), state, key, ["title"], order,
                      [key, "title", "event_ticker", "mid_now", "mid_prev", "d_mid", "spread_now",
                       "spread_prev", "d_spread"])
    px = venue.price
    d = p.where(F.col(f"{px}_now").isNotNull() & F.col(f"{px}_prev").isNotNull()).select(
        key, F.col("event_id_now").alias("event_id"), F.col(f"{px}_now").alias("price_now"),
        F.col(f"{px}_prev").alias("price_prev"),
        F.abs(F.col(f"{px}_now") - F.col(f"{px}_prev")).alias("price_diff"),
        F.col("volume_now").alias("volume"), F.col("liquidity_now").alias("liquidity"))
    order = [F.col("price_diff").desc(), F.col(key)]
    return attach(top(d, limit, *order), state, key, ["question", "category"], order,
                  [key, "question", "category", "event_id", "price_now", "price_prev", "price_diff",
                   "volume", "liquidity"])


def top_changes(snaps: DataFrame, state: DataFrame, venue: Venue, metric: str = "volume",
                limit: int = 50, min_prev_value: float = 0.0, window_hours: int = 24,
                exact_pct: bool = False, times: DataFrame | None = None) -> DataFrame:
    """Change of ``metric`` from the oldest snapshot in the last
    ``window_hours`` to the latest.  On the tick venue the integer metrics
    divide as integers (truncating) before x100, as the reference's int
    columns do; ``exact_pct=True`` gives the true ratio."""
    limit = clamp(limit, 1, 500)
    try:
        min_prev = float(min_prev_value)
    except (TypeError, ValueError):
        min_prev = 0.0
    m = TOP_CHANGE_METRICS[venue.name].get((metric or "volume").lower())
    if m is None:
        known = sorted(set(TOP_CHANGE_METRICS[venue.name].values()))
        raise ValueError(f"no top changes by {metric!r} on the {venue.name} venue; choose from {known}")
    key = venue.key
    latest = lb.latest_ts(snaps, times)
    base = lb.window_start_ts(snaps, window_hours, times, latest=latest)
    cols = list(dict.fromkeys([m, "volume"] + (["open_interest", "series_ticker"] if venue is TICK
                                                else ["event_id"])))
    p = lb.pair(snaps, key, latest, base, cols)
    now, prev = F.col(f"{m}_now"), F.col(f"{m}_prev")
    p = p.where(prev.isNotNull() & now.isNotNull() & (F.abs(prev) >= min_prev))
    if venue is TICK and m in INTEGER_METRICS and not exact_pct:
        pct = F.when(prev != 0, F.expr(f"(`{m}_now` - `{m}_prev`) div `{m}_prev`") * 100.0)
    else:
        pct = F.when(prev != 0, (now - prev) / prev * 100.0)
    dvol = F.col("volume_now") - F.col("volume_prev")
    if venue is TICK:
        doi = F.col("open_interest_now") - F.col("open_interest_prev")
        oi_cols = [F.col("open_interest_prev").alias("prev_open_interest"),
                   F.col("open_interest_now").alias("current_open_interest"),
                   doi.alias("d_open_interest")]
        tie = F.abs(F.coalesce(dvol, F.lit(0))) + F.abs(F.coalesce(doi, F.lit(0)))
        ev = F.col("series_ticker_now").alias("event_ticker")
    else:
        nul = F.lit(None).cast("double")
        oi_cols = [nul.alias("prev_open_interest"), nul.alias("current_open_interest"),
                   nul.alias("d_open_interest")]
        tie = F.abs(F.coalesce(dvol, F.lit(0.0)))
        ev = F.col("event_id_now").alias("event_id")
    d = p.select(
        key, ev,
        prev.cast("double").alias("prev_value"), now.cast("double").alias("current_value"),
        (now - prev).cast("double").alias("delta_value"), pct.cast("double").alias("pct_change"),
        F.col("volume_prev").cast("double").alias("prev_volume"),
        F.col("volume_now").cast("double").alias("current_volume"),
        dvol.cast("double").alias("d_volume"),
        *[c.cast("double") for c in oi_cols],
        F.col("snap_ts_now").alias("latest_snap_ts"), F.col("snap_ts_prev").alias("base_snap_ts"),
        hours_between(F.col("snap_ts_prev"), F.col("snap_ts_now")).alias("window_hours"),
        F.lit(m).alias("metric"),
        tie.alias("_tie"))
    order = [F.abs(F.col("delta_value")).desc(), F.col("_tie").desc(),
             F.col("current_volume").desc_nulls_last(), F.col(key)]
    t = top(d, limit, *order)
    tail = ["prev_value", "current_value", "delta_value", "pct_change", "prev_volume",
            "current_volume", "d_volume", "prev_open_interest", "current_open_interest",
            "d_open_interest", "latest_snap_ts", "base_snap_ts", "window_hours", "metric"]
    if venue is TICK:
        return attach(t, state, key, ["title"], order, [key, "title", "event_ticker"] + tail)
    return attach(t, state, key, ["question", "category"], order,
                  [key, "question", "category", "event_id"] + tail)


# ================================================================ prob venue
PROB_OUT = ["condition_id", "question", "category", "volume", "volume_24hr", "liquidity",
            "outcome_yes_price", "outcome_no_price", "event_id", "updated_at"]


def active_markets_prob(state: DataFrame, limit: int = 25) -> DataFrame:
    """Active markets with volume > 0 by volume."""
    d = state.where(F.col("active") & F.col("volume").isNotNull() & (F.col("volume") > 0))
    return top(d, clamp(limit, 1, 200), F.col("volume").desc(), F.col("condition_id")).select(*PROB_OUT)


def tradability_prob(state: DataFrame, limit: int = 100, scan: int | None = None,
                     min_liquidity: float = 0.0) -> DataFrame:
    """ln(1+volume) + 0.7 ln(1+liquidity), liquidity >= min."""
    d = _scan(state.where(F.col("active")), scan, "condition_id")
    vol = F.coalesce(F.col("volume"), F.lit(0.0))
    liq = F.coalesce(F.col("liquidity"), F.lit(0.0))
    d = d.where(liq >= float(min_liquidity)).select(
        "condition_id", "question", "category", vol.alias("volume"), liq.alias("liquidity"),
        "outcome_yes_price",
        F.round(F.log1p(vol) + SECOND_TERM_WEIGHT * F.log1p(liq), 4).alias("tradability_score"), "updated_at")
    return top(d, clamp(limit, 1, 200), F.col("tradability_score").desc(),
               F.col("updated_at").desc_nulls_last(), F.col("condition_id"))


def market_heat_prob(state: DataFrame, limit: int = 200, scan: int | None = None) -> DataFrame:
    """churn = 24h volume / volume (4 digits), both > 0."""
    d = _scan(state.where(F.col("active")), scan, "condition_id")
    vol = F.coalesce(F.col("volume"), F.lit(0.0))
    v24 = F.col("volume_24hr")
    d = d.where(v24.isNotNull() & (vol > 0) & (v24 > 0)).select(
        "condition_id", "question", "category", vol.alias("volume"), v24.alias("volume_24hr"),
        F.round(v24 / vol, 4).alias("churn_rate"), "updated_at")
    return top(d, clamp(limit, 1, 500), F.col("churn_rate").desc(), F.col("updated_at").desc_nulls_last(),
               F.col("condition_id")).drop("updated_at")


def _uncertainty(yes: Column) -> Column:
    return 1.0 - F.abs(yes - 0.5) * 2.0


def opportunity_prob(state: DataFrame, limit: int = 50, scan: int | None = None) -> DataFrame:
    """P5: (1 - 2|p - 0.5|) * ln(1+volume) for 0 < p < 1."""
    d = _scan(state.where(F.col("active")), scan, "condition_id")
    yes = F.col("outcome_yes_price")
    vol = F.coalesce(F.col("volume"), F.lit(0.0))
    d = d.where(yes.isNotNull() & (yes > 0) & (yes < 1)).select(
        "condition_id", "question", "category", vol.alias("volume"), "outcome_yes_price",
        F.round(_uncertainty(yes), 4).alias("uncertainty"),
        F.round(_uncertainty(yes) * F.log1p(vol), 4).alias("opportunity_score"), "updated_at")
    return top(d, clamp(limit, 1, 200), F.col("opportunity_score").desc(),
               F.col("updated_at").desc_nulls_last(), F.col("condition_id")).drop("updated_at")


def screener_prob(state: DataFrame, limit: int = 50, scan: int | None = None, min_volume=None,
                  min_liquidity=None, category: str | None = None,
                  sort_by: str = "tradability_score") -> DataFrame:
    """Optional volume / liquidity / category (case-insensitive)
    predicates; null sort keys count as 0."""
    d = _scan(state.where(F.col("active")), scan, "condition_id")
    vol = F.coalesce(F.col("volume"), F.lit(0.0))
    liq = F.coalesce(F.col("liquidity"), F.lit(0.0))
    v24, yes = F.col("volume_24hr"), F.col("outcome_yes_price")
    if min_volume is not None:
        d = d.where(vol >= float(min_volume))
    if min_liquidity is not None:
        d = d.where(liq >= float(min_liquidity))
    if category is not None:
        d = d.where(F.lower(F.coalesce(F.col("category"), F.lit(""))) == category.lower())
    d = d.select(
        "condition_id", "question", "category", vol.alias("volume"), v24.alias("volume_24hr"),
        liq.alias("liquidity"), yes.alias("outcome_yes_price"),
        F.round(F.log1p(vol) + SECOND_TERM_WEIGHT * F.log1p(liq), 4).alias("tradability_score"),
        F.when(v24.isNotNull() & (v24 != 0) & (vol > 0), F.round(v24 / vol, 4)).alias("churn_rate"),
        F.when(yes.isNotNull() & (yes > 0) & (yes < 1), F.round(_uncertainty(yes), 4)).alias("uncertainty"),
        "updated_at")
    col = SCREENER_SORT_PROB.get((sort_by or "tradability_score").lower(), "tradability_score")
    return top(d, clamp(limit, 1, 200), F.coalesce(F.col(col), F.lit(0.0)).desc(),
               F.col("updated_at").desc_nulls_last(), F.col("condition_id"))


def top_events_prob(event_snaps: DataFrame, events: DataFrame, by: str = "total_volume",
                    limit: int = 50) -> DataFrame:
    """P7 (by volume) / P8 (by liquidity): events at the latest event
    snapshot with title and category from the events dimension."""
    order = [F.col(by).desc_nulls_last(), F.col("event_id")]
    t = top(_latest_of(event_snaps), clamp(limit, 1, 200), *order)
    return attach(t, events, "event_id",
                  ["event_title", "category"], order,
                  ["event_id", "event_title", "category", "n_markets", "total_volume",
                   "total_liquidity", "avg_yes_price"])


def global_latest_prob(glob: DataFrame) -> DataFrame:
    """The latest global snapshot (empty when there is none)."""
    return top(glob, 1, F.col("snap_ts").desc()).select(
        "snap_ts", "n_active", "n_priced", "total_volume", "total_volume_24hr", "total_liquidity",
        "avg_yes_price")


def global_deltas_prob(glob: DataFrame, limit: int = 9) -> DataFrame:
    """P10: run-over-run deltas (one row per run; see T9)."""
    return _run_deltas(glob, {"total_volume": "d_volume", "total_volume_24hr": "d_volume_24hr",
                              "total_liquidity": "d_liquidity", "n_priced": "d_priced"}, clamp(limit, 1, 200))


def expiring_prob(state: DataFrame, as_of, lookback_hours: int = 48, limit: int = 50) -> DataFrame:
    """Active current-state markets ending by as_of + h (no lower bound)."""
    h, limit = clamp(lookback_hours, 1, 336), clamp(limit, 1, 200)
    d = state.where(F.col("active") & F.col("end_date").isNotNull()
                    & (F.col("end_date") <= ts_lit(as_of) + hours(h)))
    return top(d, limit, F.col("volume").desc_nulls_last(), F.col("condition_id")).select(
        "condition_id", "question", "category", "end_date", "volume", "volume_24hr", "liquidity",
        "outcome_yes_price", "event_id")
