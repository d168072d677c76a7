"""Declared schemas (never inferred) of the stored tables and feed pages."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B, TS = (T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(),
                     T.BooleanType(), T.TimestampNTZType())


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Current state, tick venue: one row per market_ticker.
TICK_STATE = _st(("market_ticker", S), ("series_ticker", S), ("title", S), ("status", S),
                 ("open_time", TS), ("close_time", TS), ("expiration_time", TS),
                 ("yes_bid", I), ("yes_ask", I), ("no_bid", I), ("no_ask", I),
                 ("volume", L), ("open_interest", L), ("raw", S), ("updated_at", TS))

# Per-market snapshot, tick venue: key (snap_ts, market_ticker).
TICK_SNAPSHOT = _st(("snap_ts", TS), ("run_id", L), ("market_ticker", S), ("series_ticker", S),
                    ("expiration_time", TS), ("yes_bid", I), ("yes_ask", I), ("volume", L),
                    ("open_interest", L), ("spread_ticks", I), ("mid", D))

TICK_GLOBAL = _st(("run_id", L), ("snap_ts", TS), ("n_active", L), ("n_priced", L),
                  ("total_volume", L), ("total_open_interest", L),
                  ("avg_spread_ticks", D), ("n_wide_spread", L))

TICK_SERIES = _st(("snap_ts", TS), ("run_id", L), ("series_ticker", S), ("n_markets", L),
                  ("total_volume", L), ("total_open_interest", L), ("avg_spread_ticks", D))

PROB_STATE = _st(("condition_id", S), ("market_id", S), ("slug", S), ("question", S),
                 ("category", S), ("active", B), ("closed", B), ("enable_order_book", B),
                 ("start_date", TS), ("end_date", TS), ("liquidity", D), ("volume", D),
                 ("volume_24hr", D), ("outcome_yes_price", D), ("outcome_no_price", D),
                 ("outcome_prices", S), ("event_id", S), ("raw", S), ("updated_at", TS))

PROB_EVENTS = _st(("event_id", S), ("event_slug", S), ("event_title", S), ("category", S),
                  ("start_date", TS), ("end_date", TS), ("raw", S), ("updated_at", TS))

PROB_SNAPSHOT = _st(("snap_ts", TS), ("run_id", L), ("condition_id", S), ("event_id", S),
                    ("end_date", TS), ("volume", D), ("volume_24hr", D), ("liquidity", D),
                    ("outcome_yes_price", D), ("outcome_no_price", D))

PROB_GLOBAL = _st(("run_id", L), ("snap_ts", TS), ("n_active", L), ("n_priced", L),
                  ("total_volume", D), ("total_volume_24hr", D), ("total_liquidity", D),
                  ("avg_yes_price", D))

PROB_EVENT_SNAPSHOT = _st(("snap_ts", TS), ("run_id", L), ("event_id", S), ("n_markets", L),
                          ("total_volume", D), ("total_liquidity", D), ("avg_yes_price", D))

EXPORT_RUNS = _st(("run_id", L), ("started_at", TS), ("finished_at", TS), ("source", S),
                  ("host", S), ("n_markets", L), ("note", S))

MOVE_STATS_COLS = ["avg_move_24h", "avg_move_7d", "std_move_24h", "volatility_score", "updated_at"]

_MOVES = [("avg_move_24h", D), ("avg_move_7d", D), ("std_move_24h", D), ("volatility_score", D), ("updated_at", TS)]
MOVE_STATS_TICK = _st(("market_ticker", S), *_MOVES)
MOVE_STATS_PROB = _st(("condition_id", S), *_MOVES)

ALERTS = _st(("alert_id", L), ("user_email", S), ("platform", S), ("market_key", S),
             ("alert_type", S), ("threshold", D), ("is_active", B), ("created_at", TS),
             ("last_triggered_at", TS))

ALERT_HISTORY = _st(("history_id", L), ("alert_id", L), ("triggered_at", TS), ("market_key", S),
                    ("alert_type", S), ("actual_value", D), ("threshold", D), ("sent", B),
                    ("error_message", S))

INGEST_LOG = _st(("id", L), ("ts_utc", TS), ("source", S), ("host", S), ("note", S))

# Landed feed page, tick venue (A1): {"cursor": ..., "markets": [...]}
TICK_FEED_MARKET = _st(("ticker", S), ("market_ticker", S), ("series_ticker", S),
                       ("event_ticker", S), ("title", S), ("status", S), ("open_time", S),
                       ("close_time", S), ("expiration_time", S), ("yes_bid", I),
                       ("yes_ask", I), ("no_bid", I), ("no_ask", I), ("volume", L),
                       ("open_interest", L), ("series_id", S), ("event_id", S),
                       ("event_title", S), ("close_ts", S))
TICK_FEED_PAGE = T.StructType([
    T.StructField("page_ts", S, True),
    T.StructField("page_no", L, True),
    T.StructField("cursor", S, True),
    T.StructField("markets", T.ArrayType(TICK_FEED_MARKET), True),
])

# Landed feed page, probability venue (A2): an array of events with markets.
# Numbers may arrive as strings or numbers and outcome lists as JSON text, so
# those fields are read as STRING and cast safely downstream.
PROB_FEED_MARKET = _st(("id", S), ("conditionId", S), ("slug", S), ("question", S),
                       ("category", S), ("active", B), ("closed", B), ("enableOrderBook", B),
                       ("startDate", S), ("endDate", S), ("liquidity", S), ("volume", S),
                       ("volume24hr", S), ("outcomes", S), ("outcomePrices", S))
PROB_FEED_EVENT = T.StructType([
    T.StructField("id", S, True), T.StructField("slug", S, True),
    T.StructField("active", B, True), T.StructField("closed", B, True),
    T.StructField("title", S, True), T.StructField("category", S, True),
    T.StructField("startDate", S, True), T.StructField("endDate", S, True),
    T.StructField("markets", T.ArrayType(PROB_FEED_MARKET), True),
])
PROB_FEED_PAGE = T.StructType([
    T.StructField("page_ts", S, True),
    T.StructField("page_no", L, True),
    T.StructField("events", T.ArrayType(PROB_FEED_EVENT), True),
])


# Page envelopes as parsed by the feed readers: market elements are kept as
# their source JSON text (``raw``) and parsed one level down.
TICK_PAGE_ENVELOPE = "struct<page_ts:string, page_no:bigint, cursor:string, markets:array<string>>"
PROB_PAGE_ENVELOPE = ("struct<page_ts:string, page_no:bigint, events:array<struct<id:string, "
                      "slug:string, title:string, category:string, startDate:string, endDate:string, "
                      "active:boolean, closed:boolean, markets:array<string>>>>")
