"""Fixed values.

These values must equal the reference's for the results to match.  They
are stated here once, in plain form, and imported by the operators.
"""

# --- Fixed values: snapshots -------------------------------------------------
WIDE_SPREAD = 10                 # spread in ticks counted as "wide"
PICK_CAP = 20000                 # rows per selection criterion in market snapshots
EXPIRY_HORIZON_H = 48            # hours ahead for the "expiring" selection criterion

# --- Fixed values: fields of the raw document shown by the cookbook (C4) -------
RAW_FIELDS = ["event_ticker", "market_type", "response_price_units", "rules_primary", "rules_secondary"]

# --- Fixed values: move statistics -------------------------------------------
MOVE_LOOKBACK_DAYS = 7           # snapshots strictly newer than as_of - 7 days
MOVE_RECENT_HOURS = 24           # the recent part, relative to the latest snapshot
TICK_STAT_DIGITS = 4             # rounding of tick move averages
PROB_STAT_DIGITS = 6             # rounding of probability move averages
SCORE_DIGITS = 4                 # rounding of volatility and move scores

# --- Fixed values: ranked analytics ------------------------------------------
SECOND_TERM_WEIGHT = 0.7         # tradability = ln(1+volume) + 0.7 * ln(1+oi or liquidity)
HEAT_MIN_OPEN_INTEREST = 100     # tick heat considers open interest above this
MOVERS_BASE_HOURS = 24           # "movers" compare with ~24 hours ago
TOP_CHANGES_WINDOW_HOURS = 24    # top changes: oldest snapshot within the last 24 hours
TOP_CHANGE_METRICS = {
    "tick": {"volume": "volume", "open_interest": "open_interest", "oi": "open_interest",
             "mid": "mid", "spread_ticks": "spread_ticks", "spread": "spread_ticks"},
    "prob": {"volume": "volume", "volume_24hr": "volume_24hr", "liquidity": "liquidity",
             "outcome_yes_price": "outcome_yes_price", "yes_price": "outcome_yes_price"},
}
INTEGER_METRICS = {"volume", "open_interest", "spread_ticks"}   # integer division on the tick venue
SCREENER_SORT_TICK = {           # sort name -> (column, ascending)
    "spread_ticks": ("spread_ticks", True),
    "volume": ("volume", False),
    "open_interest": ("open_interest", False),
    "oi": ("open_interest", False),
    "churn": ("churn_rate", False),
    "churn_rate": ("churn_rate", False),
}
SCREENER_SORT_PROB = {           # sort name -> column (descending, nulls as 0)
    "tradability_score": "tradability_score", "volume": "volume", "volume_24hr": "volume_24hr",
    "liquidity": "liquidity", "churn": "churn_rate", "churn_rate": "churn_rate",
    "uncertainty": "uncertainty",
}

# --- Fixed values: volatility index ------------------------------------------
HOURS_PER_YEAR = 24.0 * 365.0
VOL_PRICE_LOW = 0.01             # prices strictly inside (0.01, 0.99)
VOL_PRICE_HIGH = 0.99
VOL_INDEX_SCALE = 100.0

# --- Fixed values: alerts ----------------------------------------------------
ALERT_TYPES = ["PRICE_MOVE", "VOLATILITY_SPIKE", "VOLUME_SURGE"]
COOLDOWN_HOURS = 1               # an alert does not fire again within 1 hour (strict <)
MOVER_LOOKBACK_HOURS = 1         # alert movers compare with ~1 hour ago
SUBJECT_MAX = 60                 # subject titles longer than 60 are cut to 57 + "..."

# --- Fixed values: overview --------------------------------------------------
UNKNOWN_SERIES = "UNKNOWN_SERIES"
UNKNOWN_EVENT = "UNKNOWN_EVENT"
OVERVIEW_MARKET_FIELDS = ["ticker", "title", "status", "yes_ask", "no_ask", "volume",
                          "open_interest", "close_ts"]

# --- Fixed values: retention (the guide's example housekeeping) --------------
RETENTION_DAYS = {"market_snapshots": 90, "series_snapshots": 30, "export_runs": 365}
