"""The fixture derivations of ``sources.fixtures`` written as DuckDB SQL
CTEs, for the oracle side of the correctness check.  ``with_fixtures``
prepends the CTEs a query needs (dependencies resolved in order)."""

from __future__ import annotations

_EXP = "TIMESTAMP '2024-01-30 00:00:00' + to_hours(CAST((user_id % 30) * 4 AS BIGINT))"

CTES: dict[str, tuple[list[str], str]] = {
    "obs0": ([], """
        SELECT time_bucket(INTERVAL '6 hours', ts) AS snap_ts, user_id, count(*) AS n,
               CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS c, max(event_id) AS e
        FROM events GROUP BY 1, 2"""),
    "obs": (["obs0"], """
        SELECT o.*, t.run_id FROM obs0 o JOIN (
            SELECT snap_ts, CAST(dense_rank() OVER (ORDER BY snap_ts) AS BIGINT) AS run_id
            FROM (SELECT DISTINCT snap_ts FROM obs0) d) t USING (snap_ts)"""),
    "tick_u": (["obs"], f"""
        SELECT snap_ts, run_id, user_id,
               concat('M', user_id) AS market_ticker,
               concat('E', user_id % 12) AS series_ticker,
               {_EXP} AS expiration_time,
               CAST(1 + c % 85 AS INTEGER) AS yes_bid,
               CAST((1 + c % 85) + (1 + e % 14) AS INTEGER) AS yes_ask,
               CAST(CASE WHEN e % 41 <> 0 THEN sum(c) OVER wu END AS BIGINT) AS volume,
               CAST(greatest(0, sum(CASE WHEN e % 3 = 0 THEN -n ELSE 60 * n END) OVER wu) AS BIGINT)
                   AS open_interest,
               CAST(1 + e % 14 AS INTEGER) AS spread_ticks,
               CAST(2 * (1 + c % 85) + (1 + e % 14) AS DOUBLE) / 2.0 AS mid
        FROM obs
        WINDOW wu AS (PARTITION BY user_id ORDER BY snap_ts
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""),
    "tick_snapshots": (["tick_u"], """
        SELECT snap_ts, run_id, market_ticker, series_ticker, expiration_time, yes_bid, yes_ask,
               volume, open_interest, spread_ticks, mid FROM tick_u"""),
    "prob_u": (["obs"], f"""
        SELECT o.snap_ts, o.run_id, o.user_id,
               concat('C', o.user_id) AS condition_id,
               concat('V', cu.c_nationkey) AS event_id,
               cu.c_mktsegment AS category,
               {_EXP.replace('user_id', 'o.user_id')} AS end_date,
               CAST(sum(o.c) OVER (PARTITION BY o.user_id ORDER BY o.snap_ts
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / 100.0 AS volume,
               CAST(sum(o.c) OVER (PARTITION BY o.user_id ORDER BY o.snap_ts
                    RANGE BETWEEN INTERVAL 18 HOURS PRECEDING AND CURRENT ROW) AS DOUBLE) / 100.0
                   AS volume_24hr,
               greatest(CAST(0 AS DOUBLE), cu.c_acctbal) + 10 * o.n AS liquidity,
               CASE WHEN o.e % 43 <> 0 THEN CAST(1 + o.c % 999 AS DOUBLE) / 1000.0 END
                   AS outcome_yes_price,
               1 - CASE WHEN o.e % 43 <> 0 THEN CAST(1 + o.c % 999 AS DOUBLE) / 1000.0 END
                   AS outcome_no_price
        FROM obs o JOIN customer cu ON cu.c_custkey = o.user_id"""),
    "prob_snapshots": (["prob_u"], """
        SELECT snap_ts, run_id, condition_id, event_id, category, end_date, volume, volume_24hr,
               liquidity, outcome_yes_price, outcome_no_price FROM prob_u"""),
    "user_act": ([], """
        SELECT user_id, max(ts) AS updated_at, arg_max(event_type, ts) AS last_type
        FROM events GROUP BY user_id"""),
    "tick_state": (["tick_u", "user_act"], """
        SELECT l.market_ticker, l.series_ticker, concat('Market ', l.user_id) AS title,
               CASE WHEN a.last_type = 'error' THEN 'closed' ELSE 'active' END AS status,
               TIMESTAMP '2024-01-01 00:00:00' AS open_time, l.expiration_time AS close_time,
               l.expiration_time,
               CAST(CASE WHEN l.user_id % 13 = 0 THEN NULL WHEN l.user_id % 17 = 0 THEN 0
                         ELSE l.yes_bid END AS INTEGER) AS yes_bid,
               l.yes_ask, CAST(100 - l.yes_ask AS INTEGER) AS no_bid,
               CAST(100 - l.yes_bid AS INTEGER) AS no_ask, l.volume, l.open_interest,
               concat('{"event_ticker":"', CASE WHEN l.user_id % 19 = 0 THEN ''
                      ELSE concat('E', l.user_id % 12) END, '"}') AS raw,
               a.updated_at
        FROM (SELECT * FROM tick_u QUALIFY row_number() OVER (PARTITION BY user_id
              ORDER BY snap_ts DESC) = 1) l JOIN user_act a USING (user_id)"""),
    "prob_state": (["prob_u", "user_act"], """
        SELECT l.condition_id, CAST(l.user_id AS VARCHAR) AS market_id,
               concat('m-', l.user_id) AS slug, concat('Market ', l.user_id) AS question,
               l.category, a.last_type <> 'error' AS active, a.last_type = 'error' AS closed,
               TRUE AS enable_order_book, TIMESTAMP '2024-01-01 00:00:00' AS start_date,
               l.end_date, l.liquidity, l.volume, l.volume_24hr, l.outcome_yes_price,
               l.outcome_no_price, l.event_id, a.updated_at
        FROM (SELECT * FROM prob_u QUALIFY row_number() OVER (PARTITION BY user_id
              ORDER BY snap_ts DESC) = 1) l JOIN user_act a USING (user_id)"""),
    "prob_events": (["prob_u"], """
        SELECT f.event_id, lower(n.n_name) AS event_slug, n.n_name AS event_title, f.category,
               f.start_date, f.end_date, f.updated_at
        FROM (SELECT event_id,
                     first(category ORDER BY snap_ts, user_id) AS category,
                     min(snap_ts) AS start_date, max(end_date) AS end_date,
                     max(snap_ts) AS updated_at
              FROM prob_u GROUP BY event_id) f
        LEFT JOIN nation n ON concat('V', n.n_nationkey) = f.event_id"""),
    "tick_global": (["tick_snapshots"], """
        SELECT run_id, snap_ts, count(*) AS n_active,
               count(*) FILTER (WHERE yes_bid IS NOT NULL AND yes_ask IS NOT NULL) AS n_priced,
               CAST(coalesce(sum(volume), 0) AS BIGINT) AS total_volume,
               CAST(coalesce(sum(open_interest), 0) AS BIGINT) AS total_open_interest,
               CAST(avg(yes_ask - yes_bid) FILTER (WHERE yes_bid IS NOT NULL AND yes_ask IS NOT NULL)
                    AS DOUBLE) AS avg_spread_ticks,
               count(*) FILTER (WHERE yes_bid IS NOT NULL AND yes_ask IS NOT NULL
                                AND yes_ask - yes_bid >= 10) AS n_wide_spread
        FROM tick_snapshots GROUP BY run_id, snap_ts"""),
    "tick_series": (["tick_snapshots"], """
        SELECT snap_ts, run_id, series_ticker, count(*) AS n_markets,
               CAST(coalesce(sum(volume), 0) AS BIGINT) AS total_volume,
               CAST(coalesce(sum(open_interest), 0) AS BIGINT) AS total_open_interest,
               CAST(avg(yes_ask - yes_bid) AS DOUBLE) AS avg_spread_ticks
        FROM tick_snapshots
        WHERE series_ticker IS NOT NULL AND yes_bid IS NOT NULL AND yes_ask IS NOT NULL
        GROUP BY snap_ts, run_id, series_ticker
        HAVING coalesce(sum(volume), 0) > 0 OR coalesce(sum(open_interest), 0) > 0"""),
    "prob_global": (["prob_snapshots"], """
        SELECT run_id, snap_ts, count(*) AS n_active,
               count(*) FILTER (WHERE outcome_yes_price IS NOT NULL) AS n_priced,
               CAST(coalesce(sum(CAST(volume AS DECIMAL(18,4))), 0) AS DOUBLE) AS total_volume,
               CAST(coalesce(sum(CAST(volume_24hr AS DECIMAL(18,4))), 0) AS DOUBLE) AS total_volume_24hr,
               CAST(coalesce(sum(CAST(liquidity AS DECIMAL(18,4))), 0) AS DOUBLE) AS total_liquidity,
               round(avg(CAST(outcome_yes_price AS DECIMAL(18,6))), 6) AS avg_yes_price
        FROM prob_snapshots GROUP BY run_id, snap_ts"""),
    "prob_event_snapshots": (["prob_snapshots"], """
        SELECT snap_ts, run_id, event_id, count(*) AS n_markets,
               CAST(coalesce(sum(CAST(volume AS DECIMAL(18,4))), 0) AS DOUBLE) AS total_volume,
               CAST(coalesce(sum(CAST(liquidity AS DECIMAL(18,4))), 0) AS DOUBLE) AS total_liquidity,
               round(avg(CAST(outcome_yes_price AS DECIMAL(18,6))), 6) AS avg_yes_price
        FROM prob_snapshots WHERE event_id IS NOT NULL GROUP BY snap_ts, run_id, event_id"""),
    "tick_runs": (["tick_snapshots"], """
        SELECT run_id, snap_ts AS started_at,
               CASE WHEN run_id % 25 <> 0 THEN snap_ts + INTERVAL 5 MINUTE END AS finished_at,
               'fixture' AS source, concat('h', run_id % 3) AS host, count(*) AS n_markets,
               concat('started ', strftime(snap_ts, '%Y-%m-%dT%H:%M:%S')) AS note
        FROM tick_snapshots GROUP BY run_id, snap_ts"""),
    "prob_runs": (["prob_snapshots"], """
        SELECT run_id, snap_ts AS started_at,
               CASE WHEN run_id % 25 <> 0 THEN snap_ts + INTERVAL 5 MINUTE END AS finished_at,
               'fixture' AS source, concat('h', run_id % 3) AS host, count(*) AS n_markets,
               concat('started ', strftime(snap_ts, '%Y-%m-%dT%H:%M:%S')) AS note
        FROM prob_snapshots GROUP BY run_id, snap_ts"""),
    "ingest_log": ([], """
        SELECT event_id AS id, ts AS ts_utc, event_type AS source, concat('h', user_id % 5) AS host,
               props AS note FROM events"""),
    "alerts": ([], """
        SELECT CAST(u.user_id * 3 + t.t AS BIGINT) AS alert_id,
               concat('user', u.user_id, '@example.com') AS user_email,
               CASE WHEN u.user_id % 2 = 0 THEN 'tick' ELSE 'prob' END AS platform,
               CASE WHEN u.user_id % 2 = 0 THEN concat('M', u.user_id) ELSE concat('C', u.user_id) END
                   AS market_key,
               t.alert_type,
               CAST(CASE WHEN (u.user_id // 2) % 2 = 1 THEN
                    CASE WHEN u.user_id % 2 = 0 THEN t.tick_hi ELSE t.prob_hi END
                    ELSE CASE WHEN u.user_id % 2 = 0 THEN t.tick_lo ELSE t.prob_lo END END AS DOUBLE)
                   AS threshold,
               u.user_id % 11 <> 0 AS is_active,
               TIMESTAMP '2024-01-01 00:00:00' AS created_at,
               CASE WHEN u.user_id % 3 = 1 THEN TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 30 MINUTE
                    WHEN u.user_id % 3 = 2 THEN TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 90 MINUTE
               END AS last_triggered_at
        FROM (SELECT DISTINCT user_id FROM events) u,
             (VALUES (0, 'PRICE_MOVE', 1.0, 40.0, 0.01, 0.4),
                     (1, 'VOLATILITY_SPIKE', 0.5, 5.0, 0.5, 5.0),
                     (2, 'VOLUME_SURGE', 100.0, 1.0e9, 1.0, 1.0e9))
             AS t(t, alert_type, tick_lo, tick_hi, prob_lo, prob_hi)"""),
}


CTES.update({
    "tick_feed": (["tick_u"], """
        SELECT t.market_ticker, t.series_ticker, concat('Market ', t.user_id) AS title,
               CASE WHEN (t.user_id + t.run_id) % 10 = 0 THEN 'closed' ELSE 'active' END AS status,
               TIMESTAMP '2024-01-01 00:00:00' AS open_time,
               CASE WHEN t.user_id % 11 = 0 THEN NULL ELSE t.expiration_time END AS close_time,
               t.expiration_time, t.yes_bid, t.yes_ask, CAST(100 - t.yes_ask AS INTEGER) AS no_bid,
               CAST(100 - t.yes_bid AS INTEGER) AS no_ask, t.volume, t.open_interest,
               CASE WHEN t.user_id % 19 = 0 THEN NULL ELSE t.series_ticker END AS raw_event_ticker,
               strftime(t.snap_ts, '%Y-%m-%dT%H:%M:%SZ') AS page_ts, t.snap_ts AS page_time,
               t.user_id // 25 AS page_no,
               CAST(row_number() OVER (PARTITION BY t.snap_ts, t.user_id // 25
                                       ORDER BY t.user_id % 25) - 1 AS INTEGER) AS pos
        FROM tick_u t"""),
    "prob_feed": (["prob_u"], """
        SELECT g.*, CAST(row_number() OVER (PARTITION BY g.snap_ts, g.page_no, g.event_id
                                            ORDER BY g.user_id % 25) - 1 AS INTEGER) AS pos,
               CAST(dense_rank() OVER (PARTITION BY g.snap_ts, g.page_no ORDER BY g.first_u) - 1
                    AS INTEGER) AS ev_pos
        FROM (SELECT p.*, n.n_name AS event_title, p.user_id // 25 AS page_no,
                     min(p.user_id) OVER (PARTITION BY p.snap_ts, p.user_id // 25, p.event_id) AS first_u,
                     first(p.category ORDER BY p.user_id) OVER (PARTITION BY p.snap_ts, p.user_id // 25,
                           p.event_id) AS ev_category,
                     max(p.end_date) OVER (PARTITION BY p.snap_ts, p.user_id // 25, p.event_id) AS ev_end,
                     strftime(p.snap_ts, '%Y-%m-%dT%H:%M:%SZ') AS page_ts
              FROM prob_u p LEFT JOIN nation n ON concat('V', n.n_nationkey) = p.event_id) g"""),
    "prob_flat": (["prob_feed"], """
        SELECT CAST(user_id AS VARCHAR) AS market_id,
               CASE WHEN user_id % 23 = 0 THEN '' ELSE condition_id END AS condition_id,
               CASE WHEN user_id % 4 = 0 THEN lower(event_title) ELSE concat('m-', user_id) END AS slug,
               concat('Market ', user_id) AS question,
               CASE WHEN user_id % 6 = 0 THEN ev_category ELSE category END AS category,
               '2024-01-01T00:00:00Z' AS start_date,
               strftime(CASE WHEN user_id % 8 = 0 THEN ev_end ELSE end_date END, '%Y-%m-%dT%H:%M:%SZ')
                   AS end_date,
               liquidity, volume, volume_24hr,
               CASE WHEN outcome_yes_price IS NULL OR user_id % 8 IN (3, 4) THEN NULL
                    WHEN user_id % 8 = 2 THEN 3 ELSE 2 END AS n_outcomes,
               CASE WHEN user_id % 8 IN (3, 4) THEN NULL ELSE outcome_yes_price END AS outcome_yes_price,
               CASE WHEN user_id % 8 IN (3, 4) THEN NULL ELSE round(outcome_no_price, 3) END
                   AS outcome_no_price,
               event_id, lower(event_title) AS event_slug, event_title, ev_category AS event_category,
               ev_end AS event_end, page_ts, snap_ts AS page_time, page_no, ev_pos, pos, user_id
        FROM prob_feed"""),
    # The runs that the stream queries land: all of them.
    "tick_landed": (["tick_feed"], "SELECT * FROM tick_feed"),
    "prob_landed": (["prob_flat"], "SELECT * FROM prob_flat"),
})


def with_fixtures(names: list[str], body: str) -> str:
    """``WITH <needed fixture CTEs> <body>``; ``body`` may start with more
    CTEs (", x AS (...)") or directly with SELECT."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order)
    body = body.strip()
    if body.startswith(","):
        return f"WITH {ctes}{body}"
    return f"WITH {ctes}\n{body}"
