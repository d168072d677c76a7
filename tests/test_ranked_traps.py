"""Semantic traps of the ranked queries."""

from helpers import tick_snaps, tick_state, t
from pricescope.operators import ranked as rk
from pricescope.operators import volindex as vi
from pricescope.venues import TICK


def test_null_order_desc_nulls_first(spark):
    s = tick_snaps(spark, [("2024-01-30 12:00:00", "A", 50.0, 2, 1, 1), ("2024-01-30 12:00:00", "B", 50.0, None, 1, 1),
                           ("2024-01-30 18:00:00", "A", 50.0, 9, 1, 1), ("2024-01-30 18:00:00", "B", 50.0, 3, 1, 1)])
    out = [r.market_ticker for r in rk.spread_blowouts_tick(s, 6, 10).collect()]
    assert out == ["B", "A"]                         # null d_spread first, as Postgres DESC


def test_integer_division_in_top_changes(spark):
    rows = []
    for key, prev, now in [("A", 2, 3), ("B", 3, 2), ("C", 2, 5), ("D", 0, 4)]:
        rows += [("2024-01-30 00:00:00", key, 50.0, 2, prev, 1), ("2024-01-30 18:00:00", key, 50.0, 2, now, 1)]
    s = tick_snaps(spark, rows)
    state = tick_state(spark, [{"market_ticker": k, "title": k} for k in "ABCD"])
    got = {r.market_ticker: r.pct_change for r in rk.top_changes(s, state, TICK, "volume").collect()}
    assert got == {"A": 0.0, "B": 0.0, "C": 100.0, "D": None}
    exact = {r.market_ticker: r.pct_change
             for r in rk.top_changes(s, state, TICK, "volume", exact_pct=True).collect()}
    assert exact["A"] == 50.0 and round(exact["B"], 4) == -33.3333


def test_unknown_metric_raises(spark):
    s = tick_snaps(spark, [("2024-01-30 18:00:00", "A", 50.0, 2, 1, 1)])
    import pytest
    with pytest.raises(ValueError):
        rk.top_changes(s, s, TICK, "nope")


def _st(**kw):
    base = {"status": "active", "title": "x", "updated_at": t("2024-01-30 10:00:00"), "volume": 100,
            "open_interest": 50}
    base.update(kw)
    return base


def test_zero_is_missing_rules(spark):
    state = tick_state(spark, [
        _st(market_ticker="BID0", yes_bid=0, yes_ask=5),
        _st(market_ticker="ASK0", yes_bid=5, yes_ask=0),
        _st(market_ticker="SPR0", yes_bid=5, yes_ask=5),
        _st(market_ticker="NEG", yes_bid=6, yes_ask=5),
        _st(market_ticker="OI0", yes_bid=5, yes_ask=8, open_interest=0),
        _st(market_ticker="OK", yes_bid=5, yes_ask=8),
    ])
    gap = {r.market_ticker for r in rk.opportunity_gap_tick(state).collect()}
    assert gap == {"SPR0", "NEG", "OI0", "OK"}                 # bid 0 and ask 0 dropped
    trad = {r.market_ticker for r in rk.tradability_tick(state).collect()}
    assert "BID0" in trad and "SPR0" not in trad and "NEG" not in trad   # spread >= 1 only
    scr = {r.market_ticker: r for r in rk.screener_tick(state, sort_by="churn").collect()}
    assert "BID0" not in scr                                             # bid <= 0 dropped
    assert scr["SPR0"].tradability_score == round((__import__("math").log1p(100)
                                                   + 0.7 * __import__("math").log1p(50)) / 1.0, 4)
    assert scr["NEG"].spread_ticks == -1.0                               # negative spread allowed
    order = [r.market_ticker for r in rk.screener_tick(state, sort_by="churn").collect()]
    assert order[-1] == "OI0" and scr["OI0"].churn_rate is None          # null churn last


def test_expiring_has_no_lower_bound(spark):
    s = tick_snaps(spark, [("2024-01-30 18:00:00", "OLD", 50.0, 2, 1, 5), ("2024-01-30 18:00:00", "FAR", 50.0, 2, 1, 9)])
    from pyspark.sql import functions as F
    s = s.withColumn("expiration_time", F.when(F.col("market_ticker") == "OLD", F.lit(t("2024-01-01 00:00:00")))
                     .otherwise(F.lit(t("2024-03-01 00:00:00"))))
    out = [r.market_ticker for r in rk.expiring_tick(s, "2024-01-30 18:00:00", 48).collect()]
    assert out == ["OLD"]


def test_vol_index_price_scale(spark):
    rows = []
    for i, hh in enumerate(["06", "12", "18"]):
        rows += [(f"2024-01-30 {hh}:00:00", "A", 40.0 + 5 * i, 2, 1, 200),
                 (f"2024-01-30 {hh}:00:00", "B", 60.0 - 5 * i, 2, 1, 50)]
    s = tick_snaps(spark, rows)
    assert vi.vol_index(s, TICK, points=5, min_weight=100, price_scale=1.0).count() == 0
    pts = vi.vol_index(s, TICK, points=5, min_weight=100, price_scale=100.0).collect()
    assert len(pts) == 2 and all(p.dt_hours == 6.0 and p.vol_index > 0 for p in pts)


def test_housekeeping_defaults(spark):
    from pyspark.sql import functions as F

    from pricescope.operators import inspect as ins
    s = tick_snaps(spark, [("2022-12-01 00:00:00", "OLD", 50.0, 2, 1, 1), ("2024-01-30 18:00:00", "NEW", 50.0, 2, 1, 1)])
    runs = s.select(F.col("snap_ts").alias("started_at"))
    kept = ins.housekeeping(s, s, runs, "2024-01-30 18:00:00")
    assert [r.market_ticker for r in kept["market_snapshots"].collect()] == ["NEW"]
    assert kept["export_runs"].count() == 1
    more = ins.housekeeping(s, s, runs, "2024-01-30 18:00:00", {"export_runs": 800})
    assert more["export_runs"].count() == 2
