"""B (base-snapshot lookup), pair operator, M1/M2 move statistics, K6."""

from pyspark.sql import functions as F

from helpers import t, tick_snaps
from pricescope.operators import lookback as lb
from pricescope.operators import stats as st
from pricescope.venues import TICK


def _base(snaps, h):
    return snaps.agg(F.max("snap_ts")).select(lb.base_ts(snaps, h).alias("b")).first().b


def test_base_lookup_rules(spark):
    one = tick_snaps(spark, [("2024-01-30 18:00:00", "A", 50.0, 2, 1, 1)])
    assert _base(one, 1) is None                                        # single snapshot: no base
    two = tick_snaps(spark, [("2024-01-30 17:30:00", "A", 50.0, 2, 1, 1),
                             ("2024-01-30 18:00:00", "A", 51.0, 2, 1, 1)])
    assert _base(two, 1) == t("2024-01-30 17:30:00")                    # none old enough: fallback
    three = tick_snaps(spark, [("2024-01-30 12:00:00", "A", 50.0, 2, 1, 1),
                               ("2024-01-30 17:00:00", "A", 50.0, 2, 1, 1),
                               ("2024-01-30 18:00:00", "A", 51.0, 2, 1, 1)])
    assert _base(three, 1) == t("2024-01-30 17:00:00")                  # exactly h hours qualifies
    assert _base(three, 2) == t("2024-01-30 12:00:00")
    assert _base(three, 100) == t("2024-01-30 17:00:00")                # fallback to newest earlier
    tbl = {r.lookback_hours: (r.base_ts, r.used_fallback) for r in lb.base_table(three, [1, 100]).collect()}
    assert tbl[1] == (t("2024-01-30 17:00:00"), False) and tbl[100][1] is True


def test_pair_requires_presence_in_both(spark):
    s = tick_snaps(spark, [("2024-01-30 12:00:00", "A", 50.0, 2, 1, 1), ("2024-01-30 12:00:00", "B", 40.0, 2, 1, 1),
                           ("2024-01-30 18:00:00", "A", 55.0, 2, 1, 1), ("2024-01-30 18:00:00", "C", 41.0, 2, 1, 1)])
    p = lb.pair(s, "market_ticker", lb.latest_ts(s), lb.base_ts(s, 6), ["mid"]).collect()
    assert [(r.market_ticker, r.mid_now, r.mid_prev) for r in p] == [("A", 55.0, 50.0)]


def test_move_stats_global_neighbours_and_windows(spark):
    rows = [
        # A: priced every snapshot
        ("2024-01-29 12:00:00", "A", 50.0, 2, 1, 1), ("2024-01-29 18:00:00", "A", 52.0, 2, 1, 1),
        ("2024-01-30 00:00:00", "A", 51.0, 2, 1, 1), ("2024-01-30 06:00:00", "A", 55.0, 2, 1, 1),
        ("2024-01-30 12:00:00", "A", 55.0, 2, 1, 1), ("2024-01-30 18:00:00", "A", 56.0, 2, 1, 1),
        # G: a gap at 06:00 -> the 00:00 -> 12:00 pair is not a move
        ("2024-01-30 00:00:00", "G", 10.0, 2, 1, 1), ("2024-01-30 12:00:00", "G", 20.0, 2, 1, 1),
        ("2024-01-30 18:00:00", "G", 21.0, 2, 1, 1),
        # Z: constant price -> volatility score null (avg 0)
        ("2024-01-30 12:00:00", "Z", 30.0, 2, 1, 1), ("2024-01-30 18:00:00", "Z", 30.0, 2, 1, 1),
        # O: a snapshot exactly 7 days old is outside the window (strict)
        ("2024-01-23 18:00:00", "O", 10.0, 2, 1, 1), ("2024-01-29 12:00:00", "O", 90.0, 2, 1, 1),
    ]
    s = tick_snaps(spark, rows)
    got = {r.market_ticker: r for r in st.move_stats(s, TICK, "2024-01-30 18:00:00").collect()}
    a = got["A"]
    # 24h window: snap_ts > 18:00 - 24h (strict) -> moves at 00:00(1), 06:00(4), 12:00(0), 18:00(1)
    assert a.avg_move_24h == 1.5 and a.avg_move_7d == round((2 + 1 + 4 + 0 + 1) / 5, 4)
    assert a.std_move_24h == round(1.7320508, 4)
    assert got["G"].avg_move_24h == 1.0 and got["G"].std_move_24h is None   # one move: stddev null
    assert got["Z"].avg_move_24h == 0.0 and got["Z"].volatility_score is None
    assert "O" not in got                                                  # only one in-window row


def test_upsert_move_stats_keeps_old_keys(spark):
    old = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "market_ticker string, avg_move_24h double")
    new = spark.createDataFrame([("A", 5.0)], "market_ticker string, avg_move_24h double")
    got = dict(st.upsert_move_stats(old, new, "market_ticker").collect())
    assert got == {"A": 5.0, "B": 2.0}
