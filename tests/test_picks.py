"""Lists bounded by a quantile sketch hold exactly the rows a full ranking gives."""

import datetime as dt
import random

import pytest

from helpers import t, tick_state
from pricescope.operators import snapshots as sn
from pricescope.schemas import PROB_STATE

RUN = t("2024-01-30 12:00:00")


def _tick(seed, n):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        bid = rnd.choice([None, rnd.randint(1, 80)])
        rows.append({"market_ticker": f"M{rnd.random():.12f}", "status": rnd.choice(["active"] * 9 + ["closed"]), "yes_bid": bid,
                     "yes_ask": None if bid is None else bid + rnd.choice([1, 5, 10, 11, 12]),
                     "volume": rnd.choice([None, 0, 0, 0, rnd.randint(0, 10**6)]), "open_interest": rnd.choice([None, rnd.randint(0, 50)]),
                     "expiration_time": rnd.choice([None, RUN + dt.timedelta(hours=rnd.randint(-90, 90))]), "raw": '{"event_ticker":"E"}'})
    return rows


def _want(rows, cap):
    c = [r for r in rows if r["status"] == "active" and r["yes_bid"] is not None]
    spread = lambda r: r["yes_ask"] - r["yes_bid"]
    soon = [r for r in c if r["expiration_time"] and r["expiration_time"] <= RUN + dt.timedelta(hours=48)]
    lists = [sorted(c, key=lambda r, f=f: (r[f] is None, -(r[f] or 0), r["market_ticker"])) for f in ("volume", "open_interest")]
    lists += [sorted((r for r in c if spread(r) >= 10), key=lambda r: (-spread(r), r["market_ticker"])),
              sorted(soon, key=lambda r: (r["expiration_time"], r["market_ticker"]))]
    return {r["market_ticker"] for rows_ in lists for r in rows_[:cap]}


@pytest.mark.parametrize("cap", [1, 7, 60, 10**6])
def test_tick_picks_equal_a_full_ranking(spark, cap):
    rows = _tick(3, 3000)
    got = sn.pick_markets_tick(tick_state(spark, rows).repartition(5), RUN, 4, cap=cap).collect()
    assert {r.market_ticker for r in got} == _want(rows, cap) and len(got) == len(_want(rows, cap))
    assert {(r.snap_ts, r.run_id) for r in got} == {(RUN, 4)}


def test_prob_picks_equal_a_full_ranking_of_each_run(spark):
    rnd = random.Random(8)
    rows = [tuple({"condition_id": f"C{i}", "active": rnd.random() < 0.9, "volume": rnd.choice([None, 5.0, rnd.random() * 100]),
                   "liquidity": rnd.choice([1.0, 2.0]), "volume_24hr": float(i % 1000)}.get(c) for c in PROB_STATE.names) for i in range(2000)]
    state = spark.createDataFrame(rows, PROB_STATE)
    runs = [(RUN, 1), (RUN + dt.timedelta(hours=6), 2)]
    both = sn._one_run(state, *runs[0]).unionByName(sn._one_run(state.where("volume > 3"), *runs[1]))
    got = sn.picks_by_run_prob(both, cap=15).collect()
    i = {c: PROB_STATE.names.index(c) for c in PROB_STATE.names}
    for run, number in runs:
        c = [r for r in rows if r[i["active"]] and (number == 1 or (r[i["volume"]] or 0) > 3)]
        want = {r[0] for f in ("volume", "liquidity", "volume_24hr")
                for r in sorted(c, key=lambda r, f=f: (r[i[f]] is None, -(r[i[f]] or 0), r[0]))[:15]}
        assert {r.condition_id for r in got if r.snap_ts == run} == want


def test_the_sketch_keeps_a_ranking_task_small(spark):
    """What is ranked is the cap and a part in 256, not cap rows of each of the partitions."""
    state = spark.range(40_000).selectExpr("concat('M', id) as market_ticker", "'active' as status", "1 as yes_bid", "3 as yes_ask",
                                           "id * 7 % 40009 as volume", "id as open_interest", "cast(null as timestamp_ntz) as expiration_time",
                                           "'{}' as raw").repartition(8)
    both = sn._one_run(state, RUN, 1).unionByName(sn._one_run(state, "2024-01-31 00:00:00", 2))
    got = sn._lists(sn._tick_candidates(both), 100, "market_ticker", {"volume": ("volume", True, None)})
    assert got.count() == 200
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile_approx" in plan and "cut_volume" in plan.split("row_number")[-1]
