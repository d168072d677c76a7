"""Tick normalisation, keyed upserts, append-if-absent."""

import json

import pytest
from pyspark.sql import functions as F

from pricescope.operators import ingest as ig
from pricescope.operators import snapshots as sn
from pricescope.schemas import TICK_STATE
from pricescope.sources import feeds


def _tick_page(page_ts, page_no, markets):
    return json.dumps({"page_ts": page_ts, "page_no": page_no, "markets": markets})


def _m(t, bid, **kw):
    d = {"ticker": t, "title": f"T{t}", "status": "active", "yes_bid": bid, "yes_ask": bid + 2}
    d.update(kw)
    return d


def test_normalize_tick_key_and_times(spark):
    pages = spark.createDataFrame([(_tick_page("2024-01-30T18:00:00Z", 0, [
        _m("", 10, market_ticker="B", close_time="", expiration_time="2024-01-31T00:00:00Z"),
        _m("A", 11)]),)], "value string")
    rows = {r.market_ticker: r for r in ig.normalize_tick(feeds.tick_markets(pages)).collect()}
    assert set(rows) == {"A", "B"}
    assert rows["B"].close_time is None and rows["B"].expiration_time.hour == 0
    assert json.loads(rows["A"].raw)["ticker"] == "A"


def test_missing_tick_key_fails_the_run(spark):
    pages = spark.createDataFrame([(_tick_page("t", 0, [_m("", 10)]),)], "value string")
    with pytest.raises(Exception, match="missing market_ticker"):
        ig.normalize_tick(feeds.tick_markets(pages)).collect()


def _state(spark, rows):
    full = [dict(dict.fromkeys(TICK_STATE.fieldNames()), **r) for r in rows]
    return spark.createDataFrame([tuple(r[c] for c in TICK_STATE.fieldNames()) for r in full], TICK_STATE)


def test_upsert_later_wins_and_old_keys_stay(spark):
    import datetime as dt
    old = _state(spark, [{"market_ticker": "A", "yes_bid": 1, "raw": "{}", "updated_at": dt.datetime(2024, 1, 1)},
                         {"market_ticker": "Z", "yes_bid": 9, "raw": "{}", "updated_at": dt.datetime(2024, 1, 1)}])
    pages = spark.createDataFrame([
        (_tick_page("2024-01-30T12:00:00Z", 0, [_m("A", 20), _m("A", 21)]),),   # twice in a page
        (_tick_page("2024-01-30T12:00:00Z", 1, [_m("A", 22), _m("B", 5)]),),    # across pages
        (_tick_page("2024-01-30T18:00:00Z", 0, [_m("B", 6)]),),                 # across runs
    ], "value string")
    rows = ig.normalize_tick(feeds.tick_markets(pages))
    new = ig.upsert(old, rows, "market_ticker", ["page_ts", "page_no", "pos"], "2024-01-31 00:00:00")
    got = {r.market_ticker: r.yes_bid for r in new.collect()}
    assert got == {"A": 22, "B": 6, "Z": 9}
    # K1 twice = once
    again = ig.upsert(new, rows, "market_ticker", ["page_ts", "page_no", "pos"], "2024-01-31 00:00:00")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, new.collect()))


def test_versioned_upsert_converges_in_any_order(spark):
    import datetime as dt
    old = _state(spark, [{"market_ticker": "A", "yes_bid": 1, "raw": "{}", "updated_at": dt.datetime(2024, 1, 1)}])
    old = old.withColumn("_v", F.lit(None).cast("struct<_run:int,_o0:string,_o1:bigint,_o2:int,_o3:int>"))
    p1 = spark.createDataFrame([(_tick_page("2024-01-30T12:00:00Z", 0, [_m("A", 20)]),)], "value string")
    p2 = spark.createDataFrame([(_tick_page("2024-01-30T18:00:00Z", 0, [_m("A", 30)]),)], "value string")
    order = ["page_ts", "page_no", "pos"]

    def step(state, p):
        return ig.upsert(state, ig.normalize_tick(feeds.tick_markets(p)), "market_ticker", order,
                         "2024-01-31 00:00:00", keep_version=True)
    fwd = step(step(old, p1), p2).first().yes_bid
    rev = step(step(old, p2), p1).first().yes_bid
    assert fwd == rev == 30


def test_events_first_row_wins_within_a_run(spark):
    def ev(cat, cid):
        return {"id": "E1", "slug": "s", "title": "T", "category": cat,
                "markets": [{"id": cid, "conditionId": cid}]}
    pages = spark.createDataFrame([
        (json.dumps({"page_ts": "2024-01-30T12:00:00Z", "page_no": 0, "events": [ev("first", "C1")]}),),
        (json.dumps({"page_ts": "2024-01-30T12:00:00Z", "page_no": 1, "events": [ev("second", "C2")]}),),
    ], "value string")
    flat = ig.flatten_prob(feeds.prob_market_elements(feeds.prob_events(pages)))
    assert [r.category for r in ig.event_rows(flat).collect()] == ["first"]
    pages2 = spark.createDataFrame([
        (json.dumps({"page_ts": "2024-01-30T18:00:00Z", "page_no": 0, "events": [ev("later-run", "C3")]}),),
    ], "value string")
    both = pages.unionByName(pages2)
    flat2 = ig.flatten_prob(feeds.prob_market_elements(feeds.prob_events(both)))
    from pricescope.schemas import PROB_EVENTS
    empty = spark.createDataFrame([], PROB_EVENTS)
    up = ig.upsert(empty, ig.event_rows(flat2), "event_id", ["page_ts", "page_no", "ev_pos", "pos"],
                   "2024-01-31 00:00:00")
    assert [r.category for r in up.collect()] == ["later-run"]


def test_append_if_absent_rerun_adds_nothing(spark):
    old = spark.createDataFrame([("2024-01-30 18:00:00", "A", 1)], "t string, k string, v int")
    new = spark.createDataFrame([("2024-01-30 18:00:00", "A", 2), ("2024-01-30 18:00:00", "B", 3)],
                                "t string, k string, v int")
    once = sn.append_if_absent(old, new, ["t", "k"])
    assert sorted((r.k, r.v) for r in once.collect()) == [("A", 1), ("B", 3)]
    twice = sn.append_if_absent(once, new, ["t", "k"])
    assert twice.count() == once.count()


def test_run_log_open_and_close(spark):
    from pricescope.schemas import EXPORT_RUNS
    runs = spark.createDataFrame([], EXPORT_RUNS)
    opened = ig.open_run(runs, "2024-01-31 00:00:00", "src", "h", "note")
    closed = ig.close_run(opened, F.lit(42), "2024-01-31 00:05:00").collect()
    assert len(closed) == 1 and closed[0].run_id == 1 and closed[0].n_markets == 42
    assert closed[0].finished_at is not None
