"""The tables a stream leaves do not depend on how pages are split, replayed or in which order runs come."""

import itertools
import json
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hst
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import t, tick_state
from pricescope.schemas import ALERTS
from pricescope.streaming import pipeline as sp
from pricescope.streaming.history import KeyHistory


def _pages(spark, page_ts, markets):
    return spark.createDataFrame([(json.dumps({"page_ts": page_ts, "page_no": 0, "markets": markets}),)],
                                 "value string")


def _m(key, bid, vol=100, oi=50):
    return {"ticker": key, "market_ticker": key, "title": key, "status": "active", "yes_bid": bid,
            "yes_ask": bid + 12, "volume": vol, "open_interest": oi, "event_ticker": "E1",
            "expiration_time": "2024-01-31T00:00:00Z"}


def _store(spark, tmp_path, **kw):
    store = sp.TickStore(str(tmp_path / "tables"), **{"buckets": 2, **kw})
    state = tick_state(spark, [{"market_ticker": "A", "status": "active", "yes_bid": 10, "yes_ask": 12,
                                "raw": '{"event_ticker":"E1"}', "updated_at": t("2024-01-01 00:00:00")}])
    alerts = spark.createDataFrame([(1, "u@x", "tick", "A", "PRICE_MOVE", 0.0, True, t("2024-01-01 00:00:00"),
                                     None)], ALERTS)
    store.initialise(spark, state, alerts)
    return store


def _snapshot_counts(spark, store):
    return (sp.read_partitioned(spark, store.global_snap, sp.TICK_GLOBAL).count(),
            sp.read_partitioned(spark, store.snapshots, sp.TICK_SNAPSHOT).count(),
            spark.read.schema(sp.ALERT_HISTORY).parquet(store.history).count())


def test_replayed_batch_is_idempotent(spark, tmp_path):
    store = _store(spark, tmp_path)
    p0 = _pages(spark, "2024-01-30T12:00:00Z", [_m("A", 20), _m("B", 30)])
    p1 = _pages(spark, "2024-01-30T18:00:00Z", [_m("A", 40), _m("B", 31)])
    sp.tick_batch(p0, 0, store)
    sp.tick_batch(p1, 1, store)
    before = _snapshot_counts(spark, store)
    state_before = sorted(map(tuple, store.state.current(spark).collect()))
    sp.tick_batch(p1, 1, store)                       # the same batch replayed
    assert _snapshot_counts(spark, store) == before
    assert sorted(map(tuple, store.state.current(spark).collect())) == state_before
    g = sp.read_partitioned(spark, store.global_snap, sp.TICK_GLOBAL).orderBy("run_id").collect()
    assert [r.run_id for r in g] == [1, 2]
    # the alert fired once (second run has a previous snapshot) and was stamped
    hist = spark.read.schema(sp.ALERT_HISTORY).parquet(store.history).collect()
    assert len(hist) == 1 and hist[0].actual_value == 20.0
    assert sp.read_alerts(spark, store).first().last_triggered_at == t("2024-01-30 18:00:00")


def test_state_does_not_depend_on_batch_order(spark, tmp_path):
    s1 = _store(spark, tmp_path / "fwd")
    s2 = _store(spark, tmp_path / "rev")
    p0 = _pages(spark, "2024-01-30T12:00:00Z", [_m("A", 20)])
    p1 = _pages(spark, "2024-01-30T18:00:00Z", [_m("A", 40)])
    sp.tick_batch(p0, 0, s1, alerts=False)
    sp.tick_batch(p1, 1, s1, alerts=False)
    sp.tick_batch(p1, 0, s2, alerts=False)
    sp.tick_batch(p0, 1, s2, alerts=False)
    a, b = (s.state.lookup(spark, "A").first() for s in (s1, s2))
    assert a.yes_bid == b.yes_bid == 40


def _files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_a_batch_writes_the_buckets_its_rows_touch_and_rewrites_nothing(spark, tmp_path):
    fields = T.StructType.fromDDL("k string, v int, updated_at timestamp_ntz")
    h = KeyHistory(str(tmp_path / "h"), "k", fields, buckets=16)
    h.initialise(spark.createDataFrame([(f"k{i}", 0, None) for i in range(200)], fields))

    def batch(label, day, keys, v):
        at = t(f"2024-01-{day:02d} 12:00:00")
        rows = spark.createDataFrame([(k, v, at, at, v, 0, 0) for k in keys], "k string, v int, updated_at timestamp_ntz, "
                                     "_from timestamp_ntz, _p long, _e long, _i long")
        h.append(rows, label, [at])

    batch("b0", 1, ["k1"], 1)                          # opens the day: its carry has every bucket
    before = _files(h.path)
    batch("b1", 1, ["k1", "k2"], 2)
    new = _files(h.path) - before
    buckets = {p.split("bucket=")[1].split("/")[0] for p in new}
    assert len(new) == len(buckets) <= 2 and before <= _files(h.path)
    batch("b1", 1, ["k1", "k2"], 2)                    # a replay replaces its own files
    assert len(_files(h.path)) == len(before) + len(new)
    assert {r.k: r.v for r in h.current(spark).collect() if r.v} == {"k1": 2, "k2": 2}
    assert h.lookup(spark, "k2").collect()[0].v == 2 and h.current(spark).count() == 200
    pruned = h.lookup(spark, "k2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in pruned and "bucket" in pruned


def test_state_as_of_any_time_whatever_came_first(spark, tmp_path):
    fields = T.StructType.fromDDL("k string, v int")
    days = [1, 2, 2, 5, 9]
    runs = [t(f"2024-01-{d:02d} {5 * i:02d}:00:00") for i, d in enumerate(days)]
    keys = [["a", "b"], ["a"], ["b", "c"], ["a"], ["c"]]
    for n, order in enumerate(itertools.islice(itertools.permutations(range(5)), 0, 120, 47)):
        h = KeyHistory(str(tmp_path / str(n)), "k", fields, buckets=2)
        h.initialise(spark.createDataFrame([("z", -1), ("a", -1)], fields))
        for i in order:
            rows = [(k, i, runs[i], 0, 0, 0) for k in keys[i]]
            h.append(spark.createDataFrame(rows, "k string, v int, _from timestamp_ntz, _p long, _e long, _i long"), f"b{i}", [runs[i]])
        want, held = {}, {"z": -1, "a": -1}
        for i, r in enumerate(runs):
            held |= {k: i for k in keys[i]}
            want[r] = dict(held)
        got = {}
        for r in h.at_runs(spark, {r: i for i, r in enumerate(runs)}).collect():
            got.setdefault(r.snap_ts, {})[r.k] = r.v
        assert got == want, order
        assert {r.k: r.v for r in h.before(spark, runs[3]).collect()} == want[runs[2]]


def test_old_segments_are_forgotten_and_later_runs_go_on(spark, tmp_path):
    store = _store(spark, tmp_path)
    for i, day in enumerate((1, 5, 9, 13)):
        sp.tick_batch(_pages(spark, f"2024-01-{day:02d}T12:00:00Z", [_m("A", 20 + i), _m(f"K{i}", 5)]), i, store)
    want = _tables(spark, store)
    gone = sp.forget_before(spark, store, late_days=5)
    assert len(gone["state"]) == 2                     # the start and day 1; day 5 is what day 8 builds on
    assert not any(f"seg={s}/" in p for s in gone["state"] for p in _files(store.state.path))
    assert _tables(spark, store) == want
    sp.tick_batch(_pages(spark, "2024-01-08T12:00:00Z", [_m("A", 77)]), 4, store)        # late, still known
    at = {r.snap_ts.day: r.total_volume for r in sp.read_partitioned(spark, store.global_snap, sp.TICK_GLOBAL).collect()}
    assert at == {1: 200, 5: 300, 8: 300, 9: 400, 13: 500}
    sp.tick_batch(_pages(spark, "2024-01-02T12:00:00Z", [_m("A", 1)]), 5, store)         # too late: left out
    assert {r.snap_ts.day: r.total_volume for r in sp.read_partitioned(spark, store.global_snap, sp.TICK_GLOBAL).collect()} == at
    assert sp.read_runs(spark, store).count() == 5


def test_maintenance_then_replay_of_a_batch_of_four_runs(spark, tmp_path):
    store = _store(spark, tmp_path)
    sp.tick_batch(_pages(spark, "2024-01-01T00:00:00Z", [_m("A", 10)]), 0, store)
    batch = None
    for i in range(4):
        p = _pages(spark, f"2024-01-{10 + i}T06:00:00Z", [_m("A", 20 + 9 * i), _m("B", 60 - 11 * i)])
        batch = p if batch is None else batch.unionByName(p)
    sp.tick_batch(batch, 1, store)
    want = _tables(spark, store)
    assert len(want["runs"]) == 5 and len(want["history"]) == 4
    sp.forget_before(spark, store, late_days=7)
    sp.tick_batch(batch, 1, store)
    assert _tables(spark, store) == want


def _tables(spark, store):
    """Everything the stream leaves for the queries, as sorted rows."""
    got = {n: sp.read_partitioned(spark, getattr(store, n), sch) for n, sch in (
        ("global_snap", sp.TICK_GLOBAL), ("series", sp.TICK_SERIES), ("snapshots", sp.TICK_SNAPSHOT))}
    got |= {"times": sp.read_times(spark, store), "history": sp.read_history(spark, store).drop("history_id"),
            "state": store.state.current(spark), "alerts": sp.read_alerts(spark, store),
            "move_stats": store.move_stats.current(spark), "runs": sp.read_runs(spark, store)}
    return {n: sorted(map(str, df.collect())) for n, df in got.items()}


def _page(spark, ts, no, last, markets):
    return spark.createDataFrame([(json.dumps({"page_ts": ts, "page_no": no, "last": last, "markets": markets}),)], "value string")


def test_any_split_of_the_pages_gives_the_same_tables(spark, tmp_path):
    runs = [[[_m("A", 20), _m("B", 30)], [_m("C", 40)]], [[_m("A", 50)], [_m("B", 70), _m("C", 10)]]]
    times = ["2024-01-30T12:00:00Z", "2024-01-30T18:00:00Z"]
    pages = [_page(spark, t_, no, no == 1, ms) for t_, run in zip(times, runs, strict=True) for no, ms in enumerate(run)]
    want = None
    for k, groups in enumerate(([[0, 1], [2, 3]], [[0, 1, 2, 3]], [[0], [1, 2], [3]])):
        store = _store(spark, tmp_path / str(k))
        for b, g in enumerate(groups):
            batch = pages[g[0]]
            for j in g[1:]:
                batch = batch.unionByName(pages[j])
            sp.tick_batch(batch, b, store)
        got = _tables(spark, store)
        want = want or got
        assert got == want, groups
    assert any("spread_ticks" in r and "mid=76.0" in r for r in want["snapshots"])


def test_late_run_gets_the_state_of_its_time_and_later_ones_are_rebuilt(spark, tmp_path):
    store = _store(spark, tmp_path)
    late = _pages(spark, "2024-01-30T12:00:00Z", [_m("A", 20), _m("B", 30)])
    sp.tick_batch(_pages(spark, "2024-01-30T18:00:00Z", [_m("A", 40)]), 0, store)
    sp.tick_batch(late, 1, store)
    got = sp.read_partitioned(spark, store.snapshots, sp.TICK_SNAPSHOT).collect()
    assert sorted((r.snap_ts.hour, r.market_ticker, r.yes_bid) for r in got) == [(12, "A", 20), (12, "B", 30), (18, "A", 40), (18, "B", 30)]
    once = _tables(spark, store)
    assert len(once["times"]) == len(once["global_snap"]) == 2
    sp.tick_batch(late, 1, store)
    assert _tables(spark, store) == once


RUNS = [("2024-01-20T00:00:00Z", [("A", 20), ("B", 30)]), ("2024-01-20T06:00:00Z", [("A", 25)]),
        ("2024-01-20T06:30:00Z", [("A", 60), ("C", 9)]), ("2024-01-29T06:00:00Z", [("B", 50), ("C", 40)]),
        ("2024-01-29T12:00:00Z", [("A", 61), ("B", 20), ("C", 41)])]


@settings(max_examples=2, deadline=None, suppress_health_check=list(HealthCheck))
@given(hst.permutations(range(5)), hst.sets(hst.integers(1, 4), min_size=1, max_size=2))
def test_any_order_of_runs_gives_the_same_tables(spark, tmp_path_factory, order, cuts):
    def tables(order, cuts):
        store = _store(spark, tmp_path_factory.mktemp("s"))
        at = sorted({0, 5, *cuts})
        batches = [order[a:b] for a, b in zip(at, at[1:])]
        for b, runs in enumerate(batches):
            pages = None
            for i in runs:
                p = _pages(spark, RUNS[i][0], [_m(k, bid) for k, bid in RUNS[i][1]])
                pages = p if pages is None else pages.unionByName(p)
            sp.tick_batch(pages, b, store)
        got = {n: sp.read_partitioned(spark, getattr(store, n), sch).drop("run_id") for n, sch in store.SNAPSHOTS.items()}
        got |= {"times": sp.read_times(spark, store).drop("run_id"), "history": sp.read_history(spark, store),
                "state": store.state.current(spark), "alerts": sp.read_alerts(spark, store),
                "move_stats": store.move_stats.current(spark), "runs": sp.read_runs(spark, store).drop("run_id")}
        return {n: sorted(map(str, df.collect())) for n, df in got.items()}

    if "want" not in _ANY_ORDER:
        _ANY_ORDER["want"] = tables(list(range(5)), [2])
    assert tables(order, cuts) == _ANY_ORDER["want"]


_ANY_ORDER: dict = {}


def test_a_delivered_alert_stays_when_a_late_run_changes_what_fired(spark, tmp_path):
    store = _store(spark, tmp_path)
    sp.tick_batch(_pages(spark, "2024-01-30T06:00:00Z", [_m("A", 20)]), 0, store)
    sp.tick_batch(_pages(spark, "2024-01-30T18:00:00Z", [_m("A", 40)]), 1, store)
    (row,) = sp.read_history(spark, store).collect()
    sent = sp.read_history(spark, store).withColumn("sent", F.lit(True))
    sp.write_run(spark.createDataFrame(sent.collect(), sp.ALERT_HISTORY), store.history, "triggered_at")
    sp.tick_batch(_pages(spark, "2024-01-30T12:00:00Z", [_m("A", 35)]), 2, store)
    got = {r.triggered_at.hour: (r.sent, r.actual_value) for r in sp.read_history(spark, store).collect()}
    assert got == {18: (True, 20.0), 12: (False, 15.0)}


def test_alerts_of_many_runs_keep_the_cooldown(spark, tmp_path):
    store = _store(spark, tmp_path)
    pages = None
    for k, hm in enumerate(("00:00", "00:20", "00:40", "01:00", "01:20", "03:00")):
        p = _pages(spark, f"2024-01-30T{hm}:00Z", [_m("A", 10 + 5 * k)])
        pages = p if pages is None else pages.unionByName(p)
    sp.tick_batch(pages, 0, store)
    # The first run has nothing before it; an hour must have gone by (strictly) after a trigger.
    assert sorted(f"{r.triggered_at:%H:%M}" for r in sp.read_history(spark, store).collect()) == ["00:20", "03:00"]
    assert sp.read_alerts(spark, store).first().last_triggered_at == t("2024-01-30 03:00:00")


def test_events_of_a_run_split_over_batches_keep_their_first_row(spark, tmp_path):
    from pricescope.schemas import PROB_EVENTS, PROB_STATE
    store = sp.ProbStore(str(tmp_path / "p"), buckets=2)
    store.initialise(spark, spark.createDataFrame([], PROB_STATE), spark.createDataFrame([], PROB_EVENTS), spark.createDataFrame([], ALERTS))

    def page(no, title):
        m = {"id": str(no), "conditionId": f"C{no}", "question": "q", "active": True, "closed": False, "liquidity": "1", "volume": "2",
             "volume24hr": "1", "outcomes": '["Yes","No"]', "outcomePrices": '["0.4","0.6"]'}
        ev = {"id": "E", "slug": "e", "title": title, "markets": [m]}
        return spark.createDataFrame([(json.dumps({"page_ts": "2024-01-30T12:00:00Z", "page_no": no, "last": no == 1, "events": [ev]}),)], "value string")

    sp.prob_batch(page(1, "second"), 0, store)
    sp.prob_batch(page(0, "first"), 1, store)
    assert [(r.event_id, r.event_title) for r in store.events.current(spark).collect()] == [("E", "first")]
    assert [(r.n_active, r.total_volume) for r in sp.read_partitioned(spark, store.global_snap, sp.PROB_GLOBAL).collect()] == [(2, 4.0)]


def test_queries_read_what_the_stream_wrote(spark, tmp_path):
    from pricescope.plans import registry
    from pricescope.sources.tables import from_store
    store = _store(spark, tmp_path)
    for i, bid in enumerate((20, 40, 70)):
        sp.tick_batch(_pages(spark, f"2024-01-30T{6 * i:02d}:00:00Z", [_m("A", bid), _m("B", 30)]), i, store, pick_cap=None)
    wh = from_store(spark, tick=store)
    assert wh.as_of == t("2024-01-30 12:00:00")
    top = registry.PLANS["biggest_moves_tick"](wh).collect()
    assert (top[0].market_ticker, top[0].mid_prev, top[0].mid_now, top[0].avg_move_24h) == ("A", 46.0, 76.0, 25.0)
    for name in ("top_changes_tick_mid", "global_deltas_tick", "export_runs_tick", "move_stats_tick", "spread_blowouts",
                 "mid_moves_tick", "top_events_oi", "alerts_active", "tradability_tick", "vol_index_tick"):
        assert registry.PLANS[name](wh).collect() is not None
    # a snapshot appended by another writer is seen at once
    sp.tick_batch(_pages(spark, "2024-01-30T18:00:00Z", [_m("A", 20), _m("B", 90)]), 3, store, pick_cap=None)
    again = registry.PLANS["mid_moves_tick"](from_store(spark, tick=store)).collect()
    assert again[0].market_ticker == "B" and again[0].mid_now == 96.0
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_retention_drops_whole_dates(spark, tmp_path):
    store = _store(spark, tmp_path)
    for i, day in enumerate(("2024-01-28", "2024-01-29", "2024-01-30")):
        sp.tick_batch(_pages(spark, f"{day}T12:00:00Z", [_m("A", 20 + i)]), i, store, alerts=False)
    assert sp.drop_dates(spark, store.snapshots, "2024-01-29") == ["2024-01-28"]
    left = sp.read_partitioned(spark, store.snapshots, sp.TICK_SNAPSHOT).select("snap_date").distinct().count()
    assert left == 2 and sp.drop_dates(spark, store.snapshots, "2024-01-29") == []


def test_retention_drops_old_run_rows(spark, tmp_path):
    store = _store(spark, tmp_path)
    for i, day in enumerate(("2023-01-28", "2024-01-29")):
        sp.tick_batch(_pages(spark, f"{day}T12:00:00Z", [_m("A", 20 + i)]), i, store, alerts=False)
    assert len(sp.drop_runs_before(spark, store, t("2024-01-01 00:00:00").date())) == 2      # opened and closed
    assert [r.started_at.year for r in sp.read_runs(spark, store).collect()] == [2024]


def test_stream_run_log_and_tolerated_alert_failure(spark, tmp_path):
    store = _store(spark, tmp_path)
    p0 = _pages(spark, "2024-01-30T12:00:00Z", [_m("A", 20), _m("B", 30)])
    sp.tick_batch(p0, 0, store)
    runs = sp.read_runs(spark, store).collect()
    assert [(r.run_id, r.n_markets, r.finished_at is not None) for r in runs] == [(1, 2, True)]

    class NoAlerts(sp.TickStore):                # the alert stage will fail: no alerts table here
        @property
        def alerts(self):
            return str(tmp_path / "missing-alerts")

    sp.tick_batch(_pages(spark, "2024-01-30T18:00:00Z", [_m("A", 25)]), 1, NoAlerts(store.root, buckets=2))
    runs = sorted((r.run_id, r.n_markets) for r in sp.read_runs(spark, store).collect())
    assert runs == [(1, 2), (2, 1)]                # the run still completed


def test_a_failed_alert_step_is_no_result_and_the_next_batch_does_it_again(spark, tmp_path, monkeypatch):
    from pricescope.plans import registry
    pages = [_pages(spark, f"2024-01-30T{6 * i:02d}:00:00Z", [_m("A", 20 + 15 * i * i), _m(f"K{i}", 9)]) for i in range(4)]
    whole, store = _store(spark, tmp_path / "whole"), _store(spark, tmp_path / "broken")
    for i, p in enumerate(pages):
        sp.tick_batch(p, i, whole)
    sp.tick_batch(pages[0], 0, store)
    sp.check_whole(spark, store)
    wh = type("Wh", (), {"spark": spark})()
    monkeypatch.setattr(registry, "_streamed", lambda *a, **k: store)
    with monkeypatch.context() as m:
        m.setattr(sp, "_alerts", lambda *a: 1 / 0)
        sp.tick_batch(pages[1], 1, store)                # tolerated, but written down
        sp.tick_batch(pages[2], 2, store)
    assert sorted({r.run.hour for r in sp.read_failed(spark, store).collect()}) == [6, 12]
    for name in ("stream_alerts", "stream_alerts_prob", "stream_move_stats_prob"):
        with pytest.raises(RuntimeError, match="not whole.*2 runs.*ZeroDivisionError"):
            registry.PLANS[name](wh)
    sp.tick_batch(pages[3], 3, store)                    # does the failed runs again
    assert _tables(spark, store) == _tables(spark, whole) and len(_tables(spark, whole)["history"]) == 3
    assert sp.read_failed(spark, store).count() == 0 and registry.PLANS["stream_alerts"](wh).count() == 3


def test_runs_left_out_are_written_down(spark, tmp_path):
    store = _store(spark, tmp_path)
    for i, day in enumerate((1, 9)):
        sp.tick_batch(_pages(spark, f"2024-01-{day:02d}T12:00:00Z", [_m("A", 20 + i)]), i, store)
    sp.forget_before(spark, store, late_days=2)
    sp.check_whole(spark, store)
    for _ in range(2):
        sp.tick_batch(_pages(spark, "2023-12-30T12:00:00Z", [_m("A", 1)]), 2, store)
        assert [(r.run.day, r.step) for r in sp.read_failed(spark, store).collect()] == [(30, sp.LATE)]
    with pytest.raises(RuntimeError, match="not whole.*1 runs"):
        sp.check_whole(spark, store)


def test_a_batch_that_dies_leaves_its_runs_open_until_the_replay(spark, tmp_path, monkeypatch):
    store = _store(spark, tmp_path)
    page = _pages(spark, "2024-01-30T12:00:00Z", [_m("A", 20)])
    with monkeypatch.context() as m:
        m.setattr(sp, "_snapshots", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sp.tick_batch(page, 0, store)
    assert [(r.finished_at, r.n_markets) for r in sp.read_runs(spark, store).collect()] == [(None, 0)]
    sp.tick_batch(page, 0, store)
    assert [(r.finished_at, r.n_markets) for r in sp.read_runs(spark, store).collect()] == [(t("2024-01-30 12:00:00"), 1)]


def test_a_stream_labels_its_files_by_query_and_batch(spark, tmp_path):
    store = _store(spark, tmp_path)
    sp.land_pages(_pages(spark, "2024-01-30T12:00:00Z", [_m("A", 20)]), str(tmp_path / "in"), files=1)
    for k in range(2):                             # the second stream starts anew over the same store
        sp.start_tick_stream(spark, str(tmp_path / "in"), store, str(tmp_path / f"ckpt{k}")).awaitTermination()
    labels = {p.split("batch=")[1].split("/")[0] for p in _files(store.state.path) if "batch=" in p}
    assert len(labels - {"carry"}) == 2 and not any(x.startswith("call") for x in labels)
    assert sp.read_runs(spark, store).count() == 1 and store.state.current(spark).count() == 1
