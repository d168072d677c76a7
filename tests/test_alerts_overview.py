"""A1-A8 alert rules and K8 overview rules."""

import json

from pyspark.sql import functions as F

from helpers import t
from pricescope.operators import alerts as al
from pricescope.operators import overview as ov
from pricescope.schemas import ALERTS
from pricescope.sources import feeds

AS_OF = "2024-01-31 00:00:00"


def _alerts(spark, rows):
    full = []
    for i, (platform, key, typ, thr, last) in enumerate(rows):
        full.append((i, "u@example.com", platform, key, typ, thr, True, t("2024-01-01 00:00:00"),
                     None if last is None else t(last)))
    return spark.createDataFrame(full, ALERTS)


def _movers(spark):
    return spark.createDataFrame(
        [("tick", "M1", "Market one", 55.0, 50.0, 5.0, 5.0, 1000.0, 2.0)],
        "platform string, market_key string, title string, price_now double, price_prev double, move double, "
        "abs_move double, volume double, volatility_score double")


def test_alert_rules(spark):
    a = _alerts(spark, [
        ("tick", "M1", "PRICE_MOVE", 5.0, None),            # threshold equal fires
        ("tick", "M1", "VOLATILITY_SPIKE", 2.5, None),      # below threshold
        ("tick", "M1", "VOLUME_SURGE", 1000.0, None),       # cumulative volume, equal fires
        ("tick", "M1", "SOMETHING", 0.0, None),             # unknown type never fires
        ("other", "M1", "PRICE_MOVE", 0.0, None),           # unknown platform never matches
        ("tick", "M404", "PRICE_MOVE", 0.0, None),          # market not among movers
        ("tick", "M1", "PRICE_MOVE", 0.0, "2024-01-30 23:00:00"),   # exactly 1 h ago: cooldown
        ("tick", "M1", "PRICE_MOVE", 0.0, "2024-01-30 22:59:59"),   # just outside the cooldown
    ])
    fired = sorted(r.alert_id for r in al.evaluate(a, _movers(spark), AS_OF).collect())
    assert fired == [0, 2, 7]


def test_stamp_and_second_run(spark):
    a = _alerts(spark, [("tick", "M1", "PRICE_MOVE", 1.0, None)])
    fired = al.evaluate(a, _movers(spark), AS_OF)
    stamped = al.stamp_alerts(a, fired)
    assert stamped.first().last_triggered_at == t(AS_OF)
    assert al.evaluate(stamped, _movers(spark), "2024-01-31 00:30:00").count() == 0


def test_outbox_rendering(spark):
    long_title = "x" * 70
    trig = spark.createDataFrame(
        [(1, 7, "u@x", "tick", "M1", "PRICE_MOVE", 5.0, 5.5, long_title, 55.5, 50.0, -5.5),
         (2, 8, "v@x", "prob", "C1", "VOLUME_SURGE", 1.0, 2.0, None, 0.466, 0.4, 0.066)],
        "history_id long, alert_id long, user_email string, platform string, market_key string, "
        "alert_type string, threshold double, actual_value double, title string, price_now double, "
        "price_prev double, move double")
    rows = {r.alert_id: r for r in al.outbox(trig).collect()}
    assert rows[7].subject == "Market alert: " + "x" * 57 + "..."
    assert rows[7].body.startswith("Your price move alert on x")
    assert "a move of -5 ticks" in rows[7].body and "to 55¢" in rows[7].body
    assert rows[8].subject == "Market alert: C1"
    assert "to 46.6%" in rows[8].body and "a move of +6.6pp" in rows[8].body


def test_delivery_write_back(spark):
    from pricescope.schemas import ALERT_HISTORY
    h = spark.createDataFrame([(1, 7, t(AS_OF), "M1", "PRICE_MOVE", 5.0, 5.0, False, None),
                               (2, 8, t(AS_OF), "M1", "PRICE_MOVE", 5.0, 5.0, False, None)], ALERT_HISTORY)
    res = spark.createDataFrame([(1, True, None)], "history_id long, ok boolean, error string")
    got = {r.history_id: r.sent for r in al.mark_delivery(h, res).collect()}
    assert got == {1: True, 2: False}


def test_overview_rules(spark):
    ms = [{"ticker": "A", "series_id": "S1", "event_id": "E", "event_title": "first", "close_ts": "c1"},
          {"ticker": "B", "series_id": "S1", "event_id": "E", "event_title": "second"},
          {"ticker": "C", "series_id": "S2", "event_id": "E", "event_title": "other"},
          {"ticker": "D", "event_id": "E2"},
          {"ticker": "F", "series_id": None, "event_id": "E3"}]
    pages = spark.createDataFrame([(json.dumps({"page_ts": "p", "page_no": 0, "markets": ms}),)], "value string")
    flat = ov.overview_flat(feeds.tick_markets(pages))
    rows = {r.ticker: r for r in flat.collect()}
    assert rows["B"].event_title == "first" and rows["B"].event_close_ts == "c1"   # first market wins
    assert rows["D"].series_id == "UNKNOWN_SERIES"                                  # absent key
    assert rows["F"].series_id is None                                              # explicit null kept
    meta = ov.overview_metadata(flat, AS_OF).first()
    assert meta.market_count == 5 and meta.event_count == 4 and meta.series_count == 4
    chunks = ov.overview_chunks(flat).collect()
    doc = json.loads([c.value for c in chunks if c.series_id == "S1"][0])
    assert [m["ticker"] for m in doc["markets"]] == ["A", "B"]


def test_overview_parts_are_one_valid_document(spark, tmp_path):
    import json

    from pricescope.constants import OVERVIEW_MARKET_FIELDS
    fields = ("series_id string, event_id string, event_title string, event_close_ts string, ticker string, title string, status string, "
              "yes_ask int, no_ask int, volume long, open_interest long, close_ts string, page_ts string, page_no long, pos int")
    rows = [(f"S{i % 3}" if i % 5 else None, f"E{i % 4}", f'T"{i % 4}"', "c", f"M{i}", "t,\n", "active", i, None, i, 2, "z", "p", i // 4, i % 4)
            for i in range(60)]
    flat = spark.createDataFrame(rows, fields).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ov.write_overview(flat, str(tmp_path / "doc"), "2024-01-31 00:00:00", pages_per_chunk=2)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted(p for p in (tmp_path / "doc").iterdir() if p.name.startswith("part-"))
    doc = json.loads("".join(p.read_text() for p in parts))
    assert len(parts) > 1 and (doc["market_count"], doc["event_count"], doc["series_count"]) == (60, len({r[:2] for r in rows}), 4)
    got = [(e.get("series_id"), e["event"]["event_id"], m["ticker"]) for e in doc["events"] for m in e["markets"]]
    assert sorted(got, key=str) == sorted(((r[0], r[1], r[4]) for r in rows), key=str)
    back = ov.read_overview(spark, str(tmp_path / "doc"))
    assert back.columns == ["series_id", "event_id", "event_title", "event_close_ts", *OVERVIEW_MARKET_FIELDS]
    assert sorted(map(str, back.collect())) == sorted(map(str, flat.select(*back.columns).collect()))
    ov.write_overview(flat.limit(0), str(tmp_path / "none"), "2024-01-31 00:00:00")
    none = "".join(p.read_text() for p in sorted((tmp_path / "none").iterdir()) if p.name.startswith("part-"))
    assert json.loads(none)["events"] == []
