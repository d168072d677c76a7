"""Build and stream steps whose work must follow the rows: one exchange a page, large buckets split, state read once."""

import glob
import json
import os

from pyspark.sql import functions as F

from helpers import t, tick_state
from pricescope.schemas import ALERTS
from pricescope.sources import fixtures as fx
from pricescope.sources import tables as tb
from pricescope.streaming import pipeline as sp
from pricescope.streaming.history import KeyHistory


def _events(spark):
    rows = [(i, t(f"2024-01-{1 + i % 3:02d} {6 * (i % 4):02d}:30:00"), i % 60, "view", float(i), "{}") for i in range(600)]
    return spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")


def _customers(spark):
    return spark.createDataFrame([(i, i % 5, "S", float(i)) for i in range(60)],
                                 "c_custkey long, c_nationkey long, c_mktsegment string, c_acctbal double")


def _nations(spark):
    return spark.createDataFrame([(i, f"N{i}") for i in range(5)], "n_nationkey long, n_name string")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pages_are_built_in_one_exchange_without_a_window_over_a_run(spark):
    obs = fx.observations(_events(spark)).localCheckpoint()
    prob = fx.prob_snapshots_with_user(obs, _customers(spark)).localCheckpoint()
    for pages in (fx.tick_pages(fx.tick_snapshots_with_user(obs).localCheckpoint()), fx.prob_pages(prob, _nations(spark))):
        plan = _plan(pages)
        assert "Window" not in plan and plan.count("Exchange hashpartitioning(snap_ts") <= 2     # the rows, and the last pages
        got = [json.loads(r.value) for r in pages.collect()]
        newest = {}
        for p in got:
            newest[p["page_ts"]] = max(p["page_no"], newest.get(p["page_ts"], 0))
        assert got and all(p["last"] == (p["page_no"] == newest[p["page_ts"]]) for p in got)


def test_stored_snapshots_give_the_tables_of_the_lazy_ones(spark, tmp_path):
    src, root = str(tmp_path / "src"), str(tmp_path / "tables")
    for name, df in (("events", _events(spark)), ("customer", _customers(spark)), ("nation", _nations(spark))):
        df.write.parquet(f"{src}/{name}.parquet")
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    lazy, stored = tb.from_testdata(spark, src), tb.from_testdata(spark, src, stored=root)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
    for name in ("tick_state", "prob_state", "prob_events", "tick_runs", "prob_global", "tick_pages", "prob_pages"):
        rows = [sorted(map(str, wh.tables[name].collect())) for wh in (lazy, stored)]
        assert rows[0] and rows[0] == rows[1], name


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    h = KeyHistory(str(tmp_path / "h"), "k", spark.createDataFrame([], "k string, v string").schema, buckets=1)
    rows = spark.range(40_000).select(F.col("id").cast("string").alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("v"))
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}
    before = {c: spark.conf.get(c) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        h.initialise(rows.repartition(8))
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert len(glob.glob(f"{h.path}/rows/seg=-1/bucket=0/batch=carry/*.parquet")) > 1
    assert h.current(spark).count() == 40_000


def test_a_batch_holds_nothing_in_memory_and_leaves_no_scratch(spark, tmp_path):
    store = sp.TickStore(str(tmp_path / "tables"), buckets=2)
    state = tick_state(spark, [{"market_ticker": "A", "status": "active", "yes_bid": 10, "yes_ask": 12, "title": "old",
                                "raw": '{"event_ticker":"E1"}', "updated_at": t("2024-01-01 00:00:00")}])
    store.initialise(spark, state, spark.createDataFrame([], ALERTS))
    market = {"ticker": "B", "status": "active", "yes_bid": 5, "yes_ask": 9, "volume": 7, "open_interest": 1, "event_ticker": "E2"}
    page = {"page_ts": "2024-01-30T12:00:00Z", "page_no": 0, "markets": [market]}
    sp.tick_batch(spark.createDataFrame([(json.dumps(page),)], "value string"), 0, store)
    assert not os.path.exists(f"{store.root}/work/call-0")
    got = sp.read_partitioned(spark, store.snapshots, sp.TICK_SNAPSHOT).collect()
    assert {(r.market_ticker, r.series_ticker, r.spread_ticks) for r in got} == {("A", "E1", 2), ("B", "E2", 4)}
    held = store.state.at_runs(spark, {t("2024-01-30 12:00:00"): 1}, sp.TICK_JOB.reads())
    assert "raw" not in held.columns and "raw_event" in held.columns
    assert not [l for l in _plan(held).splitlines() if "Exchange" in l and "raw#" in l]
