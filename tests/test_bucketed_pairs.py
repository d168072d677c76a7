"""B, T10, T14, T15, P12-P14: two snapshot times meet bucket by bucket."""

import pytest

from helpers import tick_snaps
from pricescope.operators import lookback as lb
from pricescope.sources import tables as tb


@pytest.fixture(scope="module")
def snaps(spark, tmp_path_factory):
    rows = [(f"2024-01-{d:02d} {h:02d}:00:00", f"M{i}", float(10 + (i * d + h) % 60), 2, i, i) for d in (1, 2, 3) for h in (0, 12) for i in range(50)]
    path = str(tmp_path_factory.mktemp("b") / "tick_snapshots")
    tb.write_bucketed(tick_snaps(spark, rows), path, "market_ticker", 4)
    return path


def test_a_pair_join_has_no_exchange_and_no_broadcast(spark, snaps):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = tb.read_bucketed(spark, snaps)
        latest = lb.latest_ts(df)
        p = lb.pair(df, "market_ticker", latest, lb.base_ts(df, 12, latest=latest), ["mid"])
        rows = p.collect()
        plan = p._jdf.queryExecution().executedPlan().toString()
        join = plan[:plan.index("Subquery")] if "Subquery" in plan else plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(rows) == 50 and {str(r.snap_ts_prev) for r in rows} == {"2024-01-03 00:00:00"}
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning(market_ticker" not in plan and "BroadcastHashJoin" not in join
    assert plan.count("Bucketed: true") >= 2


def test_one_market_reads_one_bucket(spark, snaps):
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")     # the plan names the buckets then
    try:
        df = tb.read_bucketed(spark, snaps).where("market_ticker = 'M7'")
        assert df.count() == 6
        assert "SelectedBucketsCount: 1 out of 4" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def test_the_table_is_read_again_from_its_files(spark, snaps):
    before = sorted(map(tuple, tb.read_bucketed(spark, snaps).collect()))
    spark.sql(f"DROP TABLE {tb._table_name(snaps)}")       # as a new session sees it
    assert sorted(map(tuple, tb.read_bucketed(spark, snaps).collect())) == before
    spark.table(tb._table_name(snaps)).where("snap_date = '2024-01-02'").select("mid").limit(1).collect()


def test_plain_parquet_still_reads(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "x"))
    assert tb.read_bucketed(spark, str(tmp_path / "x")).count() == 3
