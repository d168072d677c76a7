"""Properties of B (base-snapshot lookup) and K1 (keyed upsert) against
plain-Python statements of the rules, on random inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricescope.operators import ingest as ig
from pricescope.operators import lookback as lb

T0 = dt.datetime(2024, 1, 30, 0, 0)


def base_rule(times, h):
    """Newest time <= latest - h; else newest time < latest; else none."""
    latest = max(times)
    old = [t for t in times if t <= latest - dt.timedelta(hours=h)]
    if old:
        return max(old)
    earlier = [t for t in times if t < latest]
    return max(earlier) if earlier else None


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(min_value=0, max_value=200), min_size=1, max_size=12),
       st.lists(st.integers(min_value=1, max_value=60), min_size=1, max_size=5, unique=True))
def test_base_lookup_rule(spark, minutes_x15, hours_list):
    times = [T0 + dt.timedelta(minutes=15 * m) for m in minutes_x15]
    snaps = spark.createDataFrame([(t, "K") for t in times], "snap_ts timestamp_ntz, market_ticker string")
    got = {r.lookback_hours: r.base_ts for r in lb.base_table(snaps, hours_list).collect()}
    assert got == {h: base_rule(times, h) for h in hours_list}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ABCDE"), st.integers(0, 3), st.integers(0, 5), st.integers(0, 99)),
                min_size=1, max_size=40),
       st.lists(st.sampled_from("ABCFG"), max_size=5, unique=True))
def test_upsert_latest_version_wins(spark, incoming, stored_keys):
    """Stored keys not in the pages stay; otherwise the row with the greatest
    (page_ts, page_no, pos) wins, whatever order the rows arrive in."""
    rows, seen = [], set()
    for key, page, pos, value in incoming:
        if (page, pos) in seen:                 # (page_ts, page_no, pos) identifies a row
            continue
        seen.add((page, pos))
        rows.append((key, f"2024-01-30T{page:02d}:00:00Z", 0, pos, value))
    inc = spark.createDataFrame(rows, "k string, page_ts string, page_no long, pos int, v int")
    old = spark.createDataFrame([(k, -1, dt.datetime(2024, 1, 1)) for k in stored_keys],
                                "k string, v int, updated_at timestamp_ntz")
    new = {r.k: r.v for r in ig.upsert(old, inc, "k", ["page_ts", "page_no", "pos"],
                                       "2024-01-31 00:00:00").collect()}
    expect = {k: -1 for k in stored_keys}
    best = {}
    for key, page_ts, _, pos, value in rows:
        if key not in best or (page_ts, pos) > best[key][0]:
            best[key] = ((page_ts, pos), value)
    expect.update({k: v for k, (_, v) in best.items()})
    assert new == expect
