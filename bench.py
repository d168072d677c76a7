"""Benchmark: build the stored tables once, then time every registered plan.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

1. ``build_tables``: the fixture derivations of the test tables are
   materialised as Parquet under the session's checkpoint folder (snapshot
   tables partitioned by snapshot date, move statistics stored as the
   exporter would) -- the production shape the queries read.
2. Every plan of the registry (streaming drivers excepted) runs against
   those tables; each is executed in full through the ``noop`` sink, once
   cold and once warm, and the warm time is reported.
3. ``streams``: the two venues' Structured Streaming drivers run once end to
   end (landing, ingest, snapshots, statistics and alerts per micro-batch)
   over the same pages; reported separately (``BENCH_STREAMS=0`` skips).

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pricescope.plans import registry  # noqa: E402
from pricescope.session import build_session, checkpoint_root  # noqa: E402
from pricescope.sources.tables import BUCKETED, from_testdata, write_parquet  # noqa: E402

SKIP_PREFIX = ("stream_",)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [a for a in sys.argv[1:]]
    spark = build_session(f"local[{cpus}]", app="pricescope-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    root = f"{checkpoint_root(spark)}/bench-{uuid.uuid4().hex[:8]}"

    t0 = time.time()
    wh = write_parquet(from_testdata(spark, sf_dir, stored=root), root, written=tuple(BUCKETED))
    build = time.time() - t0

    cold, warm, failed = {}, {}, {}
    for name, plan in registry.PLANS.items():
        if name.startswith(SKIP_PREFIX) or (only and not any(o in name for o in only)):
            continue
        try:
            t = time.time()
            run(plan(wh))
            cold[name] = round(time.time() - t, 3)
            t = time.time()
            run(plan(wh))
            warm[name] = round(time.time() - t, 3)
        except Exception as e:  # noqa: BLE001
            failed[name] = str(e)[:200]
    streams = {}
    if os.environ.get("BENCH_STREAMS", "1") != "0" and not only:
        from pricescope.plans.registry import _run_prob_stream, _run_stream
        t = time.time()
        _run_stream(wh, alerts=True)
        streams["tick_stream_end_to_end"] = round(time.time() - t, 3)
        t = time.time()
        _run_prob_stream(wh, alerts=True)
        streams["prob_stream_end_to_end"] = round(time.time() - t, 3)
    total = round(sum(warm.values()), 3)
    out = {"metric": "total_warm_query_sec", "value": total, "unit": "sec", "queries": warm,
           "queries_cold": cold, "build_tables_sec": round(build, 3), "n_queries": len(warm),
           "streams": streams,
           "sf": os.path.basename(sf_dir).replace("sf", ""), "cpus": cpus}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()
