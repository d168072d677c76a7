"""Command-line jobs, e.g. ``spark-submit --py-files pricescope.zip -m pricescope.jobs ...``.

    query    run a registered plan over stored tables; write Parquet or show rows
    init     create a stream store (state, events, alerts) from stored tables
    stream   run a venue's ingest / snapshot / alert stream (once, or every interval)
    maintain forget the state history that late runs can no longer need
    retain   delete the snapshot dates and run log rows older than the retention periods
"""

from __future__ import annotations

import argparse
import sys

from pricescope.session import build_session


def _store(venue: str, root: str):
    from pricescope.streaming import pipeline as sp
    return (sp.TickStore if venue == "tick" else sp.ProbStore)(root)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="pricescope.jobs")
    sub = p.add_subparsers(dest="cmd", required=True)
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--root", help="folder of the stored tables")
    q.add_argument("--tick-store", help="or the stores that the streams write")
    q.add_argument("--prob-store")
    q.add_argument("--as-of", help="the time to ask as of (default: the latest snapshot)")
    q.add_argument("--out", help="write the result as Parquet here")
    q.add_argument("--show", type=int, default=20)
    i = sub.add_parser("init")
    i.add_argument("--venue", choices=["tick", "prob"], required=True)
    i.add_argument("--root", required=True, help="folder of the stored tables to start from")
    i.add_argument("--store", required=True)
    s = sub.add_parser("stream")
    s.add_argument("--venue", choices=["tick", "prob"], required=True)
    s.add_argument("--landing", required=True)
    s.add_argument("--store", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--once", action="store_true", help="process what has landed, then stop")
    s.add_argument("--no-alerts", action="store_true")
    s.add_argument("--pick-cap", type=int, help="rows of each market list (0: all markets)")
    m = sub.add_parser("maintain")
    m.add_argument("--venue", choices=["tick", "prob"], required=True)
    m.add_argument("--store", required=True)
    m.add_argument("--late-days", type=int, default=7, help="runs up to this many days before the newest one are still placed")
    r = sub.add_parser("retain")
    r.add_argument("--venue", choices=["tick", "prob"], required=True)
    r.add_argument("--store", required=True)
    r.add_argument("--as-of", required=True, help="the day to count back from (YYYY-MM-DD)")
    a = p.parse_args(argv)
    spark = build_session()

    if a.cmd == "query":
        from pricescope.plans.registry import PLANS
        from pricescope.sources.tables import from_parquet, from_store
        if a.root:
            wh = from_parquet(spark, a.root, a.as_of)
        else:
            wh = from_store(spark, a.tick_store and _store("tick", a.tick_store),
                            a.prob_store and _store("prob", a.prob_store), a.as_of)
        df = PLANS[a.name](wh)
        if a.out:
            df.write.mode("overwrite").parquet(a.out)
        else:
            df.show(a.show, truncate=False)
    elif a.cmd == "init":
        from pricescope.sources.tables import from_parquet
        wh = from_parquet(spark, a.root)
        store = _store(a.venue, a.store)
        if a.venue == "tick":
            store.initialise(spark, wh.tick_state, wh.alerts)
        else:
            store.initialise(spark, wh.prob_state, wh.prob_events, wh.alerts)
    elif a.cmd == "stream":
        from pricescope.streaming import pipeline as sp
        start = sp.start_tick_stream if a.venue == "tick" else sp.start_prob_stream
        store = _store(a.venue, a.store)
        q_ = start(spark, a.landing, store, a.checkpoint, available_now=a.once,
                   alerts=not a.no_alerts, **({} if a.pick_cap is None else {"pick_cap": a.pick_cap or None}))
        q_.awaitTermination()
        sp.check_whole(spark, store)
    elif a.cmd == "maintain":
        from pricescope.streaming import pipeline as sp
        print(sp.forget_before(spark, _store(a.venue, a.store), a.late_days))
    elif a.cmd == "retain":
        import datetime as dt

        from pricescope.constants import RETENTION_DAYS
        from pricescope.streaming import pipeline as sp
        store = _store(a.venue, a.store)
        for kind, name in (("market_snapshots", "snapshots"),
                           ("series_snapshots", "series" if a.venue == "tick" else "event_snaps")):
            before = dt.date.fromisoformat(a.as_of) - dt.timedelta(days=RETENTION_DAYS[kind])
            print(name, sp.drop_dates(spark, getattr(store, name), before.isoformat()))
        before = dt.date.fromisoformat(a.as_of) - dt.timedelta(days=RETENTION_DAYS["export_runs"])
        print("runs", sp.drop_runs_before(spark, store, before))
    return 0


if __name__ == "__main__":
    sys.exit(main())
