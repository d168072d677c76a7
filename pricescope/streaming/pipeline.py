"""Incremental ingest, per-run snapshots and alerts with Structured
Streaming (R1-R3).

Landed feed pages (one JSON page per line) are read as a file-source
stream.  A *run* is what shares a ``page_ts``, however its pages were split
into files and micro-batches, and whenever they land.  Each micro-batch,
inside ``foreachBatch``, does for all its runs at once:

1. R1 -- opens the runs' rows of the run log (K4), normalises the pages (I1/I8)
   and adds them to the keyed state (K1-K3, ``history.KeyHistory``);
2. R2 -- writes the global, group and market snapshots (N1-N6) of every run
   that the batch changes: its own and, if they come late, all later ones,
   each from the state as of its time.  A run's snapshot is one partition
   that is replaced.  Then the runs' rows are closed;
3. move statistics (M1/M2) of these runs, kept by key (K6), then R3 -- alerts
   with the cooldown (A1-A6) -- for runs whose last page has come (a page
   says ``"last": false`` when more of its run follow).  As in the
   reference, a failure in step 3 is tolerated; one in steps 1-2 fails the
   batch, and the stream retries it from its checkpoint.  What was tolerated
   is written down in the store (``failed``): the next batch does these runs
   again, and until then ``check_whole`` refuses the store's results.

So the tables do not depend on how pages are split or in which order runs
come (but for run numbers, given in order of arrival, and alerts delivered
before, which stay), and a replayed batch replaces what it wrote.  Work per
batch follows its own rows, its runs' segment of the state and seven days of
snapshots.
"""

from __future__ import annotations

import datetime as dt
import logging
from bisect import bisect_right
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from pricescope.constants import COOLDOWN_HOURS, MOVE_LOOKBACK_DAYS, MOVER_LOOKBACK_HOURS, PICK_CAP
from pricescope.functions.exprs import event_from_raw, local_rows, ts_lit
from pricescope.operators import alerts as al
from pricescope.operators import ingest as ig
from pricescope.operators import snapshots as sn
from pricescope.operators import stats as st
from pricescope.schemas import (ALERT_HISTORY, ALERTS, EXPORT_RUNS, MOVE_STATS_PROB, MOVE_STATS_TICK, PROB_EVENT_SNAPSHOT,
                                PROB_EVENTS, PROB_GLOBAL, PROB_SNAPSHOT, PROB_STATE, TICK_GLOBAL, TICK_SERIES,
                                TICK_SNAPSHOT, TICK_STATE)
from pricescope.sources import feeds
from pricescope.streaming.history import KeyHistory, _replace
from pricescope.venues import PROB, TICK, Venue

TIMES = "snap_ts timestamp_ntz, run_id long, n_markets long"
#: Runs evaluated in one plan; a batch that holds or changes more goes through them in order.
RUNS_AT_ONCE = 200
#: What a batch could not do for a run: the steps are STATS (done again by the next batch) and LATE (never).
_FAILED = "run timestamp_ntz, step string, error string"
STATS, LATE = "move statistics and alerts", "runs before the oldest state kept"
#: A stored run log row: the run, whether it is closed and complete, and the number of the batch that wrote it.
_LOGGED = T.StructType([*EXPORT_RUNS.fields, T.StructField("phase", T.IntegerType()),
                        T.StructField("complete", T.BooleanType()), T.StructField("seq", T.LongType())])
log = logging.getLogger(__name__)


# ------------------------------------------------------------ table helpers
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of a stored table."""
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def drop_dates(spark: SparkSession, path: str, before: str) -> list[str]:
    """K7 on a stored table: delete the ``snap_date`` partitions older than
    ``before`` (YYYY-MM-DD), whole directories at a time.  Returns the dates."""
    fs, root, _ = _fs(spark, path)
    if not fs.exists(root):
        return []
    gone = []
    for st_ in fs.listStatus(root):
        name = st_.getPath().getName()
        if st_.isDirectory() and name.startswith("snap_date=") and name[10:] < before[:10]:
            fs.delete(st_.getPath(), True)
            gone.append(name[10:])
    return sorted(gone)


def forget_before(spark: SparkSession, store, late_days: int) -> dict[str, list[int]]:
    """Drop the segments of the keyed tables that no run of the last ``late_days`` days needs; table -> segments.
    A run that comes later still is left out (and logged), for the state of its time is gone."""
    newest = read_runs(spark, store).agg(F.max("started_at")).first()[0]
    if newest is None:
        return {}
    since = newest - dt.timedelta(days=late_days)
    return {name: getattr(store, name).drop_before(spark, since, lambda path: delete_path(spark, path)) for name in store.KEYED}


def drop_runs_before(spark: SparkSession, store, before: dt.date) -> list[str]:
    """K7 for the run log: delete the batches all of whose runs started before ``before``; returns their labels."""
    logged = spark.read.schema(T.StructType([*_LOGGED.fields, T.StructField("batch", T.StringType())])).parquet(store.runs)
    old = logged.groupBy("batch").agg(F.max("started_at").alias("t")).where(F.col("t") < ts_lit(f"{before} 00:00:00"))
    gone = sorted(r.batch for r in old.collect())
    for batch in gone:
        delete_path(spark, f"{store.runs}/batch={batch}")
    return gone


def write_run(df: DataFrame, path: str, ts_col: str = "snap_ts") -> None:
    """Write the rows of one or more runs, replacing what is stored of them.
    Rows are dealt out by run; AQE splits runs that are large."""
    run = F.date_format(F.col(ts_col), "yyyyMMdd'T'HHmmss")
    df = df.drop("snap_date", "snap_run").withColumn("snap_date", F.to_date(F.col(ts_col))).withColumn("snap_run", run)
    _replace(df.hint("rebalance", "snap_run"), path, "snap_date", "snap_run")


def drop_runs(spark: SparkSession, path: str, runs: list[dt.datetime]) -> None:
    """Remove the partitions of ``runs``, before they are written anew."""
    for t in runs:
        delete_path(spark, f"{path}/snap_date={t:%Y-%m-%d}/snap_run={t:%Y%m%dT%H%M%S}")


def read_partitioned(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table written by ``write_run``, read with its declared schema (it
    may still be empty, in which case there is no footer to infer from).
    The ``snap_date`` partition column is kept so predicates can prune."""
    full = T.StructType([*schema.fields, T.StructField("snap_date", T.DateType(), True),
                         T.StructField("snap_run", T.StringType(), True)])
    return spark.read.schema(full).parquet(path).drop("snap_run")


def read_history(spark: SparkSession, store) -> DataFrame:
    """The alert history rows."""
    return read_partitioned(spark, store.history, ALERT_HISTORY).drop("snap_date")


def read_alerts(spark: SparkSession, store) -> DataFrame:
    """The subscriptions with the time each last fired: its own stamp or its newest history row."""
    fired = read_history(spark, store).groupBy("alert_id").agg(F.max("triggered_at").alias("_t"))
    subs = spark.read.schema(ALERTS).parquet(store.alerts)
    last = F.greatest("last_triggered_at", "_t").alias("last_triggered_at")
    return subs.join(fired, "alert_id", "left").select(*[last if c == "last_triggered_at" else F.col(c) for c in ALERTS.names])


def read_times(spark: SparkSession, store) -> DataFrame:
    """The per-run times table (snap_ts, run_id, n_markets)."""
    return read_partitioned(spark, store.times, T.StructType.fromDDL(TIMES)).drop("snap_date")


def read_runs(spark: SparkSession, store, full: bool = False) -> DataFrame:
    """The run log: one row a run, closed if any batch closed it (``full``: with complete, phase and seq)."""
    logged = spark.read.schema(T.StructType([*_LOGGED.fields, T.StructField("batch", T.StringType())])).parquet(store.runs)
    g = logged.groupBy("run_id").agg(F.max_by(F.struct(*EXPORT_RUNS.names), F.struct("phase", "seq")).alias("r"),
                                     F.max("phase").alias("phase"), F.max("complete").alias("complete"),
                                     F.max("seq").alias("seq"))
    return g.select("r.*", *(["phase", "complete", "seq"] if full else []))


def read_failed(spark: SparkSession, store) -> DataFrame:
    """What batches could not do and no later one has made good: (run, step, error, batch)."""
    schema = T.StructType([*T.StructType.fromDDL(_FAILED).fields, T.StructField("batch", T.StringType())])
    fs, path, _ = _fs(spark, store.failed)
    return spark.read.schema(schema).parquet(store.failed) if fs.exists(path) else spark.createDataFrame([], schema)


def check_whole(spark: SparkSession, store) -> None:
    """Raise if a run of the store lacks a step: its tables are not the result of all runs then."""
    got = read_failed(spark, store).groupBy("step").agg(F.countDistinct("run").alias("n"), F.min("run").alias("run"), F.min("error").alias("error"))
    if lacks := [f"{r.step}: {r.n} runs, the first {r.run} ({r.error})" for r in got.orderBy("step").collect()]:
        raise RuntimeError(f"{store.root} is not whole: " + "; ".join(lacks))


def _note_failed(spark: SparkSession, store, label: str, step: str, runs: list[dt.datetime], error: str) -> None:
    """Write down that ``step`` was not done for ``runs``; a replay replaces it."""
    rows = local_rows(spark, [(t, step, error) for t in runs], _FAILED).coalesce(1)
    _replace(rows.withColumn("batch", F.lit(f"{label}-{'late' if step == LATE else 'stats'}")), store.failed, "batch")


def runs_in(pages: DataFrame) -> dict[dt.datetime, bool]:
    """The runs a batch holds pages of: time -> complete (a page of it is not marked ``"last": false``)."""
    p = pages.select(F.from_json("value", "struct<page_ts:string, last:boolean>").alias("p")).select("p.*")
    got = p.groupBy(ig.parse_ts(F.col("page_ts")).alias("t")).agg(F.max(F.coalesce("last", F.lit(True))).alias("done"))
    return {r["t"]: r["done"] for r in sorted(got.where("t is not null").collect())}


def batch_label(spark: SparkSession, batch_id: int) -> str:
    """Name of a batch's files: the same for a replay, another for a stream that starts anew."""
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{(query or 'call')[:8]}-{batch_id}"


class TickStore:
    """The tick venue's stored tables under ``root``: paths, and the keyed tables."""

    #: Fields and keys of the tables kept as key histories.
    KEYED = {"state": ("market_ticker", TICK_STATE), "move_stats": ("market_ticker", MOVE_STATS_TICK)}
    SNAPSHOTS = {"snapshots": TICK_SNAPSHOT, "global_snap": TICK_GLOBAL, "series": TICK_SERIES}

    def __init__(self, root: str, buckets: int = 8, hours: int = 24):
        self.root = root.rstrip("/")
        for name, (key, fields) in self.KEYED.items():
            setattr(self, name, KeyHistory(f"{self.root}/{name}", key, fields, buckets, hours))

    def __getattr__(self, name: str) -> str:
        if name.startswith("_"):
            raise AttributeError(name)
        return f"{self.root}/{name}"

    def initialise(self, spark: SparkSession, state: DataFrame, alerts: DataFrame, **keyed: DataFrame) -> None:
        """The tables a stream starts from: the given state and alerts, empty histories."""
        for name, rows in {"state": state, "move_stats": spark.createDataFrame([], self.KEYED["move_stats"][1]), **keyed}.items():
            getattr(self, name).initialise(rows)
        alerts.write.mode("overwrite").parquet(self.alerts)
        _replace(spark.createDataFrame([], _LOGGED).withColumn("batch", F.lit("")), self.runs, "batch")
        for name, schema in self.SNAPSHOTS.items():
            write_run(spark.createDataFrame([], schema), getattr(self, name))
        write_run(spark.createDataFrame([], ALERT_HISTORY), self.history, "triggered_at")
        write_run(spark.createDataFrame([], TIMES), self.times)


class ProbStore(TickStore):
    """The probability venue's stored tables under ``root``."""

    KEYED = {"state": ("condition_id", PROB_STATE), "events": ("event_id", PROB_EVENTS),
             "move_stats": ("condition_id", MOVE_STATS_PROB)}
    SNAPSHOTS = {"snapshots": PROB_SNAPSHOT, "global_snap": PROB_GLOBAL, "event_snaps": PROB_EVENT_SNAPSHOT}

    def initialise(self, spark: SparkSession, state: DataFrame, events: DataFrame, alerts: DataFrame) -> None:
        """As for the tick venue, and the events."""
        super().initialise(spark, state, alerts, events=events)


# ------------------------------------------------------------------ one batch
@dataclass(frozen=True)
class VenueJob:
    """What differs between the venues in one micro-batch."""

    venue: Venue
    order: tuple[str, str | None, str]  # page number, place of the event, place in it
    group: str                          # store name of the group snapshots
    take_global: Callable
    take_group: Callable
    take_markets: Callable
    reads: Callable                     # the columns of the state that snapshots and alerts read


TICK_JOB = VenueJob(TICK, ("page_no", None, "pos"), "series", sn.global_by_run_tick, sn.series_by_run_tick, sn.picks_by_run_tick,
                    lambda: [*map(F.col, ("market_ticker", "title", "status", "expiration_time", "yes_bid", "yes_ask", "volume",
                                          "open_interest")), event_from_raw("raw").alias("raw_event")])
PROB_JOB = VenueJob(PROB, ("page_no", "ev_pos", "pos"), "event_snaps", sn.global_by_run_prob, sn.events_by_run_prob,
                    sn.picks_by_run_prob,
                    lambda: [*map(F.col, ("condition_id", "question", "active", "event_id", "end_date", "liquidity", "volume",
                                          "volume_24hr", "outcome_yes_price", "outcome_no_price"))])


def versions_of(rows: DataFrame, fields: T.StructType, order: tuple, first: bool = False) -> DataFrame:
    """Normalised feed rows as versions for a ``KeyHistory`` of ``fields``, whose first field is the key: one a key
    and run, the last in page order (``first``: the first one), with ``updated_at`` the run's time."""
    sign = -1 if first else 1
    at = [(F.lit(0) if c is None else F.coalesce(F.col(c), F.lit(0)) * sign).cast("long").alias(n)
          for c, n in zip(order, ("_p", "_e", "_i"), strict=True)]
    time = ig.parse_ts(F.col("page_ts"))
    key, *rest = fields.names
    body = [time.alias(c) if c == "updated_at" else F.col(c) for c in rest]
    rows = rows.select(F.col(key), time.alias("_from"), F.struct(*body).alias("r"), F.struct(*at).alias("at")).where("_from is not null")
    got = rows.groupBy(key, "_from").agg(F.max_by("r", "at").alias("r"), F.max("at").alias("at"))
    return got.select(key, "r.*", "_from", "at.*")


def _once(store, label: str, name: str, rows: DataFrame) -> DataFrame:
    """What a batch reads several times, worked out once: written beside the tables and read back, by each use in the
    columns it needs.  ``_batch`` deletes it."""
    path = f"{store.root}/work/{label}/{name}"
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _log_runs(spark: SparkSession, store, label: str, runs: list[tuple], closed: bool) -> None:
    """K4: the batch's runs, open before the upsert and closed after it, one file each for all of them.  A batch
    that dies in between leaves its runs open -- the failed-runs query (C8) finds them -- until its replay closes
    them.  Times come from the pages, so a replay writes the same rows."""
    rows = local_rows(spark, [(i, t, t if closed else None, "stream", "spark", n, None, int(closed), done, seq)
                              for i, t, n, done, seq in runs], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in _LOGGED))
    _replace(rows.coalesce(1).withColumn("batch", F.lit(f"{label}-{'closed' if closed else 'open'}")), store.runs, "batch")


def tolerated(step: str, fn, *args) -> str | None:
    """Run a step whose failure must not fail the run (statistics and
    alerts in the reference).  The failure is logged and returned, for the
    caller to write down, and the batch goes on."""
    try:
        fn(*args)
    except Exception as e:  # noqa: BLE001
        log.error("%s failed (non-fatal)", step, exc_info=e)
        return f"{type(e).__name__}: {e}".splitlines()[0][:500]
    return None


def _batch(job: VenueJob, store, batch_id: int, rows: DataFrame, runs: dict[dt.datetime, bool], others: Callable,
           run_base: int, market_snapshot: bool, alerts: bool, pick_cap: int | None) -> None:
    """R1-R3 over the normalised rows of one micro-batch."""
    spark = rows.sparkSession
    for name in store.KEYED:
        getattr(store, name).refresh(spark)
    try:
        _runs(job, store, batch_id, rows, runs, others, run_base, market_snapshot, alerts, pick_cap)
    finally:
        for name in store.KEYED:
            getattr(store, name).done()
        delete_path(spark, f"{store.root}/work/{batch_label(spark, batch_id)}")


def _runs(job: VenueJob, store, batch_id: int, rows: DataFrame, runs: dict[dt.datetime, bool], others: Callable,
          run_base: int, market_snapshot: bool, alerts: bool, pick_cap: int | None) -> None:
    spark = rows.sparkSession
    lost = [t for t in runs if not store.state.holds(spark, t)]
    runs = {t: done for t, done in runs.items() if t not in lost}
    if lost:  # the state of their time is gone (``maintain``): they cannot be placed any more
        log.error("%d runs before the oldest state kept are left out, the newest %s", len(lost), max(lost))
        _note_failed(spark, store, batch_label(spark, batch_id), LATE, lost, "left out")
    if not runs:
        return
    label, first = batch_label(spark, batch_id), min(runs)
    # Runs whose statistics and alerts failed before are done again, like those after a late run.
    failed = read_failed(spark, store).where(F.col("step") == STATS).collect() if alerts else []
    since = min([first, *[r.run for r in failed if store.state.holds(spark, r.run)]])
    # The run log has one row a run of its retention.
    logged = read_runs(spark, store, full=True).collect()
    known = {r.started_at: r for r in logged if r.started_at >= since}
    top = [max((r[c] for r in logged), default=0) for c in ("run_id", "seq")]
    seq, number = top[1] + 1, max(run_base, top[0])
    ids = {t: r.run_id for t, r in known.items()}
    ids |= {t: number + i for i, t in enumerate((t for t in runs if t not in known), 1)}
    complete = {t: bool(r.complete) for t, r in known.items()}
    complete |= {t: done or complete.get(t, False) for t, done in runs.items()}

    _log_runs(spark, store, label, [(ids[t], t, 0, complete[t], seq) for t in runs], closed=False)
    mine = rows.where(ig.parse_ts(F.col("page_ts")) >= ts_lit(first)) if lost else rows
    store.state.append(_once(store, label, "versions", versions_of(mine, store.state.columns, job.order)), label, list(runs))
    others(label, list(runs), first if lost else None)

    changed = sorted(ids)                 # the batch's runs (or the first one to be done again) and all later ones
    error = None
    for at in range(0, len(changed), RUNS_AT_ONCE):
        some = changed[at:at + RUNS_AT_ONCE]
        held = _once(store, label, f"held-{at}", store.state.at_runs(spark, {t: ids[t] for t in some}, job.reads()))
        counts = {r.snap_ts: r.n for r in held.where(F.col("_from") == F.col("snap_ts")).groupBy("snap_ts")
                  .agg(F.count("*").alias("n")).collect()}
        _snapshots(spark, job, store, held.drop("_from"), {t: ids[t] for t in some}, [t for t in some if t in known],
                   market_snapshot, pick_cap)
        _log_runs(spark, store, f"{label}-{at}", [(ids[t], t, counts.get(t, 0), complete[t], seq)
                                                  for t in some if t in runs or t in known and known[t].phase], closed=True)
        if alerts:
            error = tolerated(STATS, _alerts, spark, job, store, held, some, [t for t in some if complete[t]], label, seq, bool(known))
            if error:  # later runs build on these: the next batch does them all
                _note_failed(spark, store, label, STATS, changed[at:], error)
                alerts = False
    if alerts and failed:
        if left := sorted({r.run for r in failed} - set(changed)):  # no state of their time, or no run log row, any more
            _note_failed(spark, store, label, STATS, left, "not done again: the run is no longer kept")
        for batch in {r.batch for r in failed} - ({f"{label}-stats"} if left else set()):
            delete_path(spark, f"{store.failed}/batch={batch}")


def _snapshots(spark: SparkSession, job: VenueJob, store, held: DataFrame, ids: dict[dt.datetime, int], known: list,
               market_snapshot: bool, pick_cap: int | None) -> None:
    """R2: the snapshots of runs ``ids`` (time -> number) from the state as of each of them."""
    runs = local_rows(spark, sorted(ids.items()), "snap_ts timestamp_ntz, run_id long")
    parts = [(store.global_snap, job.take_global(held, runs)), (getattr(store, job.group), job.take_group(held))]
    if market_snapshot:
        parts.append((store.snapshots, job.take_markets(held, cap=pick_cap)))

    def write(part):
        drop_runs(spark, part[0], known)  # a run may have no rows any more
        write_run(part[1], part[0])

    with ThreadPoolExecutor(len(parts)) as pool:  # three small jobs side by side
        list(pool.map(inheritable_thread_target(spark)(write), parts))
    if market_snapshot:
        taken = _snapshot_rows(spark, store, min(ids), max(ids)).where(F.col("snap_ts").isin(list(ids)))
        drop_runs(spark, store.times, known)
        write_run(sn.snapshot_times_of(taken), store.times)


def _snapshot_rows(spark: SparkSession, store, since: dt.datetime, until: dt.datetime) -> DataFrame:
    """Market snapshot rows from ``since`` to ``until``, of those dates' partitions only."""
    rows = read_partitioned(spark, store.snapshots, store.SNAPSHOTS["snapshots"])
    return rows.where(F.col("snap_date").between(F.to_date(ts_lit(since)), F.to_date(ts_lit(until)))
                      & F.col("snap_ts").between(ts_lit(since), ts_lit(until)))


def _alerts(spark: SparkSession, job: VenueJob, store, held: DataFrame, runs: list, complete: list, label: str,
            seq: int, rebuilt: bool) -> None:
    """M1/M2 and K6 for ``runs``, then R3 for those that are ``complete``: both of all these runs in one plan."""
    venue, first, last = job.venue, runs[0], runs[-1]
    # The times table has one row a run; what each run looks back to is found here.
    times = sorted(r.snap_ts for r in read_times(spark, store).where(F.col("snap_ts") <= ts_lit(last)).select("snap_ts").collect())
    pairs = {t: got for t in complete if (got := _pair(times, t))}
    since = min([first - dt.timedelta(days=MOVE_LOOKBACK_DAYS), *[b for _, b in pairs.values()]])
    snaps = _snapshot_rows(spark, store, since, last)
    fresh = _once(store, label, f"stats-{first:%Y%m%dT%H%M%S}", st.stats_by_run(snaps, venue, runs, times))
    before = store.move_stats.before(spark, first)
    names = store.move_stats.columns.names
    newest = fresh.groupBy(venue.key).agg(F.max_by(F.struct(*[c for c in fresh.columns if c != venue.key]), "snap_ts").alias("r"))
    rows = newest.select(venue.key, "r.*").select(*names, F.col("snap_ts").alias("_from"))
    if rebuilt:
        # Statistics written for these runs that no move supports any more give way to what held before.
        old = store.move_stats.current(spark).where(F.col("updated_at") >= ts_lit(first)).select(venue.key)
        gone = old.join(rows.select(venue.key), venue.key, "left_anti").join(before, venue.key, "left")
        rows = rows.unionByName(gone.select(*names, ts_lit(last).alias("_from")))
    rows = rows.withColumn("_p", F.lit(seq).cast("long")).withColumns({c: F.lit(0).cast("long") for c in ("_e", "_i")})
    store.move_stats.append(rows, f"{label}-{first:%Y%m%dT%H%M%S}", runs)
    if not complete:
        return
    movers = al.movers_by_run(snaps, held, fresh, before, venue, pairs)
    history = read_partitioned(spark, store.history, ALERT_HISTORY)
    since = F.col("snap_date") >= F.to_date(ts_lit(first - dt.timedelta(hours=COOLDOWN_HOURS)))
    fired = al.evaluate_runs(spark.read.schema(ALERTS).parquet(store.alerts), al.all_movers({venue.name: movers}),
                             history.where(since & (F.col("triggered_at") < ts_lit(first))))
    new = al.append_history(spark.createDataFrame([], ALERT_HISTORY), fired)
    if not rebuilt:
        write_run(new, store.history, "triggered_at")
        return
    # What was delivered stays as it is, whatever the runs say now.
    told = history.where(since & F.col("triggered_at").isin(complete) & (F.col("sent") | F.col("error_message").isNotNull()))
    told = told.select(*ALERT_HISTORY.names)
    both = new.join(told.select("history_id"), "history_id", "left_anti").select(*ALERT_HISTORY.names).unionByName(told)
    # Asked before the write, which leaves the partitions of runs that have no row any more.
    left = {r.triggered_at for r in both.select("triggered_at").distinct().collect()}
    write_run(both, store.history, "triggered_at")
    drop_runs(spark, store.history, [t for t in complete if t not in left])


def _pair(times: list[dt.datetime], run: dt.datetime) -> tuple[dt.datetime, dt.datetime] | None:
    """The latest snapshot time at ``run`` and its base (B): the newest an hour before it, else the one before it."""
    i = bisect_right(times, run) - 1
    if i < 1:
        return None
    j = bisect_right(times, times[i] - dt.timedelta(hours=MOVER_LOOKBACK_HOURS)) - 1
    return times[i], times[j if j >= 0 else i - 1]


def tick_batch(pages: DataFrame, batch_id: int, store: TickStore, run_base: int = 0,
               market_snapshot: bool = True, alerts: bool = True, pick_cap: int | None = PICK_CAP) -> None:
    """R1 + R2 + R3 for one micro-batch of landed tick pages.  ``pick_cap``
    bounds each list of the market snapshot; None takes every market."""
    _batch(TICK_JOB, store, batch_id, ig.normalize_tick(feeds.tick_markets(pages)), runs_in(pages), lambda *a: None,
           run_base, market_snapshot, alerts, pick_cap)


def prob_batch(pages: DataFrame, batch_id: int, store: ProbStore, run_base: int = 0,
               market_snapshot: bool = True, alerts: bool = True, pick_cap: int | None = PICK_CAP) -> None:
    """R1 + R2 + R3 for one micro-batch of landed probability pages:
    flatten (I4/I7) and normalise (I2/I9), upsert markets (K2) and events
    with first-wins inside the run (K3), then N2/N4/N6 snapshots, M2
    statistics and alerts."""
    flat = ig.flatten_prob(feeds.prob_market_elements(feeds.prob_events(pages)))

    def events(label: str, runs: list, since: dt.datetime | None) -> None:
        rows = _once(store, label, "events", versions_of(ig.event_rows(flat), store.events.columns, PROB_JOB.order, first=True))
        store.events.append(rows if since is None else rows.where(F.col("_from") >= ts_lit(since)), label, runs)

    _batch(PROB_JOB, store, batch_id, ig.normalize_prob(flat), runs_in(pages), events, run_base, market_snapshot, alerts, pick_cap)


# ---------------------------------------------------------------- the stream
def _start(spark: SparkSession, batch: Callable, landing: str, store, checkpoint: str, files_per_batch: int | None,
           available_now: bool, kw: dict):
    pages = feeds.stream_pages(spark, landing, files_per_batch)
    w = (pages.writeStream.foreachBatch(lambda df, bid: batch(df, bid, store, **kw))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_tick_stream(spark: SparkSession, landing: str, store: TickStore, checkpoint: str,
                      files_per_batch: int | None = None, available_now: bool = True, **kw):
    """Start the R1-R3 stream over ``landing``; ``availableNow`` processes
    everything landed so far (in micro-batches of ``files_per_batch``
    files, or all at once) and stops."""
    return _start(spark, tick_batch, landing, store, checkpoint, files_per_batch, available_now, kw)


def start_prob_stream(spark: SparkSession, landing: str, store: ProbStore, checkpoint: str,
                      files_per_batch: int | None = None, available_now: bool = True, **kw):
    """Start the probability-venue R1-R3 stream over ``landing``."""
    return _start(spark, prob_batch, landing, store, checkpoint, files_per_batch, available_now, kw)


def land_pages(pages: DataFrame, landing: str, files: int | None = None) -> None:
    """Land page lines as text files in run and page order, as feed fetchers would, by one write; ``files``
    is their number (default: as many as the shuffle has partitions).  ``page_ts`` and ``page_no`` may stand
    beside ``value``."""
    if "page_ts" not in pages.columns:
        pages = pages.select("value", F.get_json_object("value", "$.page_ts").alias("page_ts"),
                             F.get_json_object("value", "$.page_no").cast("long").alias("page_no"))
    order = ["page_ts", "page_no"]
    out = pages.repartitionByRange(files, *order) if files else pages.repartitionByRange(*order)
    out.sortWithinPartitions(*order).select("value").write.mode("append").text(landing)
