"""Snapshot builders N1-N7 and append-if-absent K5.

Each builder is a set of aggregate expressions applied either to the
current state at one run time (``snapshot_*``), or, for history
reconstruction, to per-market snapshot rows grouped by ``snap_ts``
(``*_by_time``).  Aggregations are declarative, so Spark plans a partial
hash aggregate before the shuffle: a hot event key is pre-combined map-side
and never gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricescope.functions.exprs import event_from_raw, ts_lit

from pricescope.constants import EXPIRY_HORIZON_H, PICK_CAP, WIDE_SPREAD  # noqa: E402


def _priced(bid="yes_bid", ask="yes_ask") -> Column:
    return F.col(bid).isNotNull() & F.col(ask).isNotNull()


# ---------------------------------------------------------------- tick, N1/N3
def tick_global_aggs() -> list[Column]:
    priced = _priced()
    spread = F.col("yes_ask") - F.col("yes_bid")
    return [
        F.count(F.lit(1)).alias("n_active"),
        F.count_if(priced).alias("n_priced"),
        F.coalesce(F.sum("volume"), F.lit(0)).cast("long").alias("total_volume"),
        F.coalesce(F.sum("open_interest"), F.lit(0)).cast("long").alias("total_open_interest"),
        F.avg(F.when(priced, spread)).cast("double").alias("avg_spread_ticks"),
        F.count_if(priced & (spread >= WIDE_SPREAD)).alias("n_wide_spread"),
    ]


def tick_series_aggs() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_markets"),
        F.coalesce(F.sum("volume"), F.lit(0)).cast("long").alias("total_volume"),
        F.coalesce(F.sum("open_interest"), F.lit(0)).cast("long").alias("total_open_interest"),
        F.avg(F.col("yes_ask") - F.col("yes_bid")).cast("double").alias("avg_spread_ticks"),
    ]


def _series_having(df: DataFrame) -> DataFrame:
    return df.where((F.col("total_volume") > 0) | (F.col("total_open_interest") > 0))


def snapshot_global_tick(state: DataFrame, snap_ts, run_id: int) -> DataFrame:
    """One row for the run over active current-state rows."""
    g = state.where(F.col("status") == "active").agg(*tick_global_aggs())
    return g.select(F.lit(run_id).cast("long").alias("run_id"), ts_lit(snap_ts).alias("snap_ts"), "*")


def snapshot_series_tick(state: DataFrame, snap_ts, run_id: int) -> DataFrame:
    """Per event (event_ticker read out of ``raw``), priced active rows,
    kept when the event has any volume or open interest."""
    ev = event_from_raw("raw")
    g = (state.where((F.col("status") == "active") & ev.isNotNull() & _priced())
         .groupBy(ev.alias("series_ticker")).agg(*tick_series_aggs()))
    return _series_having(g).select(ts_lit(snap_ts).alias("snap_ts"),
                                    F.lit(run_id).cast("long").alias("run_id"), "*")


def tick_global_by_time(snaps: DataFrame) -> DataFrame:
    """N1 applied to every snapshot time of a per-market snapshot table."""
    return snaps.groupBy("run_id", "snap_ts").agg(*tick_global_aggs())


def tick_series_by_time(snaps: DataFrame) -> DataFrame:
    """N3 applied to every snapshot time of a per-market snapshot table."""
    g = (snaps.where(F.col("series_ticker").isNotNull() & _priced())
         .groupBy("snap_ts", "run_id", "series_ticker").agg(*tick_series_aggs()))
    return _series_having(g)


# ---------------------------------------------------------------- prob, N2/N4
# Amounts and prices are stored as numeric(18,4) / numeric(8,6) by the
# reference, so sums and averages are exact decimal arithmetic rounded
# half-up to the column's scale; summing doubles instead would let the
# summation order decide ties.
def _dec_sum(c: str) -> Column:
    return F.coalesce(F.sum(F.col(c).cast("decimal(18,4)")), F.lit(0)).cast("decimal(24,4)").cast("double")


def _dec_avg_price(c: str) -> Column:
    return F.round(F.avg(F.col(c).cast("decimal(18,6)")), 6).cast("double")


def prob_global_aggs() -> list[Column]:
    yes = F.col("outcome_yes_price")
    return [
        F.count_if(F.col("active")).alias("n_active"),
        F.count_if(yes.isNotNull()).alias("n_priced"),
        _dec_sum("volume").alias("total_volume"),
        _dec_sum("volume_24hr").alias("total_volume_24hr"),
        _dec_sum("liquidity").alias("total_liquidity"),
        _dec_avg_price("outcome_yes_price").alias("avg_yes_price"),
    ]


def prob_event_aggs() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_markets"),
        _dec_sum("volume").alias("total_volume"),
        _dec_sum("liquidity").alias("total_liquidity"),
        _dec_avg_price("outcome_yes_price").alias("avg_yes_price"),
    ]


def snapshot_global_prob(state: DataFrame, snap_ts, run_id: int) -> DataFrame:
    """One row for the run over active markets."""
    g = state.where(F.col("active")).agg(*prob_global_aggs())
    return g.select(F.lit(run_id).cast("long").alias("run_id"), ts_lit(snap_ts).alias("snap_ts"), "*")


def snapshot_events_prob(state: DataFrame, snap_ts, run_id: int) -> DataFrame:
    """Per event over active markets with an event id."""
    g = (state.where(F.col("active") & F.col("event_id").isNotNull())
         .groupBy("event_id").agg(*prob_event_aggs()))
    return g.select(ts_lit(snap_ts).alias("snap_ts"), F.lit(run_id).cast("long").alias("run_id"), "*")


def prob_global_by_time(snaps: DataFrame) -> DataFrame:
    return snaps.withColumn("active", F.lit(True)).groupBy("run_id", "snap_ts").agg(*prob_global_aggs())


def prob_events_by_time(snaps: DataFrame) -> DataFrame:
    return (snaps.where(F.col("event_id").isNotNull())
            .groupBy("snap_ts", "run_id", "event_id").agg(*prob_event_aggs()))


# --------------------------------------------- several runs at once, N1-N4
def _global_by_run(state: DataFrame, runs: DataFrame, aggs: list[Column], mean: str) -> DataFrame:
    g = state.groupBy("snap_ts").agg(*aggs)
    rest = [c for c in g.columns if c != "snap_ts"]
    # ``runs(snap_ts, run_id)`` has one row a run.  As without grouping, a run without active rows has a row of zeros.
    return runs.join(g, "snap_ts", "left").select(
        "run_id", "snap_ts", *[F.col(c) if c == mean else F.coalesce(c, F.lit(0)).cast(g.schema[c].dataType).alias(c) for c in rest])


def global_by_run_tick(state: DataFrame, runs: DataFrame) -> DataFrame:
    """N1 over the state as of several runs (``snap_ts``)."""
    return _global_by_run(state.where(F.col("status") == "active"), runs, tick_global_aggs(), "avg_spread_ticks")


def global_by_run_prob(state: DataFrame, runs: DataFrame) -> DataFrame:
    """N2 over the state as of several runs."""
    return _global_by_run(state.where(F.col("active")), runs, prob_global_aggs(), "avg_yes_price")


def _event(state: DataFrame) -> Column:
    """The event of a tick market: read from its document, unless that was done before (``raw_event``)."""
    return F.col("raw_event") if "raw_event" in state.columns else event_from_raw("raw")


def series_by_run_tick(state: DataFrame) -> DataFrame:
    """N3 over the state as of several runs."""
    ev = _event(state)
    g = (state.where((F.col("status") == "active") & ev.isNotNull() & _priced())
         .groupBy("snap_ts", "run_id", ev.alias("series_ticker")).agg(*tick_series_aggs()))
    return _series_having(g)


def events_by_run_prob(state: DataFrame) -> DataFrame:
    """N4 over the state as of several runs."""
    g = state.where(F.col("active") & F.col("event_id").isNotNull()).groupBy("snap_ts", "run_id", "event_id").agg(*prob_event_aggs())
    return g


# ------------------------------------------------------- market picks, N5-N7
#: Quantiles a list is cut by before its rows are ranked, and the sketch's accuracy (rank error 1 / accuracy).
_STEPS, _ACCURACY = 256, 10_000


def _lists(c: DataFrame, cap: int, key: str, orders: dict[str, tuple], one_run: bool = False) -> DataFrame:
    """The rows of ``c`` that are among the first ``cap`` of their run (``snap_ts``) in any of the lists
    ``orders``: name -> (column, descending, condition).  Nulls rank last, ties by ``key``.

    One pass takes a mergeable quantile sketch of every list per run.  The
    quantile that is sure to leave ``cap`` rows cuts the list, so what one
    task ranks exactly is the cap and one part in ``_STEPS`` of the run (and
    rows that tie with the quantile), not ``cap`` rows of every partition.
    """
    steps = F.expr(f"array({', '.join(f'{i / _STEPS}D' for i in range(1, _STEPS))})")
    aggs = []
    for name, (col, _, ok) in orders.items():
        v = F.when(ok, F.col(col)) if ok is not None else F.col(col)
        aggs += [F.count(v).alias(f"n_{name}"), F.call_function("percentile_approx", v, steps, F.lit(_ACCURACY)).alias(f"q_{name}")]
    sketch = c.groupBy("snap_ts").agg(*aggs)
    cuts = []
    for name, (_, desc, _) in orders.items():
        # One step more than the cap's share covers the sketch's error.
        share = F.ceil(F.lit(_STEPS) * cap / F.when(F.col(f"n_{name}") > 0, F.col(f"n_{name}"))).cast("int") + 1
        at = (F.lit(_STEPS) - share) if desc else share
        cuts.append(F.when((at >= 1) & (at < _STEPS), F.get(f"q_{name}", at - 1)).alias(f"cut_{name}"))
    if one_run:  # the run is a constant: its cuts are one scalar subquery
        found = sketch.select(F.struct(*cuts)).scalar()
        c_cut = c.select("*", *[found[f"cut_{name}"].alias(f"cut_{name}") for name in orders])
    else:        # one row a run on the broadcast side
        c_cut = c.join(F.broadcast(sketch.select("snap_ts", *cuts)), "snap_ts")
    parts = []
    for name, (col, desc, ok) in orders.items():
        v, cut = F.col(col), F.col(f"cut_{name}")
        some = c_cut.where(cut.isNull() | (v >= cut if desc else v <= cut))
        some = (some.where(ok) if ok is not None else some).select(*c.columns)
        at = F.row_number().over(Window.partitionBy("snap_ts").orderBy(v.desc_nulls_last() if desc else v.asc(), F.col(key)))
        parts.append(some.withColumn("_at", at).where(F.col("_at") <= int(cap)).drop("_at"))
    pick = parts[0]
    for other in parts[1:]:
        pick = pick.unionByName(other)
    # SQL UNION removes duplicate rows; the key is unique in a run, so
    # de-duplicating by key is the same and also works with map columns.
    return pick.dropDuplicates(["snap_ts", key])


def _tick_candidates(state: DataFrame) -> DataFrame:
    return (state.where((F.col("status") == "active") & _priced())
            .select("snap_ts", "run_id", "market_ticker", _event(state).alias("series_ticker"),
                    "expiration_time", "yes_bid", "yes_ask", "volume", "open_interest",
                    (F.col("yes_ask") - F.col("yes_bid")).alias("spread_ticks"),
                    ((F.col("yes_bid") + F.col("yes_ask")) / 2.0).alias("mid")))


def picks_by_run_tick(state: DataFrame, cap: int | None = PICK_CAP, wide: int = WIDE_SPREAD,
                      horizon_hours: int = EXPIRY_HORIZON_H, one_run: bool = False) -> DataFrame:
    """N5 over the state as of several runs: ``state`` has a row per run (``snap_ts``, ``run_id``) and market."""
    c = _tick_candidates(state)
    horizon = F.col("snap_ts") + F.make_dt_interval(hours=F.lit(horizon_hours))
    return c if cap is None else _lists(c, cap, "market_ticker", {
        "volume": ("volume", True, None), "interest": ("open_interest", True, None),
        "spread": ("spread_ticks", True, F.col("spread_ticks") >= wide),
        "expiry": ("expiration_time", False, F.col("expiration_time") <= horizon)}, one_run)


def picks_by_run_prob(state: DataFrame, cap: int | None = PICK_CAP, one_run: bool = False) -> DataFrame:
    """N6 over the state as of several runs."""
    c = state.where(F.col("active")).select("snap_ts", "run_id", "condition_id", "event_id", "end_date", "volume", "volume_24hr",
                                            "liquidity", "outcome_yes_price", "outcome_no_price")
    return c if cap is None else _lists(c, cap, "condition_id", {m: (m, True, None) for m in ("volume", "liquidity", "volume_24hr")}, one_run)


def _one_run(state: DataFrame, snap_ts, run_id: int) -> DataFrame:
    """The state in the form of the functions for several runs."""
    return state.select("*", ts_lit(snap_ts).alias("snap_ts"), F.lit(run_id).cast("long").alias("run_id"))


def pick_markets_tick(state: DataFrame, snap_ts, run_id: int, cap: int | None = PICK_CAP,
                      wide: int = WIDE_SPREAD, horizon_hours: int = EXPIRY_HORIZON_H) -> DataFrame:
    """The union of four bounded lists of "interesting" priced active
    markets -- top volume, top open interest, widest spreads (>= ``wide``),
    soonest expiry within ``horizon_hours`` of the run (no lower bound, so
    already-expired markets qualify) -- written as snapshot rows.  With
    ``cap=None`` every such market."""
    return picks_by_run_tick(_one_run(state, snap_ts, run_id), cap, wide, horizon_hours, one_run=True)


def pick_markets_prob(state: DataFrame, snap_ts, run_id: int, cap: int | None = PICK_CAP) -> DataFrame:
    """Union of the top-``cap`` active markets by volume, liquidity and
    24h volume (nulls last), as snapshot rows; all of them with ``cap=None``."""
    return picks_by_run_prob(_one_run(state, snap_ts, run_id), cap, one_run=True)


def snapshot_full_tick(state: DataFrame, snap_ts, run_id: int) -> DataFrame:
    """Every current market copied into the history table for the run."""
    return state.select(ts_lit(snap_ts).alias("snap_ts"), F.lit(run_id).cast("long").alias("run_id"),
                        "market_ticker", "series_ticker", "expiration_time", "yes_bid", "yes_ask",
                        "volume", "open_interest", "updated_at")


def append_if_absent(existing: DataFrame, new: DataFrame, keys: list[str], snap_ts=None) -> DataFrame:
    """K5 (``on conflict do nothing``): the table after appending the rows of
    ``new`` whose key is not yet present.  A left-anti join on the key
    columns; returns the complete table (old rows + admitted new rows)."""
    admitted = admitted_rows(existing, new, keys, snap_ts)
    cols = [c for c in existing.columns if c != "snap_date"]
    return existing.select(*cols).unionByName(admitted.select(*cols))


def admitted_rows(existing: DataFrame, new: DataFrame, keys: list[str], snap_ts=None) -> DataFrame:
    """K5, the rows an append would add (what ``rowcount`` reports).

    When the key includes ``snap_ts`` and the stored table is partitioned
    by ``snap_date``, the stored side is bounded to the new rows' time range,
    so a run's dedupe reads that run's date partition, not the whole
    history.  Pass ``snap_ts`` when all new rows have that time; else two
    scalar subqueries find the range."""
    old = existing
    if "snap_ts" in keys and "snap_date" in existing.columns:
        lo, hi = ((ts_lit(snap_ts),) * 2 if snap_ts is not None
                  else (new.agg(F.min("snap_ts")).scalar(), new.agg(F.max("snap_ts")).scalar()))
        old = old.where((F.col("snap_date") >= F.to_date(lo)) & (F.col("snap_date") <= F.to_date(hi))
                        & (F.col("snap_ts") >= lo) & (F.col("snap_ts") <= hi))
    return new.join(old.select(*keys), on=keys, how="left_anti")


def snapshot_times_of(market_rows: DataFrame) -> DataFrame:
    """The per-run times table: one row per snapshot time of the market
    snapshot rows (snap_ts, run_id, n_markets).  Written next to the market
    snapshots so time lookups read one row per run."""
    return market_rows.groupBy("snap_ts").agg(F.max("run_id").alias("run_id"),
                                              F.count(F.lit(1)).alias("n_markets"))
