"""Stand-in inputs derived from the driver's test tables (FIXTURES.md, part B).

These functions only shape rows of the driver's ``events``, ``customer`` and
``nation`` tables into the schemas the operators expect (snapshot tables,
current state, dimensions, alerts, logs).  They do none of the operators'
work: every registered query runs the library's own operator on them.

Scale notes: the one global window (``dense_rank`` for ``run_id``) runs on
the distinct snapshot times only -- one row per 6-hour bucket -- and is
joined back; per-user windows cover at most one row per bucket per user, so
their size is bounded by the time span, not by the event volume.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricescope.constants import ALERT_TYPES

# Fixed values of the fixture specification.
BUCKET = "6 hours"
EXPIRY_BASE = "2024-01-30 00:00:00"
OPEN_TIME = "2024-01-01 00:00:00"
AS_OF = dt.datetime(2024, 1, 30, 18, 0, 0)        # latest snapshot, every sf
AS_OF_WALL = dt.datetime(2024, 1, 31, 0, 0, 0)    # staleness and alert clock
# (low, high) thresholds per alert type and venue
ALERT_THRESHOLDS = {
    ("tick", "PRICE_MOVE"): (1.0, 40.0),
    ("tick", "VOLATILITY_SPIKE"): (0.5, 5.0),
    ("tick", "VOLUME_SURGE"): (100.0, 1.0e9),
    ("prob", "PRICE_MOVE"): (0.01, 0.4),
    ("prob", "VOLATILITY_SPIKE"): (0.5, 5.0),
    ("prob", "VOLUME_SURGE"): (1.0, 1.0e9),
}


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


def _str(c):
    return c.cast("string")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def observations(events: DataFrame) -> DataFrame:
    """B1: one row per (6-hour bucket, user).  ``k`` is the bucket number
    since the epoch (a long), used for range frames."""
    b = events.select(F.window("ts", BUCKET).start.alias("snap_ts"), "user_id", "value", "event_id")
    obs = b.groupBy("snap_ts", "user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.round(F.col("value") * 100).cast("long")).alias("c"),
        F.max("event_id").alias("e"))
    k = (F.unix_date(F.to_date("snap_ts")).cast("long") * 4 + (F.hour("snap_ts") / 6).cast("long"))
    times = obs.select("snap_ts").distinct()
    # Global dense rank over the distinct times only (tiny, bounded by the
    # number of buckets); joined back on snap_ts.
    times = times.withColumn("run_id", F.dense_rank().over(Window.orderBy("snap_ts")).cast("long"))
    return obs.join(times, "snap_ts").withColumn("k", k)


def _expiry():
    return _ts(EXPIRY_BASE) + F.make_dt_interval(hours=((F.col("user_id") % 30) * 4).cast("int"))


def tick_snapshots_with_user(obs: DataFrame) -> DataFrame:
    """B2 plus the ``user_id`` the current state is keyed back to."""
    w = Window.partitionBy("user_id").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    bid = (1 + F.col("c") % 85).cast("int")
    spread = (1 + F.col("e") % 14).cast("int")
    oi_step = F.when(F.col("e") % 3 == 0, -F.col("n")).otherwise(60 * F.col("n"))
    return obs.select(
        "snap_ts", "run_id", "user_id",
        F.concat(F.lit("M"), _str(F.col("user_id"))).alias("market_ticker"),
        F.concat(F.lit("E"), _str(F.col("user_id") % 12)).alias("series_ticker"),
        _expiry().alias("expiration_time"),
        bid.alias("yes_bid"),
        (bid + spread).alias("yes_ask"),
        F.when(F.col("e") % 41 != 0, F.sum("c").over(w)).cast("long").alias("volume"),
        F.greatest(F.lit(0), F.sum(oi_step).over(w)).cast("long").alias("open_interest"),
        spread.alias("spread_ticks"),
        ((2 * bid + spread) / 2.0).alias("mid"))


def prob_snapshots_with_user(obs: DataFrame, customer: DataFrame) -> DataFrame:
    """B3 plus ``user_id``."""
    cum = Window.partitionBy("user_id").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    last_18h = Window.partitionBy("user_id").orderBy("k").rangeBetween(-3, 0)
    j = obs.join(customer.select(F.col("c_custkey").alias("user_id"), "c_nationkey",
                                 "c_mktsegment", "c_acctbal"), "user_id")
    yes = F.when(F.col("e") % 43 != 0, (1 + F.col("c") % 999) / 1000.0)
    return j.select(
        "snap_ts", "run_id", "user_id",
        F.concat(F.lit("C"), _str(F.col("user_id"))).alias("condition_id"),
        F.concat(F.lit("V"), _str(F.col("c_nationkey"))).alias("event_id"),
        F.col("c_mktsegment").alias("category"),
        _expiry().alias("end_date"),
        (F.sum("c").over(cum) / 100.0).alias("volume"),
        (F.sum("c").over(last_18h) / 100.0).alias("volume_24hr"),
        (F.greatest(F.lit(0.0), F.col("c_acctbal")) + 10 * F.col("n")).alias("liquidity"),
        yes.alias("outcome_yes_price"),
        (1 - yes).alias("outcome_no_price"))


def stored_with_user(snaps: DataFrame) -> DataFrame:
    """Stored market snapshots of either venue with the ``user_id`` their key is made of."""
    key = "market_ticker" if "market_ticker" in snaps.columns else "condition_id"
    return snaps.drop("snap_date").withColumn("user_id", F.substring(key, 2, 20).cast("long"))


def _newest_per_user(df: DataFrame, cols: list[str]) -> DataFrame:
    """Latest snapshot row per user: max_by over snap_ts (a partial
    aggregate, so a user with many rows is combined map-side)."""
    return (df.groupBy("user_id")
            .agg(F.max_by(F.struct(*cols), F.col("snap_ts")).alias("r"))
            .select("user_id", "r.*"))


def _user_activity(events: DataFrame) -> DataFrame:
    """Per user: last event time and type of the newest event."""
    return events.groupBy("user_id").agg(
        F.max("ts").alias("updated_at"),
        F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"))


def tick_state(tick_u: DataFrame, events: DataFrame) -> DataFrame:
    """B4, tick venue current state (schema ``TICK_STATE``)."""
    last = _newest_per_user(tick_u, ["market_ticker", "series_ticker", "expiration_time",
                                     "yes_bid", "yes_ask", "volume", "open_interest"])
    u = F.col("user_id")
    ev = F.when(u % 19 == 0, F.lit("")).otherwise(F.concat(F.lit("E"), _str(u % 12)))
    bid = F.when(u % 13 == 0, F.lit(None).cast("int")).when(u % 17 == 0, F.lit(0)).otherwise(F.col("yes_bid"))
    return last.join(_user_activity(events), "user_id").select(
        "market_ticker", "series_ticker",
        F.concat(F.lit("Market "), _str(u)).alias("title"),
        F.when(F.col("last_type") == "error", F.lit("closed")).otherwise(F.lit("active")).alias("status"),
        _ts(OPEN_TIME).alias("open_time"),
        F.col("expiration_time").alias("close_time"),
        "expiration_time",
        bid.cast("int").alias("yes_bid"),
        F.col("yes_ask").cast("int").alias("yes_ask"),
        (100 - F.col("yes_ask")).cast("int").alias("no_bid"),
        (100 - F.col("yes_bid")).cast("int").alias("no_ask"),
        "volume", "open_interest",
        F.concat(F.lit('{"event_ticker":"'), ev, F.lit('"}')).alias("raw"),
        "updated_at")


def prob_state(prob_u: DataFrame, events: DataFrame) -> DataFrame:
    """B4, probability venue current state (schema ``PROB_STATE``)."""
    last = _newest_per_user(prob_u, ["condition_id", "event_id", "category", "end_date", "volume",
                                     "volume_24hr", "liquidity", "outcome_yes_price",
                                     "outcome_no_price"])
    u = F.col("user_id")
    active = F.col("last_type") != "error"
    yes = F.col("outcome_yes_price")
    prices = F.when(yes.isNotNull(), F.to_json(F.create_map(
        F.lit("Yes"), yes, F.lit("No"), F.col("outcome_no_price"))))
    return last.join(_user_activity(events), "user_id").select(
        "condition_id",
        _str(u).alias("market_id"),
        F.concat(F.lit("m-"), _str(u)).alias("slug"),
        F.concat(F.lit("Market "), _str(u)).alias("question"),
        "category",
        active.alias("active"),
        (~active).alias("closed"),
        F.lit(True).alias("enable_order_book"),
        _ts(OPEN_TIME).alias("start_date"),
        "end_date", "liquidity", "volume", "volume_24hr",
        "outcome_yes_price", "outcome_no_price",
        prices.alias("outcome_prices"),
        "event_id",
        F.to_json(F.struct(F.col("condition_id").alias("conditionId"),
                           F.col("event_id").alias("eventId"))).alias("raw"),
        "updated_at")


def prob_events_dim(prob_u: DataFrame, nation: DataFrame) -> DataFrame:
    """One row per event; category of the first-seen market row
    (earliest snapshot, then lowest user id)."""
    first = (prob_u.groupBy("event_id")
             .agg(F.min_by("category", F.struct("snap_ts", "user_id")).alias("category"),
                  F.min("snap_ts").alias("start_date"), F.max("end_date").alias("end_date"),
                  F.max("snap_ts").alias("updated_at")))
    nat = nation.select(F.concat(F.lit("V"), _str(F.col("n_nationkey"))).alias("event_id"),
                        F.col("n_name").alias("event_title"))
    return first.join(nat, "event_id", "left").select(
        "event_id", F.lower(F.col("event_title")).alias("event_slug"), "event_title", "category",
        "start_date", "end_date",
        F.to_json(F.struct("event_id", "event_title", "category")).alias("raw"),
        "updated_at")


def export_runs(snaps: DataFrame) -> DataFrame:
    """One run per snapshot time; runs with run_id % 25 = 0 never
    finished (finished_at null)."""
    g = snaps.groupBy("run_id", "snap_ts").agg(F.count(F.lit(1)).alias("n_markets"))
    return g.select(
        "run_id", F.col("snap_ts").alias("started_at"),
        F.when(F.col("run_id") % 25 != 0, F.col("snap_ts") + F.make_dt_interval(mins=F.lit(5)))
        .alias("finished_at"),
        F.lit("fixture").alias("source"),
        F.concat(F.lit("h"), _str(F.col("run_id") % 3)).alias("host"),
        F.col("n_markets").cast("long").alias("n_markets"),
        F.concat(F.lit("started "), F.date_format("snap_ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("note"))


def ingest_log(events: DataFrame) -> DataFrame:
    """B8."""
    return events.select(F.col("event_id").alias("id"), F.col("ts").alias("ts_utc"),
                         F.col("event_type").alias("source"),
                         F.concat(F.lit("h"), _str(F.col("user_id") % 5)).alias("host"),
                         F.col("props").alias("note"))


def alerts(events: DataFrame, as_of=AS_OF_WALL) -> DataFrame:
    """One alert per user and type; even users watch the tick market
    ``M<u>``, odd users the probability market ``C<u>``.  Threshold
    alternates low/high by ``(u div 2) % 2``; ``last_triggered_at`` is null,
    30 or 90 minutes before ``as_of`` by ``u % 3``; every 11th user's alerts
    are inactive."""
    users = events.select("user_id").distinct()
    types = F.array(*[F.lit(t) for t in ALERT_TYPES])
    u = F.col("user_id")
    x = users.select("user_id", F.posexplode(types).alias("t", "alert_type"))
    tick = u % 2 == 0
    platform = F.when(tick, F.lit("tick")).otherwise(F.lit("prob"))
    high = (u / 2).cast("long") % 2 == 1
    thr = None
    for (venue, typ), (lo, hi) in ALERT_THRESHOLDS.items():
        cond = (platform == venue) & (F.col("alert_type") == typ)
        val = F.when(high, F.lit(hi)).otherwise(F.lit(lo))
        thr = F.when(cond, val) if thr is None else thr.when(cond, val)
    as_of_c = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    last = (F.when(u % 3 == 1, as_of_c - F.make_dt_interval(mins=F.lit(30)))
            .when(u % 3 == 2, as_of_c - F.make_dt_interval(mins=F.lit(90))))
    return x.select(
        (u * 3 + F.col("t")).cast("long").alias("alert_id"),
        F.concat(F.lit("user"), _str(u), F.lit("@example.com")).alias("user_email"),
        platform.alias("platform"),
        F.when(tick, F.concat(F.lit("M"), _str(u))).otherwise(F.concat(F.lit("C"), _str(u)))
        .alias("market_key"),
        "alert_type",
        thr.cast("double").alias("threshold"),
        (u % 11 != 0).alias("is_active"),
        _ts(OPEN_TIME).alias("created_at"),
        last.alias("last_triggered_at"))


# ------------------------------------------------------------ B10 feed pages
PAGE_SIZE = 25


def _iso(c):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _paged(rows: DataFrame) -> DataFrame:
    """Market rows with their page and the number of their run's last page (``last_no``), the rows of a page in one task."""
    rows = rows.withColumn("page_no", (F.col("user_id") / PAGE_SIZE).cast("long"))
    # One row a run on the broadcast side.
    last = rows.groupBy(F.col("snap_ts").alias("last_ts")).agg(F.max("page_no").alias("last_no"))
    rows = rows.join(F.broadcast(last), F.col("snap_ts").eqNullSafe(F.col("last_ts")), "left").drop("last_ts")
    return rows.repartition("snap_ts", "page_no")


def tick_pages(tick_u: DataFrame) -> DataFrame:
    """B10, tick venue: one JSON page per (run, user div 25) for all runs, markets ordered by ``user % 25``.  Variations by user id:
    u%7=0 empty ``ticker`` (key in ``market_ticker``), u%19=0 empty
    ``event_ticker``, u%11=0 empty ``close_time``; status closed when
    (u + run_id) % 10 = 0.  Overview fields: ``series_id`` = series ticker
    (absent for u%13=0), ``event_id`` = 'EV' || u%4 (so one event id spans
    several series; absent for u%17=0), ``event_title`` = 'Event ' || u%4
    || '/' || u%3 (titles differ inside an event), ``close_ts``."""
    u = F.col("user_id")
    r = tick_u
    elem = F.struct(
        F.when(u % 7 == 0, F.lit("")).otherwise(F.col("market_ticker")).alias("ticker"),
        F.col("market_ticker").alias("market_ticker"),
        F.col("series_ticker").alias("series_ticker"),
        F.when(u % 19 == 0, F.lit("")).otherwise(F.col("series_ticker")).alias("event_ticker"),
        F.concat(F.lit("Market "), _str(u)).alias("title"),
        F.when((u + F.col("run_id")) % 10 == 0, F.lit("closed")).otherwise(F.lit("active")).alias("status"),
        F.lit("2024-01-01T00:00:00Z").alias("open_time"),
        F.when(u % 11 == 0, F.lit("")).otherwise(_iso(F.col("expiration_time"))).alias("close_time"),
        _iso(F.col("expiration_time")).alias("expiration_time"),
        "yes_bid", "yes_ask",
        (100 - F.col("yes_ask")).cast("int").alias("no_bid"),
        (100 - F.col("yes_bid")).cast("int").alias("no_ask"),
        "volume", "open_interest",
        F.when(u % 13 != 0, F.col("series_ticker")).alias("series_id"),
        F.when(u % 17 != 0, F.concat(F.lit("EV"), _str(u % 4))).alias("event_id"),
        F.concat(F.lit("Event "), _str(u % 4), F.lit("/"), _str(u % 3)).alias("event_title"),
        _iso(F.col("expiration_time")).alias("close_ts"))
    g = (_paged(r).groupBy("snap_ts", "page_no")
         .agg(F.array_sort(F.collect_list(F.struct((u % PAGE_SIZE).alias("o"), elem.alias("m"))))
              .alias("ms"), F.max("last_no").alias("last_no")))
    page = F.struct(_iso(F.col("snap_ts")).alias("page_ts"), "page_no", (F.col("last_no") == F.col("page_no")).alias("last"),
                    F.concat(F.lit("c"), _str(F.col("page_no") + 1)).alias("cursor"),
                    F.transform("ms", lambda x: x["m"]).alias("markets"))
    return g.select(page.alias("page")).select(F.to_json("page").alias("value"))


OUTCOME_SHAPES = 8


def prob_pages(prob_u: DataFrame, nation: DataFrame) -> DataFrame:
    """B10, probability venue: one page per (run, user div 25) holding the
    events of its markets.  Variations by user id: u%23=0 empty
    ``conditionId`` (skipped), u%4=0 empty market slug, u%6=0 empty market
    category, u%8=0 empty ``endDate`` (all inherit the event's); outcome
    lists by u%8: 0 ``["YES","no"]``, 1 ``["No","Maybe"]``, 2 three
    outcomes, 3 a non-numeric price, 4 unequal lengths; 5-7 plain
    ``["Yes","No"]``.  Prices are 3-decimal text; a missing yes price gives
    no ``outcomePrices``."""
    u = F.col("user_id")
    r = prob_u.join(
        nation.select(F.concat(F.lit("V"), _str(F.col("n_nationkey"))).alias("event_id"),
                      F.col("n_name").alias("event_title")), "event_id", "left")
    yes = F.format_string("%.3f", F.col("outcome_yes_price"))
    no = F.format_string("%.3f", F.col("outcome_no_price"))
    shape = u % OUTCOME_SHAPES
    outcomes = (F.when(shape == 0, F.lit('["YES","no"]'))
                .when(shape == 1, F.lit('["No","Maybe"]'))
                .when(shape == 2, F.lit('["Yes","No","Maybe"]'))
                .otherwise(F.lit('["Yes","No"]')))
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    prices = (F.when(F.col("outcome_yes_price").isNull(), F.lit(None))
              .when(shape == 2, F.concat(F.lit("["), q(yes), F.lit(","), q(no), F.lit(',"0.000"]')))
              .when(shape == 3, F.concat(F.lit("["), q(yes), F.lit(',"n/a"]')))
              .when(shape == 4, F.concat(F.lit("["), q(yes), F.lit("]")))
              .otherwise(F.concat(F.lit("["), q(yes), F.lit(","), q(no), F.lit("]"))))
    elem = F.struct(
        _str(u).alias("id"),
        F.when(u % 23 == 0, F.lit("")).otherwise(F.col("condition_id")).alias("conditionId"),
        F.when(u % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("m-"), _str(u))).alias("slug"),
        F.concat(F.lit("Market "), _str(u)).alias("question"),
        F.when(u % 6 == 0, F.lit("")).otherwise(F.col("category")).alias("category"),
        F.lit(True).alias("active"), F.lit(False).alias("closed"), F.lit(True).alias("enableOrderBook"),
        F.lit("2024-01-01T00:00:00Z").alias("startDate"),
        F.when(u % 8 == 0, F.lit("")).otherwise(_iso(F.col("end_date"))).alias("endDate"),
        _str(F.col("liquidity")).alias("liquidity"),
        F.col("volume").alias("volume"),
        _str(F.col("volume_24hr")).alias("volume24hr"),
        outcomes.alias("outcomes"), prices.alias("outcomePrices"))
    per_event = (_paged(r).groupBy("snap_ts", "page_no", "event_id")
                 .agg(F.min("user_id").alias("first_u"),
                      F.min_by("category", "user_id").alias("ev_category"),
                      F.first("event_title").alias("event_title"),
                      F.max("end_date").alias("ev_end"),
                      F.array_sort(F.collect_list(F.struct((u % PAGE_SIZE).alias("o"), elem.alias("m"))))
                      .alias("ms"), F.max("last_no").alias("last_no")))
    ev = F.struct(
        F.col("event_id").alias("id"), F.lower(F.col("event_title")).alias("slug"),
        F.col("event_title").alias("title"), F.col("ev_category").alias("category"),
        F.lit("2024-01-01T00:00:00Z").alias("startDate"), _iso(F.col("ev_end")).alias("endDate"),
        F.lit(True).alias("active"), F.lit(False).alias("closed"),
        F.transform("ms", lambda x: x["m"]).alias("markets"))
    g = (per_event.groupBy("snap_ts", "page_no")
         .agg(F.array_sort(F.collect_list(F.struct(F.col("first_u").alias("o"), ev.alias("e"))))
              .alias("evs"), F.max("last_no").alias("last_no")))
    page = F.struct(_iso(F.col("snap_ts")).alias("page_ts"), "page_no", (F.col("last_no") == F.col("page_no")).alias("last"),
                    F.transform("evs", lambda x: x["e"]).alias("events"))
    return g.select(page.alias("page")).select(F.to_json("page").alias("value"))
