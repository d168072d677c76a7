"""Ingest transforms and current-state maintenance.

Keyed upserts reduce the incoming rows to the latest version per key
(``max_by(row, version)``) and join them with the stored rows once.  The
aggregate is declarative, so Spark combines map-side before the shuffle;
a key repeated in a third of all pages costs one partial row per task,
never a third of the data in one task.  The version is ``(run, page_ts,
page_no, pos)`` -- explicit page order, never row arrival -- and stored
rows rank below any incoming row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricescope.functions.exprs import empty_to_null, ts_lit


# ----------------------------------------------------------------- helpers
def parse_ts(c: Column) -> Column:
    """Feed times: empty -> null; ISO text (with or without zone) -> UTC
    wall time as TIMESTAMP_NTZ; unparsable -> null."""
    return F.try_to_timestamp(empty_to_null(c)).cast("timestamp_ntz")


def _try_double(c: Column) -> Column:
    """Feed numbers: text or number -> double, null if it is neither."""
    return F.trim(c.cast("string")).try_cast("double")


def json_array(c: Column) -> Column:
    """List-valued feed fields: parse text that
    looks like a JSON array into array<string>; anything else -> null."""
    t = F.trim(c)
    return F.when(t.startswith("[") & t.endswith("]"), F.from_json(t, "array<string>"))


# ------------------------------------------------------------- I7 outcomes
def outcome_map(outcomes: Column, prices: Column) -> Column:
    """I7 map label -> price.  Equal-length lists, every price a number,
    otherwise null.  Duplicate labels keep the last price
    (spark.sql.mapKeyDedupPolicy=LAST_WIN)."""
    o = json_array(outcomes)
    p = F.transform(json_array(prices), lambda x: _try_double(x))
    ok = (F.size(o) == F.size(p)) & F.forall(p, lambda x: x.isNotNull())
    return F.when(o.isNotNull() & p.isNotNull() & ok, F.map_from_arrays(o, p))


def _last_label(m: Column, label: str) -> Column:
    hits = F.filter(F.map_entries(m), lambda e: F.lower(e["key"]) == label)
    return F.try_element_at(hits, F.lit(-1))["value"]


def yes_no_prices(m: Column) -> tuple[Column, Column]:
    """(yes, no): case-insensitive labels, last match wins; when there is
    no "yes" and exactly two outcomes, yes := first and no := second
    (overriding a "no" label)."""
    yes, no = _last_label(m, "yes"), _last_label(m, "no")
    entries = F.map_entries(m)
    fallback = yes.isNull() & (F.size(m) == 2)
    return (F.when(fallback, entries[0]["value"]).otherwise(yes),
            F.when(fallback, entries[1]["value"]).otherwise(no))


# ----------------------------------------------------------------- tick, I1
def normalize_tick(rows: DataFrame, fail_on_missing_key: bool = True) -> DataFrame:
    """I1 (+ I8): tick feed element -> current-state row.  Key = ``ticker``,
    else ``market_ticker`` (empty counts as missing); empty times -> null;
    ``raw`` keeps the source JSON.  A missing key fails the job (I8) via
    ``raise_error`` evaluated on the executors."""
    m = lambda c: F.col(f"m.{c}")
    key = F.coalesce(empty_to_null(m("ticker")), empty_to_null(m("market_ticker")))
    if fail_on_missing_key:
        key = F.when(key.isNull(), F.raise_error(F.lit("row missing market_ticker in feed page")
                                                 )).otherwise(key)
    return rows.select(
        key.alias("market_ticker"), m("series_ticker").alias("series_ticker"), m("title").alias("title"),
        m("status").alias("status"), parse_ts(m("open_time")).alias("open_time"),
        parse_ts(m("close_time")).alias("close_time"),
        parse_ts(m("expiration_time")).alias("expiration_time"),
        m("yes_bid").alias("yes_bid"), m("yes_ask").alias("yes_ask"), m("no_bid").alias("no_bid"),
        m("no_ask").alias("no_ask"), m("volume").alias("volume"),
        m("open_interest").alias("open_interest"), F.col("raw"),
        "page_ts", "page_no", "pos")


# ------------------------------------------------------------ prob, I2-I4, I9
def flatten_prob(elements: DataFrame) -> DataFrame:
    """I4 + I7: event -> market rows; slug, category and dates inherit the
    event's when the market's is empty or missing."""
    m = lambda c: F.col(f"m.{c}")
    ev = lambda c: F.col(f"ev.{c}")
    om = outcome_map(m("outcomes"), m("outcomePrices"))
    yes, no = yes_no_prices(F.col("outcome_map"))
    flat = elements.select(
        m("id").alias("market_id"), m("conditionId").alias("condition_id"),
        F.coalesce(empty_to_null(m("slug")), ev("slug")).alias("slug"),
        m("question").alias("question"),
        F.coalesce(empty_to_null(m("category")), ev("category")).alias("category"),
        m("active").alias("active"), m("closed").alias("closed"),
        m("enableOrderBook").alias("enable_order_book"),
        F.coalesce(empty_to_null(m("startDate")), ev("startDate")).alias("start_date"),
        F.coalesce(empty_to_null(m("endDate")), ev("endDate")).alias("end_date"),
        m("liquidity").alias("liquidity"), m("volume").alias("volume"),
        m("volume24hr").alias("volume_24hr"),
        om.alias("outcome_map"),
        ev("id").alias("event_id"), ev("slug").alias("event_slug"), ev("title").alias("event_title"),
        ev("category").alias("event_category"), ev("startDate").alias("event_start"),
        ev("endDate").alias("event_end"), "raw", "page_ts", "page_no", "ev_pos", "pos")
    return flat.withColumn("outcome_yes_price", yes).withColumn("outcome_no_price", no)


def normalize_prob(flat: DataFrame) -> DataFrame:
    """I2 + I9: safe numeric casts, outcome map as JSON text (an empty map
    counts as missing); markets without a condition id are skipped."""
    om = F.col("outcome_map")
    return flat.where(empty_to_null(F.col("condition_id")).isNotNull()).select(
        "condition_id", "market_id", "slug", "question", "category", "active", "closed",
        "enable_order_book", parse_ts(F.col("start_date")).alias("start_date"),
        parse_ts(F.col("end_date")).alias("end_date"),
        _try_double(F.col("liquidity")).alias("liquidity"),
        _try_double(F.col("volume")).alias("volume"),
        _try_double(F.col("volume_24hr")).alias("volume_24hr"),
        "outcome_yes_price", "outcome_no_price",
        F.when(F.size(om) > 0, F.to_json(om)).alias("outcome_prices"),
        "event_id", "raw", "page_ts", "page_no", "ev_pos", "pos")


def skipped_count(flat: DataFrame) -> DataFrame:
    """I9 bookkeeping: how many flattened markets had no condition id."""
    return flat.agg(F.count_if(empty_to_null(F.col("condition_id")).isNull()).alias("n_skipped"))


def event_rows(flat: DataFrame) -> DataFrame:
    """I3 + K3 (first part): one event row per (run, event id) -- the
    *first* market row of the event in page order wins within a run (a run
    is the set of pages sharing ``page_ts``) -- from markets that were not
    skipped.  Across runs the upsert's later-wins order applies."""
    kept = flat.where(empty_to_null(F.col("condition_id")).isNotNull()
                      & empty_to_null(F.col("event_id")).isNotNull())
    order = F.struct("page_ts", "page_no", "ev_pos", "pos")
    body = F.struct("event_slug", "event_title", "event_category", "event_start", "event_end")
    g = kept.groupBy("page_ts", "event_id").agg(F.min_by(body, order).alias("e"),
                                                 F.min(order).alias("v"))
    return g.select(
        "event_id", F.col("e.event_slug").alias("event_slug"), F.col("e.event_title").alias("event_title"),
        F.col("e.event_category").alias("category"),
        parse_ts(F.col("e.event_start")).alias("start_date"),
        parse_ts(F.col("e.event_end")).alias("end_date"),
        F.to_json(F.struct(F.col("event_id"), F.col("e.event_slug").alias("event_slug"),
                           F.col("e.event_title").alias("event_title"),
                           F.col("e.event_category").alias("category"),
                           F.col("e.event_start").alias("startDate"),
                           F.col("e.event_end").alias("endDate"))).alias("raw"),
        F.col("page_ts"), F.col("v.page_no").alias("page_no"),
        F.col("v.ev_pos").alias("ev_pos"), F.col("v.pos").alias("pos"))


# ------------------------------------------------------------ K1/K2/K3 upsert
def upsert(existing: DataFrame, incoming: DataFrame, key: str, order: list[str], run_ts,
           run_rank: int = 1, keep_version: bool = False) -> DataFrame:
    """K1/K2/K3: keyed upsert, later row wins.

    ``incoming`` rows carry their page order in ``order``; the latest one
    per key replaces the stored row, whose ``updated_at`` becomes
    ``run_ts``.  Stored keys absent from ``incoming`` stay as they are.

    Without a stored version, every stored row ranks below every incoming
    row.  With ``keep_version=True`` the result keeps the winning version
    in ``_v`` and a stored ``_v`` is compared with the incoming one, so
    applying pages in any batch split or order converges to the same state.
    """
    cols = [c for c in existing.columns if c != "_v"]
    payload = [c for c in cols if c not in (key, "updated_at")]
    vtype = "struct<_run:int, _o0:string, _o1:bigint, _o2:int, _o3:int>"
    new_v = F.struct(F.lit(run_rank).alias("_run"),
                     *[(F.col(c).cast("string") if i == 0 else F.col(c).cast("bigint" if i == 1 else "int"))
                       .alias(f"_o{i}") for i, c in enumerate(order)],
                     *[F.lit(None).cast("int").alias(f"_o{i}") for i in range(len(order), 4)])
    new = incoming.select(key, F.struct(*payload, ts_lit(run_ts).alias("updated_at")).alias("_new"), new_v.cast(vtype).alias("_nv"))
    won = new.groupBy(key).agg(F.max_by("_new", "_nv").alias("_new"), F.max("_nv").alias("_nv"))
    zero = F.struct(F.lit(0).alias("_run"), *[F.lit(None).alias(f"_o{i}") for i in range(4)]).cast(vtype)
    old_v = F.coalesce(F.col("_v").cast(vtype), zero) if "_v" in existing.columns else zero
    old = existing.select(key, F.struct(*payload, "updated_at").alias("_old"), old_v.alias("_ov"))
    # One aggregate over the incoming rows, one pass over the stored ones.
    both = old.join(won, key, "full_outer")
    later = F.col("_ov").isNull() | (F.col("_nv") > F.col("_ov")) | (F.col("_nv") == F.col("_ov"))
    pick = lambda n, o: F.when(F.col("_nv").isNotNull() & later, F.col(n)).otherwise(F.col(o))
    out = both.select(key, pick("_new", "_old").alias("r"), pick("_nv", "_ov").alias("_v"))
    return out.select(*[F.col(c) if c == key else F.col(f"r.{c}").alias(c) for c in cols], *(["_v"] if keep_version else []))


# ------------------------------------------------------------------ K4, K11
def open_run(runs: DataFrame, started_at, source: str, host: str, note: str | None = None) -> DataFrame:
    """K4 (start): append a run row with the next run id (max + 1, a scalar
    subquery), n_markets 0 and no finish time."""
    row = runs.agg(F.max("run_id").alias("_m")).select(
        (F.coalesce(F.col("_m"), F.lit(0)) + 1).cast("long").alias("run_id"), ts_lit(started_at).alias("started_at"),
        F.lit(None).cast("timestamp_ntz").alias("finished_at"), F.lit(source).alias("source"),
        F.lit(host).alias("host"), F.lit(0).cast("long").alias("n_markets"),
        F.lit(note).cast("string").alias("note"))
    return runs.unionByName(row)


def close_run(runs: DataFrame, n_markets: Column, finished_at, run_id: int | None = None) -> DataFrame:
    """K4 (finish): set the final count and finish time on run ``run_id``
    (None: the newest).  ``n_markets`` is a scalar (e.g. the ``count`` of
    the ingested rows as a scalar subquery)."""
    closing = runs.agg(F.max("run_id")).scalar() if run_id is None else F.lit(int(run_id))
    is_new = F.col("run_id") == closing
    return runs.select(
        "run_id", "started_at",
        F.when(is_new, ts_lit(finished_at)).otherwise(F.col("finished_at")).alias("finished_at"),
        "source", "host",
        F.when(is_new, n_markets.cast("long")).otherwise(F.col("n_markets")).alias("n_markets"),
        "note")


def append_ingest_log(log: DataFrame, rows: DataFrame) -> DataFrame:
    """Append ingest events (id, ts_utc, source, host, note)."""
    return log.unionByName(rows.select(*log.columns))
