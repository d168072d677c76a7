"""Nested overview exports (K8-K10), re-aimed for scale.

The reference assembles one in-memory document: metadata plus every
market nested as series -> events -> markets.  A single document of all
markets would pass the whole feed through one task, so here:

* ``overview_flat`` -- one row per market with its series / event keys
  and the event fields of the event's *first* market (a partial
  ``min_by`` aggregate per event, joined back); this is the checked form;
* ``overview_metadata`` -- the document's counts from distributed
  aggregates (an event id in two series counts twice, as in the reference);
* ``overview_chunks`` -- the nested JSON, one record per (series, event,
  page chunk): a hot event is split by page ranges, so no group holds more
  than ``pages_per_chunk`` pages of markets;
* ``overview_payload`` (K9) -- the payload row: counts plus where the
  chunked document was written;
* ``active_export`` (K10) -- events and flattened markets of the landed
  probability pages with a one-row metadata frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricescope.functions.exprs import ts_lit

from pricescope.constants import OVERVIEW_MARKET_FIELDS as MARKET_FIELDS  # noqa: E402
from pricescope.constants import UNKNOWN_EVENT, UNKNOWN_SERIES  # noqa: E402


def _key_or_default(field: str, default: str):
    """``m.get(field, default)``: the default only when the key is absent;
    an explicit JSON null stays null."""
    present = F.array_contains(F.json_object_keys(F.col("raw")), field)
    return F.when(present, F.col(f"m.{field}")).otherwise(F.lit(default))


def overview_flat(tick_rows: DataFrame) -> DataFrame:
    """K8 as rows: series_id, event_id, event_title / event_close_ts of the
    event's first market (feed order), market fields, feed order."""
    rows = tick_rows.select(
        _key_or_default("series_id", UNKNOWN_SERIES).alias("series_id"),
        _key_or_default("event_id", UNKNOWN_EVENT).alias("event_id"),
        *[F.col(f"m.{c}").alias(c) for c in MARKET_FIELDS],
        F.col("m.event_title").alias("_event_title"),
        "page_ts", "page_no", "pos")
    order = F.struct("page_ts", "page_no", "pos")
    first = rows.groupBy("series_id", "event_id").agg(
        F.min_by(F.struct(F.col("_event_title").alias("event_title"),
                          F.col("close_ts").alias("event_close_ts")), order).alias("f"))
    first = first.select("series_id", "event_id", "f.event_title", "f.event_close_ts")
    return (rows.drop("_event_title")
            .join(first, ["series_id", "event_id"], "left")
            .select("series_id", "event_id", "event_title", "event_close_ts", *MARKET_FIELDS,
                    "page_ts", "page_no", "pos"))


def overview_metadata(flat: DataFrame, generated_at) -> DataFrame:
    """K8 metadata: market, event (per series) and series counts.  A null
    key is a key of its own, as in the reference's dictionaries, so the
    distinct counts run over structs (which are never null)."""
    return flat.agg(
        ts_lit(generated_at).alias("generated_at"),
        F.count(F.lit(1)).alias("market_count"),
        F.count_distinct(F.struct("series_id", "event_id")).alias("event_count"),
        F.count_distinct(F.struct("series_id")).alias("series_count"))


def overview_chunks(flat: DataFrame, pages_per_chunk: int = 4) -> DataFrame:
    """K8 nested JSON in bounded records: one JSON line per (series, event,
    page chunk) with the markets of those pages in feed order."""
    mk = F.struct(*[F.col(c) for c in MARKET_FIELDS])
    chunk = (F.col("page_no") / int(pages_per_chunk)).cast("long")
    g = (flat.withColumn("chunk", chunk)
         .groupBy("series_id", "event_id", "event_title", "event_close_ts", "page_ts", "chunk")
         .agg(F.array_sort(F.collect_list(F.struct("page_no", "pos", mk.alias("m")))).alias("ms")))
    doc = F.struct("series_id", F.struct("event_id", "event_title",
                                         F.col("event_close_ts").alias("close_ts")).alias("event"),
                   "chunk", F.transform("ms", lambda x: x["m"]).alias("markets"))
    return g.select("series_id", "event_id", "chunk", F.to_json(doc).alias("value"))


_PLACE = ["series_id", "event_id", "chunk"]


def write_overview(flat: DataFrame, path: str, generated_at=None, pages_per_chunk: int = 4) -> None:
    """Write the nested overview as one JSON document, in parallel.

    The part files, in the order of their names, are one document: a head
    with the metadata, the records of ``overview_chunks`` as the list
    ``events``, and an end.  Every record but the first has its comma, so no
    task needs to know its neighbours, and no part holds more than its range.
    """
    place = F.struct(*[F.struct(F.col(c).isNull(), F.col(c)) for c in _PLACE])
    chunks = overview_chunks(flat, pages_per_chunk).withColumn("at", place)
    first = chunks.agg(F.min("at")).scalar()
    record = F.concat(F.when(F.col("at") == first, F.lit("")).otherwise(F.lit(",")), F.col("value"))
    meta = overview_metadata(flat, generated_at if generated_at is not None else F.current_timestamp())
    none = F.lit(None).cast(chunks.schema["at"].dataType).alias("at")
    head = meta.select(F.lit(0).alias("k"), none, F.concat(F.regexp_replace(F.to_json(F.struct("*")), r"\}$", ""),
                                                           F.lit(',"events":[')).alias("value"))
    end = flat.sparkSession.range(1, numPartitions=1).select(F.lit(2).alias("k"), none, F.lit("]}").alias("value"))
    rows = head.unionByName(chunks.select(F.lit(1).alias("k"), "at", record.alias("value"))).unionByName(end)
    # Parts are ranges of (k, at); their files are numbered in that order.
    (rows.repartitionByRange("k", "at").sortWithinPartitions("k", "at").select("value")
     .write.mode("overwrite").text(path))


def read_overview(spark, path: str) -> DataFrame:
    """The markets of a written document: series_id, event_id, event_title, event_close_ts and the market fields."""
    market = ", ".join(f"{c}:{'int' if c in ('yes_ask', 'no_ask') else 'bigint' if c in ('volume', 'open_interest') else 'string'}"
                       for c in MARKET_FIELDS)
    doc = f"struct<series_id:string, event:struct<event_id:string, event_title:string, close_ts:string>, markets:array<struct<{market}>>>"
    lines = spark.read.text(path).where(F.col("value").rlike(r"^,?\{") & ~F.col("value").endswith('"events":['))
    d = lines.select(F.from_json(F.regexp_replace("value", "^,", ""), doc).alias("d"))
    return d.select("d.series_id", "d.event.event_id", "d.event.event_title", F.col("d.event.close_ts").alias("event_close_ts"),
                    F.inline("d.markets"))


def overview_payload(flat: DataFrame, generated_at, payload_path: str) -> DataFrame:
    """K9: the payload-snapshot row (counts and the location of the
    document, see ``write_overview``) to append to the snapshot table."""
    return overview_metadata(flat, generated_at).withColumn("payload_path", F.lit(payload_path))


def active_export(events: DataFrame, flat_markets: DataFrame, generated_at, source: str):
    """(metadata row, events, markets) of one landed fetch."""
    meta = flat_markets.agg(F.count(F.lit(1)).alias("market_count")).select(
        ts_lit(generated_at).alias("generated_at"),
        events.agg(F.count(F.lit(1))).scalar().alias("event_count"),
        "market_count", F.lit(source).alias("source"))
    ev = events.select("page_ts", "page_no", "ev_pos", F.col("ev.id").alias("event_id"),
                       F.col("ev.slug").alias("slug"), F.col("ev.title").alias("title"),
                       F.col("ev.category").alias("category"))
    return meta, ev, flat_markets
