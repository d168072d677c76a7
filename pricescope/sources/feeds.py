"""Landed feed pages.

The reference polls two HTTP feeds page by page.  Here a fetcher lands
each page as one JSON line (``{"page_ts", "page_no", "markets"|"events"}``)
in a directory; these readers turn a directory -- or any DataFrame with a
``value`` column of page JSON -- into one row per market, keeping the
market's exact source text as ``raw`` and its page order ``(page_ts,
page_no, pos)`` as the version used by the keyed upserts.

Reading is a plain file scan: pages are split across tasks by file and
size, and parsing runs JVM-side (``from_json``), so a day of pages is read
in parallel rather than page by page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricescope.schemas import (PROB_FEED_MARKET, PROB_PAGE_ENVELOPE, TICK_FEED_MARKET,
                                TICK_PAGE_ENVELOPE)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages as text lines (``value``)."""
    return spark.read.text(path)


def stream_pages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same pages as a file-source stream."""
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", int(max_files))
    return r.load(path)


def tick_markets(pages: DataFrame) -> DataFrame:
    """One row per market element of tick pages: page_ts, page_no, pos,
    raw (element JSON) and the parsed fields ``m``."""
    p = pages.select(F.from_json("value", TICK_PAGE_ENVELOPE).alias("p"))
    e = p.select("p.page_ts", "p.page_no", F.posexplode("p.markets").alias("pos", "raw"))
    return e.withColumn("m", F.from_json("raw", TICK_FEED_MARKET))


def series_rows(tick_rows: DataFrame, series_ticker: str) -> DataFrame:
    """Markets of one series from a landed feed."""
    return tick_rows.where(F.col("m.series_ticker") == series_ticker)


def prob_events(pages: DataFrame, active_only: bool = True) -> DataFrame:
    """One row per event of probability pages, in page order
    (page_ts, page_no, ev_pos).  ``active_only`` applies the feed's
    ``active=true & closed=false`` selection when the event carries it."""
    p = pages.select(F.from_json("value", PROB_PAGE_ENVELOPE).alias("p"))
    e = p.select("p.page_ts", "p.page_no", F.posexplode("p.events").alias("ev_pos", "ev"))
    if active_only:
        e = e.where(F.coalesce(F.col("ev.active"), F.lit(True))
                    & ~F.coalesce(F.col("ev.closed"), F.lit(False)))
    return e


def prob_market_elements(events: DataFrame) -> DataFrame:
    """Explode the markets of each event (inner: an event without a markets
    array contributes nothing) and parse each element."""
    m = events.select("page_ts", "page_no", "ev_pos", "ev",
                      F.posexplode("ev.markets").alias("pos", "raw"))
    return m.withColumn("m", F.from_json("raw", PROB_FEED_MARKET))
