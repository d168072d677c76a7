"""Keyed state with history: what a keyed table held as of any run (K1-K3, K6).

A table is a set of row versions.  A version holds from its run's time
(``_from``, null for rows the table started with) until the next version of
its key; of several versions of one run the greatest page order ``_p, _e, _i``
counts.  Versions are only ever added, so batches may come in any order, be
split or be replayed: what the table held at a time is the greatest version up
to it, whatever was written first.

Rows lie in ``rows/seg=<n>/bucket=<b>/batch=<label>``.  A segment is a span of
``hours``; it opens with the state at its start (``batch=carry``) and then gets
its runs' versions, so the state at a time is read from one segment.  A late
version also goes to the segments already open after its own.  A batch writes
the buckets (hash of the key) its rows fall into and nothing else, in files of
its own that a replay replaces.  Dropping old segments bounds the history; no
table is ever rewritten.

Segments that are open are listed in ``segments``, one row each, written after
their carry: a segment half written when the driver died opens again.
"""

from __future__ import annotations

import datetime as dt
from bisect import bisect_left

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricescope.functions.exprs import epoch_micros, local_rows, ts_lit

#: The segment that the rows a table starts with are in.
FIRST = -1
ORDER = ["_from", "_p", "_e", "_i"]
_VERSION = "_from timestamp_ntz, _p long, _e long, _i long"


class KeyHistory:
    """Row versions of one keyed table under ``path``.

    ``columns`` are the table's fields, the key among them.  ``buckets``
    should give files of a few hundred MB for a segment's carry.
    """

    def __init__(self, path: str, key: str, columns: T.StructType, buckets: int = 8, hours: int = 24):
        self.path, self.key, self.columns, self.buckets, self.hours = path.rstrip("/"), key, columns, buckets, hours
        self._open: list[int] | None = None

    # ---------------------------------------------------------- segments
    def segment(self, t: dt.datetime) -> int:
        """The segment a time is in."""
        return int((t - dt.datetime(1970, 1, 1)).total_seconds() // (3600 * self.hours))

    def _segment_of(self, ts: Column) -> Column:
        return F.coalesce(F.floor(epoch_micros(ts) / (3_600_000_000 * self.hours)).cast("int"), F.lit(FIRST))

    def _start(self, seg: Column) -> Column:
        return F.timestamp_micros(seg.cast("long") * F.lit(3_600_000_000 * self.hours)).cast("timestamp_ntz")

    def segments(self, spark: SparkSession) -> list[int]:
        """The open segments, oldest first."""
        rows = spark.read.schema("n long, seg int").parquet(f"{self.path}/segments").select("seg").distinct().collect()
        return sorted(r.seg for r in rows)

    def refresh(self, spark: SparkSession) -> None:
        """Read the open segments once for what a batch does with the table; ``done`` ends it."""
        self._open = self.segments(spark)

    def done(self) -> None:
        self._open = None

    def _segments(self, spark: SparkSession) -> list[int]:
        return self.segments(spark) if self._open is None else self._open

    def _log(self, spark: SparkSession, segs: list[int]) -> None:
        rows = local_rows(spark, [(1, s) for s in segs], "n long, seg int").coalesce(1)
        _replace(rows, f"{self.path}/segments", "seg")
        if self._open is not None:
            self._open = sorted({*self._open, *segs})

    def holds(self, spark: SparkSession, t: dt.datetime) -> bool:
        """Whether the state at ``t`` is still known (its segment, or one before it, is open)."""
        return self._segments(spark)[0] <= self.segment(t)

    # ------------------------------------------------------------ writing
    def initialise(self, rows: DataFrame) -> None:
        """Start the table with ``rows`` (one a key; fields they lack are null)."""
        none = [F.lit(None).cast("timestamp_ntz").alias("_from"), *[F.lit(0).cast("long").alias(c) for c in ORDER[1:]]]
        body = [(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.columns]
        self._write(rows.select(*body, *none, F.lit(FIRST).alias("seg")), "carry")
        self._log(rows.sparkSession, [FIRST])

    def _write(self, rows: DataFrame, batch: str) -> None:
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        rows = rows.withColumn("bucket", bucket).withColumn("batch", F.lit(batch))
        # Rows are dealt out by bucket; AQE splits buckets that are large.
        _replace(rows.hint("rebalance", "seg", "bucket"), f"{self.path}/rows", "seg", "bucket", "batch")

    def append(self, rows: DataFrame, batch: str, runs: list[dt.datetime]) -> None:
        """Add the versions ``rows`` (fields of the table, ``_from, _p, _e, _i``; one a key and run) of ``runs``."""
        spark = rows.sparkSession
        open_ = list(self._segments(spark))
        new = sorted({self.segment(t) for t in runs} - set(open_))
        rows = rows.select(*self.columns.names, *ORDER)
        own = self._segment_of(F.col("_from"))
        if new:
            # Each new segment starts from the newest one open before it and the batch's versions before its start.
            bases = {s: open_[bisect_left(open_, s) - 1] for s in new if open_[0] < s}
            if len(bases) < len(new):
                raise ValueError(f"{self.path}: runs before segment {open_[0]}, the oldest kept")
            to = {b: [s for s in new if bases[s] == b] for b in set(bases.values())}
            targets = F.lit(None).cast("array<int>")
            for b, segs in to.items():
                targets = F.when(F.col("seg") == b, _ints(segs)).otherwise(targets)
            carried = self._rows(spark, list(to)).withColumn("to", targets).select("to", *self.columns.names, *ORDER)
            carried = carried.unionByName(rows.withColumn("to", F.filter(_ints(new), lambda s: s > own)))
            carried = self._newest(carried.withColumn("seg", F.explode("to")).drop("to"), "seg", *ORDER)
            self._write(carried, "carry")
            self._log(spark, new)
        later = F.array_union(F.array(own), F.filter(_ints(open_), lambda s: s > own))
        self._write(rows.withColumn("seg", F.explode(later)), batch)

    def drop_before(self, spark: SparkSession, t: dt.datetime, delete) -> list[int]:
        """Forget the segments that no time from ``t`` on needs; ``delete(path)`` removes a folder."""
        open_ = self.segments(spark)
        gone = [s for s in open_ if s < max((o for o in open_ if o <= self.segment(t)), default=open_[0])]
        for s in gone:  # the list first: a segment is not read once it has left it
            delete(f"{self.path}/segments/seg={s}")
            delete(f"{self.path}/rows/seg={s}")
        return gone

    # ------------------------------------------------------------ reading
    def _rows(self, spark: SparkSession, segs: list[int]) -> DataFrame:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.columns)
        rows = spark.read.schema(f"{fields}, {_VERSION}, seg int, bucket int, batch string").parquet(f"{self.path}/rows")
        return rows.where(F.col("seg").isin(segs))

    def _newest(self, rows: DataFrame, *by: str) -> DataFrame:
        """The greatest version of each key (per group of the columns in ``by`` that are not of the version)."""
        by = [c for c in by if c not in ORDER]
        rest = [c for c in self.columns.names if c != self.key]
        got = rows.groupBy(*by, self.key).agg(F.max_by(F.struct(*rest, *ORDER), F.struct(*ORDER)).alias("r"))
        return got.select(*by, *[F.col(self.key) if c == self.key else F.col(f"r.{c}").alias(c) for c in self.columns.names],
                          *[F.col(f"r.{c}").alias(c) for c in ORDER])

    def versions(self, spark: SparkSession) -> DataFrame:
        """All versions of the newest segment."""
        return self._rows(spark, self._segments(spark)[-1:])

    def current(self, spark: SparkSession) -> DataFrame:
        """The table as it is now."""
        return self._newest(self.versions(spark)).select(*self.columns.names)

    def before(self, spark: SparkSession, t: dt.datetime) -> DataFrame:
        """The table as it was just before ``t``."""
        segs = [s for s in self._segments(spark) if s <= self.segment(t)][-1:]
        rows = self._rows(spark, segs).where(F.col("_from").isNull() | (F.col("_from") < ts_lit(t)))
        return self._newest(rows).select(*self.columns.names)

    def lookup(self, spark: SparkSession, key) -> DataFrame:
        """The current row of one key, read from its bucket alone."""
        bucket = F.pmod(F.xxhash64(F.lit(key)), F.lit(self.buckets)).cast("int")
        rows = self.versions(spark).where((F.col("bucket") == bucket) & (F.col(self.key) == F.lit(key)))
        return self._newest(rows).select(*self.columns.names)

    def at_runs(self, spark: SparkSession, runs: dict[dt.datetime, int], columns: list[Column] | None = None) -> DataFrame:
        """The table as of each of ``runs`` (time -> number): its rows with ``snap_ts``, ``run_id`` and their ``_from``.
        ``columns`` (the key among them; default: all fields) are taken of a version before it goes to the runs.

        Every version gets the time its key's next version starts, and goes
        to the runs in between; runs meet the versions of their own segment
        only, so this reads one segment for the runs of one span.
        """
        open_ = self._segments(spark)
        read = {t: open_[bisect_left(open_, self.segment(t) + 1) - 1] for t in runs}
        times = local_rows(spark, [(s, t, runs[t]) for t, s in read.items()], "seg int, snap_ts timestamp_ntz, run_id long")
        w = Window.partitionBy("seg", self.key).orderBy(F.col("_from").asc_nulls_first(), *ORDER[1:])
        rows = self._rows(spark, sorted(set(read.values()))).select("seg", *(columns or self.columns.names), *ORDER)
        names = [c for c in rows.columns if c not in ("seg", *ORDER)]
        rows = rows.withColumn("_until", F.lead("_from").over(w))
        held = ((F.col("_from").isNull() | (F.col("_from") <= F.col("snap_ts")))
                & (F.col("_until").isNull() | (F.col("snap_ts") < F.col("_until"))))
        # One row a run of the batch: their number is the caller's list.
        return rows.join(F.broadcast(times), "seg").where(held).select("snap_ts", "run_id", *names, "_from")


def _ints(values: list[int]) -> Column:
    return F.array(*[F.lit(int(v)) for v in values]).cast("array<int>")


def _replace(df: DataFrame, path: str, *partitions: str) -> None:
    """Write ``df``, replacing the partitions it has rows in."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path))
