"""Spark session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every plan in this package relies on.
#  - UTC session zone: the snapshot tables are TIMESTAMP_NTZ, intervals are
#    literal, and the oracle engine is zone-less.
#  - LAST_WIN map-key dedup: outcome maps keep the last duplicate label.
#  - AQE with skew-join splitting: runtime re-planning of join strategy and
#    partition coalescing, so the static partition count only caps fan-out.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "pricescope",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Return a session with the package's required settings.

    On a cluster ``master`` stays ``None`` (spark-submit decides) and the
    shuffle partition count should be sized to the data: roughly
    input-bytes / 128 MB for the widest stage.  Locally it defaults to the
    core count.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is None and master and master.startswith("local"):
        shuffle_partitions = os.cpu_count() or 8
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of BASE_CONF to an existing session."""
    for k, v in BASE_CONF.items():
        if k in ("spark.ui.enabled", "spark.ui.showConsoleProgress"):
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: leave as is
            pass


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` as configured by the
    operator (a shared filesystem path); without it a cluster session is an
    error.  Only a session of this one machine -- local runs and tests --
    falls back to a per-user folder under the local temp directory (stable
    across sessions, so materialised test tables can be reused).
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not d:
        d = os.path.join(tempfile.gettempdir(), f"pricescope-ckpt-{os.getuid()}")
        os.makedirs(d, exist_ok=True)
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")
