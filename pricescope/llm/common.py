"""Helpers shared by the operators: written cut points, text scans, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricescope.session import checkpoint_root


#: Folders that ``cut`` wrote in the innermost ``cut_alone``.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder path under the session's shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage: work before it is not repeated when a later stage
    is retried, and an executor lost afterwards costs nothing.  The job's
    shuffle files are of no use then; Spark's cleaner drops them once the
    driver has collected its garbage, which is asked for here.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    _note(path)
    return out


def _note(path: str) -> None:
    if (made := _made.get()) is not None:
        made.append(path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def drop(*frames: DataFrame) -> None:
    """Delete tables that ``cut`` wrote; nothing that is still to be computed may read them."""
    for df in frames:
        _delete(df.sparkSession, df.scratch_path)


def cut_alone(build: Callable[[], DataFrame], name: str) -> DataFrame:
    """Write ``build()``'s result and delete every other table that was cut on the way to it."""
    made: list[str] = []
    token = _made.set(made)
    try:
        out = cut(build(), name)
    finally:
        _made.reset(token)
    for path in made[:-1]:
        _delete(out.sparkSession, path)
    _note(out.scratch_path)
    return out


def only(df: DataFrame, *cols: str) -> DataFrame:
    """The named columns by exact name; any other column is left behind."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, or a longer form of it that is no column of ``frames`` (Spark compares names without case)."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def components(edges: DataFrame, name: str = "components", most_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` as (node, component).

    ``component`` is the smallest node reachable.  Large-star and small-star
    steps alternate: each relinks every neighbour of a node to the smallest
    node of its neighbourhood until all components are stars.  A step is a
    combinable minimum per node and a join, so a hub node is never gathered
    in one task.  Nodes without an edge are not returned; null ends are
    dropped.  Each round is written to the shared folder, and the one before
    it deleted.
    """
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
            .where("u > v").distinct(), f"{name}-0")
    seen = None
    for i in range(1, most_rounds):
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        old, e = e, cut(small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .union(low.select("u", F.col("m").alias("v"))).distinct(), f"{name}-{i}")
        drop(old)
    else:
        raise RuntimeError(f"components did not converge in {most_rounds} rounds")
    tops = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(tops)
