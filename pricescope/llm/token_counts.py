"""Token counts as delta-maintained rollups (operator 5).

A store folder holds, per batch, the signed per-document rows of the batch
and their sums by source, language and tokenizer version.  Inserts add,
deletes subtract what stands in the store, and a revised text does both, so
the totals are the plain sum of the committed batches' deltas and never need
the texts again.

A batch is written under its own id and becomes visible with its commit
marker, written last.  A batch that failed half-way is overwritten when it
is sent again; one that is committed is skipped, so a replay changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW = "doc_id long, source string, lang string, version string, n_docs long, n_tokens long"
KEYS = ["source", "lang", "version"]
#: Order of changes to one document within a batch when their sequence numbers tie: the later kind wins.
OPS = {"delete": 0, "insert": 1, "revise": 2}


def _counter(path: str):
    """Counts the tokens of each text with a rank file of a byte-level vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64

        import public_tokenizers
        import tiktoken
        with open(path) as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(str.split, f)}
        enc = tiktoken.Encoding("counter", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if (t := x.as_py()) else 0 for x in b.column("text")]
            yield pa.RecordBatch.from_arrays([*(c for c, name in zip(b.columns, b.schema.names, strict=True) if name != "text"),
                                              pa.array(n, pa.int64())],
                                             [*(name for name in b.schema.names if name != "text"), "n_tokens"])
    return run


@dataclass
class CountStore:
    """The rollup under ``root``, a folder all executors reach; ``tokenizers`` maps a version to its rank file."""

    spark: SparkSession
    root: str
    tokenizers: dict[str, str]

    def _read(self, what: str, schema: str) -> DataFrame:
        """Rows of the committed batches."""
        done = self.committed()
        paths = [f"{self.root}/{what}/batch={b}" for b in done]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def committed(self) -> list[int]:
        """Ids of the batches whose commit marker stands."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/commits")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n.removeprefix("batch=")) for n in names
                      if n.startswith("batch=") and fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/commits/{n}/_SUCCESS")))

    def documents(self) -> DataFrame:
        """What the store counts for each document and version just now."""
        rows = self._read("rows", ROW)
        return rows.groupBy("doc_id", *KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0")

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer_version, n_docs, n_tokens) over the committed batches."""
        rows = self._read("deltas", "source string, lang string, version string, n_docs long, n_tokens long")
        return (rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
                .where("n_docs <> 0 or n_tokens <> 0").withColumnRenamed("version", "tokenizer_version"))

    def _counted(self, changes: DataFrame) -> DataFrame:
        """The changes with a row and count per tokenizer version in place of the text."""
        fields = [f for f in changes.schema.fields if f.name != "text"]
        out = None
        for version, path in sorted(self.tokenizers.items()):
            schema = T.StructType([*fields, T.StructField("n_tokens", T.LongType())])
            got = changes.mapInArrow(_counter(path), schema).withColumn("version", F.lit(version))
            out = got if out is None else out.unionByName(got)
        return out

    def apply(self, batch: int, changes: DataFrame) -> bool:
        """Commit the changes (op, doc_id, text, source, lang and optionally seq) as one batch; False if it already is.

        ``op`` is insert, delete or revise.  An insert of a known document
        revises it; a revision of an unknown one inserts it; a delete of an
        unknown one changes nothing.  Of several changes to a document the
        one with the greatest seq counts, then the later kind, then the
        larger count.  Rows without an id can be neither revised nor deleted:
        each insert or revision of one adds to the totals.  A null text has
        no tokens and counts as a document.  Other columns are ignored.
        """
        if batch in self.committed():
            return False
        seq = F.col("seq") if "seq" in changes.columns else F.lit(0)
        text = F.when(F.col("op") != "delete", F.col("text"))
        kind = F.coalesce(*[F.when(F.col("op") == op, F.lit(i)) for op, i in OPS.items()],
                          F.raise_error(F.concat(F.lit("unknown change "), F.coalesce("op", F.lit("null")))).cast("int"))
        raw = changes.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                             F.col("lang").cast("string").alias("lang"), kind.alias("kind"), seq.cast("long").alias("seq"), text.alias("text"))
        counted = self._counted(raw)
        path = f"{self.root}/changes/batch={batch}"
        counted.write.mode("overwrite").parquet(path)
        counted = self.spark.read.schema(counted.schema).parquet(path)
        last = F.max(F.struct("seq", "kind", "n_tokens", "source", "lang")).alias("c")
        named = counted.where("doc_id is not null").groupBy("doc_id", "version").agg(last).select("doc_id", "version", "c.*")
        loose = counted.where("doc_id is null").select("doc_id", "version", "seq", "kind", "n_tokens", "source", "lang")
        plus = (named.union(loose).where("kind > 0")
                .select("doc_id", *KEYS, F.lit(1).cast("long").alias("n_docs"), "n_tokens"))
        minus = (self.documents().where("doc_id is not null").join(named.select("doc_id", "version"), ["doc_id", "version"], "left_semi")
                 .select("doc_id", *KEYS, (-F.col("n_docs")).alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens")))
        rows = f"{self.root}/rows/batch={batch}"
        plus.unionByName(minus).write.mode("overwrite").parquet(rows)
        (self.spark.read.schema(ROW).parquet(rows).groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
         .write.mode("overwrite").parquet(f"{self.root}/deltas/batch={batch}"))
        self.spark.range(1).select(F.lit(batch).alias("id")).write.mode("overwrite").parquet(f"{self.root}/commits/batch={batch}")
        return True
