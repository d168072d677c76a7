"""Benchmark decontamination by size-partitioned MinHash containment search (operator 2), DataFrame functions only.

A text is its set of distinct 5-word shingles (lower-cased runs of letters
and digits; with fewer words the whole sequence is one shingle).  A document
contains an item when it holds at least ``num / den`` of the item's shingles.

Symmetric MinHash signatures miss short items inside long documents, whose
Jaccard similarity is near zero.  So only the items are sketched: they are
partitioned by size, and the partition sets how many of an item's smallest
shingle hashes (its bottom-b MinHash values) are searched for -- one more
than the item may lack.  A document that contains the item must then hold
one of these values, so the search misses nothing; every candidate is
verified by exact containment of the whole sets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricescope.llm.common import cut, unused

#: The searched values are broadcast only up to this many rows of 16 bytes; beyond it they are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


@dataclass(frozen=True)
class Containment:
    words: int = 5
    num: int = 8
    den: int = 10


def shingles(text: Column, words: int) -> Column:
    """Distinct 64-bit hashes of a text's word shingles; empty for a null text or one without words."""
    w = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")

    def all_of(h):
        # Out-of-range places are null and do not count in the hash, so a short sequence is one shingle.
        at = F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, words)]))
        return F.array_distinct(F.slice(at, 1, F.greatest(F.size(h) - words + 1, F.lit(1))))

    # The outer transform over one element binds the words' hashes, which would else be worked out for each element.
    return F.get(F.transform(F.array(F.transform(w, lambda x: F.xxhash64(x))), all_of), F.lit(0))


def _probes(items: DataFrame, rule: Containment) -> DataFrame:
    """(hash, item): the bottom-b values of every item, b set by its size partition."""
    n = F.size("s")
    # Partitions are powers of two; b is one more than the largest set in the partition may lack.
    top = F.pow(F.lit(2), F.floor(F.log2(n)) + 1) - 1
    b = F.floor(top * (rule.den - rule.num) / F.lit(rule.den)).cast("int") + 1
    return items.select("item", F.explode(F.slice(F.array_sort("s"), 1, b)).alias("hash"))


def contained(docs: DataFrame, items: DataFrame, rule: Containment = Containment(), id_col: str = "doc_id",
              text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_common, n_item, containment) of every document that contains an item.

    Texts without words contain nothing and are contained nowhere.  Rows of
    one id and repeated rows give one result, that of the fullest match;
    null ids are reported as null.
    """
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    items = cut(items.select(F.col(f"`{item_col}`").alias("item_id"),
                             F.array_sort(shingles(F.col(f"`{item_text}`"), rule.words)).alias("s")), "item-sets")
    items = cut(items.where(F.size("s") > 0).distinct().withColumn("item", F.xxhash64("item_id", "s")), "items")
    probes = cut(_probes(items, rule), "item-probes")
    few = probes.count() <= BROADCAST_ROWS
    # A row of a text is known by its id and the text's hash; a key of its own spares null-safe joins.
    docs = docs.where("text is not null").withColumn("row", F.xxhash64("doc_id", "text"))
    # The outer form keeps a filter on the whole array, which would work it out twice, out of the plan.
    seen = docs.select("row", F.explode_outer(shingles(F.col("text"), rule.words)).alias("hash"))
    found = cut(seen.join(F.broadcast(probes) if few else probes, "hash").select("row", "item").distinct(), "item-candidates")
    wanted = found.select("row").distinct()
    sets = cut(docs.join(wanted, "row", "left_semi").select("row", "doc_id", shingles(F.col("text"), rule.words).alias("d")),
               "item-documents")
    both = (found.join(sets, "row").join(items, "item")
            .select("doc_id", "item_id", F.size(F.array_intersect("d", "s")).cast("long").alias("n_common"),
                    F.size("s").cast("long").alias("n_item"))
            .where(F.col("n_common") * rule.den >= F.col("n_item") * rule.num))
    best = both.groupBy("doc_id", "item_id").agg(F.max(F.struct((F.col("n_common") / F.col("n_item")).alias("c"), "n_common", "n_item")).alias("m"))
    return best.select("doc_id", "item_id", "m.n_common", "m.n_item", (F.col("m.n_common") / F.col("m.n_item")).alias("containment"))


def decontaminate(docs: DataFrame, items: DataFrame, rule: Containment = Containment(), **cols) -> DataFrame:
    """The rows of ``docs`` whose document contains no item; all columns stay, whatever their names.

    A null or empty text contains nothing and stays.  Rows that repeat an id
    (null ids among themselves) go together if the text of one of them
    contains an item.  An empty table on either side removes nothing.
    """
    id_col, bad = cols.get("id_col", "doc_id"), unused("bad_id", docs)
    leaks = cut(contained(docs, items, rule, **cols).select(F.col("doc_id").alias(bad)).distinct(), "item-leaks")
    return docs.join(leaks, F.col(f"`{id_col}`").eqNullSafe(F.col(bad)), "left_anti")


def oracle(rule: Containment = Containment()) -> str:
    """The same pairs in DuckDB by joining all shingles as text."""
    def sets(table, key):
        k = rule.words
        return f"""SELECT {key}, list_distinct(list_transform(range(greatest(len(w) - {k - 1}, 1)),
      lambda i: array_to_string(w[i + 1:i + {k}], ' '))) AS s FROM (SELECT {key},
      list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM {table} WHERE text IS NOT NULL)
      WHERE len(w) > 0"""
    return f"""
WITH d AS ({sets("documents", "doc_id")}), q AS ({sets("benchmark", "item_id")}),
  a AS (SELECT doc_id, unnest(s) AS t FROM d), b AS (SELECT item_id, len(s) AS n_item, unnest(s) AS t FROM q)
SELECT doc_id, item_id, count(*) AS n_common, any_value(n_item) AS n_item, count(*) / any_value(n_item) AS containment
FROM a JOIN b USING (t) GROUP BY doc_id, item_id HAVING count(*) * {rule.den} >= any_value(n_item) * {rule.num}"""
