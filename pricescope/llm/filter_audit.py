"""Filter interaction audit by contingency tensor contractions (operator 12).

Every document has one bit a filter: does it fail?  Spark counts the documents
of each part (and those of each mark) by their combination of bits, one row a
part; reshaped, such a row is a tensor with an axis of length two (pass, fail)
for every filter.  What a filter chain does at a step is then a contraction
of that tensor: an axis is weighted ``pass`` for the filters applied before,
``fail`` for the filter of the step and ``all`` for those that come later.
So all orders are evaluated from one pass over the texts, and the work after
that pass depends on the number of parts only.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricescope.llm.exact_dedup import exact_groups

#: Weights of an axis of the tensor.
PASS, FAIL, ALL = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])
#: Filters of one audit: the result has a row per part, order (n! of them) and step.
MOST_FILTERS = 6
#: Parts a task contracts at a time; their result is n! * n rows each.
BLOCK = 64
_SPACE = " \t\n\x0b\f\r"
_COUNTS = ["kept", "removed", "redundant", "unique_fails"]


def text_filters(text: Column) -> dict[str, Column]:
    """The text conditions A to D under which a document fails (a null text is an empty one)."""
    text = F.coalesce(text, F.lit(""))
    body = F.btrim(text, F.lit(_SPACE))
    words = F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, r"[\x20\x09-\x0D]+"))
    return {"A": F.size(words) < 100,
            "B": F.size(F.array_distinct(words)) * F.lit(100).cast("long") < F.size(words) * F.lit(80).cast("long"),
            "C": F.length(F.regexp_replace(text, "[^A-Z]+", "")) * F.lit(100).cast("long") > F.length(text) * F.lit(10).cast("long"),
            "D": text.rlike(r"[#$%&*|]")}


def tensors(docs: DataFrame, part: str, code: str, marks: list[str], n: int) -> DataFrame:
    """One row a part: its documents, and those of each mark, by the ``2 ** n`` values of ``code``."""
    counts = docs.groupBy(part, code).agg(F.count("*").alias("_0"), *[F.sum(F.col(m).cast("long")).alias(f"_{j}")
                                                                  for j, m in enumerate(marks, 1)])
    cells = [F.coalesce(F.sum(F.when(F.col(code) == i, F.col(f"_{j}"))), F.lit(0)).cast("long").alias(f"{j}_{i}")
             for j in range(1 + len(marks)) for i in range(2**n)]
    rows = counts.groupBy(part).agg(*cells)
    return rows.select(F.col(part).alias("part"), F.array(*[c for c in rows.columns if c != part]).alias("cells"))


def contract(tensor: np.ndarray, weights: list[np.ndarray]) -> np.ndarray:
    """Sum of a (parts, kinds, 2, ..., 2) tensor over all filter axes under ``weights``: (parts, kinds)."""
    axes = "abcdefgh"[: len(weights)]
    return np.einsum(f"yz{axes},{','.join(axes)}->yz", tensor, *weights)


def audit_rows(parts: list[str], cells: np.ndarray, names: list[str], marks: list[str]) -> pd.DataFrame:
    """Every part, order and step with its counts, from the parts' tensors ``cells`` (parts, kinds, 2 ** n)."""
    n = len(names)
    # Bit i of a code stands for filter i, and numpy's last axis is the lowest bit.
    tensor = cells.reshape(len(parts), 1 + len(marks), *[2] * n).transpose(0, 1, *range(n + 1, 1, -1))

    @functools.cache
    def total(choice: str) -> np.ndarray:
        return contract(tensor, [{"p": PASS, "f": FAIL, "a": ALL}[c] for c in choice])

    def at(passed, failed=()):
        return total("".join("f" if i in failed else "p" if i in passed else "a" for i in range(n)))

    out = []
    for order in itertools.permutations(range(n)):
        name = "".join(names[i] for i in order)
        for step, f in enumerate(order):
            gone = at(order[:step], (f,))
            out.append({"part": parts, "filter_order": name, "step": step + 1, "filter": names[f],
                        "kept": at(order[: step + 1])[:, 0], "removed": gone[:, 0],
                        "redundant": (at((), (f,)) - gone)[:, 0],
                        "unique_fails": at([i for i in range(n) if i != f], (f,))[:, 0],
                        **{f"{m}_lost": gone[:, j + 1] for j, m in enumerate(marks)}})
    rows = pd.concat([pd.DataFrame(x) for x in out], ignore_index=True)
    # Over all orders: what the filter takes out at whatever step it stands.
    rows["shapley"] = rows.groupby(["part", "filter"])["removed"].transform("sum")
    return rows


def interactions(parts: DataFrame, names: list[str], marks: list[str]) -> DataFrame:
    """The audit of ``tensors`` rows, contracted in tasks, ``BLOCK`` parts at a time."""
    schema = ("part string, filter_order string, step int, filter string, "
              + ", ".join(f"{c} long" for c in [*_COUNTS, *[f"{m}_lost" for m in marks], "shapley"]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), BLOCK):
                some = b.iloc[at:at + BLOCK]
                yield audit_rows(list(some["part"]), np.array(some["cells"].tolist(), dtype=np.int64), names, marks)

    return parts.mapInPandas(run, schema)


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "lang", marks: dict[str, tuple[str, int]] | None = None) -> DataFrame:
    """What each of the filters A to E takes out, per part, order of the filters and step.

    A to D are ``text_filters``; E fails a row whose text is identical to
    that of a row with a smaller id anywhere in the table.  Rows without an
    id have no smaller or larger one: they pass E if no row of that text
    has an id and fail it otherwise; rows that repeat id and text both pass.
    ``marks`` names what is also counted when lost, as a column of
    ``labels`` and its value (default: good and toxic documents).  A
    document that ``labels`` lists twice has a mark if any of its rows has;
    labels of other ids, and label rows without an id, count nothing.

    Null parts are the part of the empty string; a null text is empty.
    Counts are over rows, so repeated rows count each.  An empty table
    gives no rows.  Other columns are not read.
    """
    marks = {"good": ("quality", 1), "toxic": ("toxic", 1)} if marks is None else marks
    filters = text_filters(F.col(f"`{text_col}`"))
    names = [*filters, "E"]
    if len(names) > MOST_FILTERS:
        raise ValueError(f"at most {MOST_FILTERS} filters")
    code = functools.reduce(lambda a, b: a + b, [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(filters.values())])
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), code.alias("code"),
                       F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"))
    rows = exact_groups(rows, "id", "text", keep="smallest", fold=False, carry=["code", "part"])
    later = F.col("keep_id").isNotNull() & (F.col("id").isNull() | (F.col("id") > F.col("keep_id")))
    rows = rows.select("id", F.col("c1").alias("part"), (F.col("c0") + F.when(later, 1 << len(filters)).otherwise(0)).alias("code"))
    known = labels.where(F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").alias("id")).agg(
        *[F.max((F.col(f"`{c}`") == v).cast("int")).alias(m) for m, (c, v) in marks.items()])
    rows = rows.join(known, "id", "left")
    return interactions(tensors(rows, "part", "code", list(marks), len(names)), names, list(marks))


def oracle() -> str:
    """The same audit in DuckDB: counts by combination, every order and step from a join with the permutations."""
    space = r"[^\x20\x09-\x0D]+"
    bit, free = "((code >> (ascii(filter) - 65)) & 1)", "((code & coalesce(before, 0)) = 0)"
    return rf"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
  w AS (SELECT *, regexp_extract_all(text, '{space}') AS w, min(doc_id) OVER (PARTITION BY text) AS first_id FROM t),
  m AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
  c AS (SELECT part, CAST(len(w) < 100 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 80 * len(w) AS INT)
      + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS INT)
      + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT) + 16 * CAST(doc_id > first_id AS INT) AS code,
      coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM w LEFT JOIN m USING (doc_id)),
  n AS (SELECT part, code, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM c GROUP BY part, code),
  l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
  o AS (SELECT concat(a.f, b.f, c.f, d.f, e.f) AS filter_order FROM l a, l b, l c, l d, l e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
  s AS (SELECT filter_order, step, filter_order[step] AS filter, list_sum(list_transform(range(1, step),
      lambda i: 1 << (ascii(filter_order[i]) - 65))) AS before FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
  r AS (SELECT part, filter_order, step, filter,
      sum(n) FILTER (WHERE {free} AND {bit} = 0) AS kept, sum(n) FILTER (WHERE {free} AND {bit} = 1) AS removed,
      sum(n) FILTER (WHERE NOT {free} AND {bit} = 1) AS redundant,
      sum(n) FILTER (WHERE code = (1 << (ascii(filter) - 65))) AS unique_fails,
      sum(good) FILTER (WHERE {free} AND {bit} = 1) AS good_lost, sum(toxic) FILTER (WHERE {free} AND {bit} = 1) AS toxic_lost
    FROM n, s GROUP BY part, filter_order, step, filter)
SELECT part, filter_order, step, filter, {', '.join(f'CAST(coalesce({x}, 0) AS BIGINT) AS {x}' for x in
    ('kept', 'removed', 'redundant', 'unique_fails', 'good_lost', 'toxic_lost'))},
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM r"""
