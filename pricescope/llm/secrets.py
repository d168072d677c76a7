"""Secret scan with corpus-wide ownership frequency (operator 6), DataFrame functions only.

Candidates are found by pattern in every whole text.  Their value hashes are
then counted over the corpus by distinct owners and repositories: a value
that several owners share is a copied example, one that belongs to one owner
and looks random is treated as live, in however many of that owner's
repositories it stands.  Without a repository column, documents of equal text
are one repository.  Opaque runs that no pattern names are
added as spans of kind ``opaque`` when they are that owner-specific.

Spans are code-point offsets, end exclusive.  A null text counts as empty.
Rows are kept one to one, repeated rows and null ids included.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricescope.llm.common import cut

# Fixed patterns of the contract; ``hex`` and ``access`` have their least lengths inside, which is
# the same as dropping short matches because a match always takes the whole run.
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
OPAQUE = r"[A-Za-z0-9+/_=-]{24,}"
KINDS = ("assign", "access", "hex", "opaque")
PATTERNS = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, OPAQUE), strict=True))
#: Positions are summed in runs of this many matches, so thousands of matches in a text stay cheap.
RUN = 256


@dataclass(frozen=True)
class Ownership:
    """A value is live if at most this many owners (and, if set, repositories) have it and it mixes enough characters."""

    owners: int = 1
    repos: int | None = None
    distinct_chars: int = 8


def _found(text: Column, kind: str) -> Column:
    """array<struct<piece, match>>: each match with the text between it and the one before."""
    p = F.lit(PATTERNS[kind])
    none = F.array().cast("array<struct<piece:bigint,size:bigint,match:string>>")
    got = F.transform(
        F.arrays_zip(F.split(text, PATTERNS[kind], -1).alias("piece"), F.regexp_extract_all(text, p, F.lit(0)).alias("match")),
        lambda x: F.struct(F.length(x["piece"]).cast("long").alias("piece"), F.length(x["match"]).cast("long").alias("size"),
                           x["match"].alias("match")))
    return F.when(text.rlike(PATTERNS[kind]), F.filter(got, lambda x: x["match"].isNotNull())).otherwise(none)


def _total(lens: Column) -> Column:
    return F.aggregate(lens, F.lit(0).cast("long"), lambda a, x: a + x)


def _placed(found: Column, lens: Column, upto: Column, kind: str) -> Column:
    """array<struct<start, o, end, kind, value>> from pieces, by sums over whole runs and within the run."""
    value = lambda m: F.regexp_extract(m, ASSIGN, 2) if kind == "assign" else m
    end = lambda i: (F.element_at(upto, (F.floor(i / RUN) + 1).cast("int"))
                     + _total(F.slice(lens, (F.floor(i / RUN) * RUN + 1).cast("int"), (i % RUN + 1).cast("int"))))
    return F.transform(found, lambda x, i: F.struct(
        (end(i) - x["size"]).alias("start"), F.lit(KINDS.index(kind)).alias("o"), end(i).alias("end"),
        F.lit(kind).alias("kind"), value(x["match"]).alias("value")))


def spans(docs: DataFrame, text: str, kind: str, out: str) -> DataFrame:
    """Add ``out``: the kind's spans in the column ``text``, in order."""
    docs = docs.withColumn("_f", _found(F.col(text), kind))
    docs = docs.withColumn("_l", F.transform("_f", lambda x: x["piece"] + x["size"]))
    runs = F.sequence(F.lit(0), F.floor((F.size("_l") - 1) / RUN).cast("int"))
    docs = docs.withColumn("_r", F.when(F.size("_l") > 0, F.transform(runs, lambda b: _total(F.slice("_l", b * RUN + 1, RUN)))))
    docs = docs.withColumn("_u", F.when(F.size("_l") > 0, F.transform(runs, lambda b: _total(F.slice("_r", 1, b)))))
    placed = _placed(F.col("_f"), F.col("_l"), F.col("_u"), kind)
    if kind == "assign":
        placed = F.filter(placed, lambda s: F.length(s["value"]) >= 8)
    if kind == "opaque":
        placed = F.filter(placed, lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))
    return docs.withColumn(out, placed).drop("_f", "_l", "_r", "_u")


def _written(spans_: Column) -> Column:
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_scan(docs: DataFrame, rule: Ownership = Ownership(), id_col: str = "doc_id", text_col: str = "text",
                owner_col: str = "source", repo_col: str | None = None) -> DataFrame:
    """One row per input row: counts and digest of the base spans, all spans, and verdict counts.

    Columns: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live
    and n_example (candidates of the row by verdict; opaque runs that are
    not live are no spans and count in neither).  A null owner or repository
    counts as one owner or repository of its own.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"),
                       F.col(f"`{owner_col}`").cast("string").alias("owner"),
                       (F.col(f"`{repo_col}`") if repo_col else F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))).cast("string").alias("repo"))
    for kind in KINDS:
        rows = spans(rows, "t", kind, kind)
    base = F.sort_array(F.concat("assign", "access", "hex"))
    rows = rows.select("doc_id", "owner", "repo", base.alias("base"), "opaque",
                       *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]])
    apart = F.filter("opaque", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (b["end"] > s["start"])))
    rows = rows.withColumn("opaque", F.when(F.size("opaque") > 0, apart).otherwise(F.col("opaque")))
    mixed = lambda v: F.size(F.array_distinct(F.split(v, ""))) >= rule.distinct_chars
    sealed = F.transform(F.sort_array(F.concat("base", "opaque")), lambda s: F.struct(
        s["start"], s["o"], s["end"], s["kind"], F.sha2(s["value"], 256).alias("value"), mixed(s["value"]).alias("mixed")))
    rows = cut(rows.select("doc_id", "owner", "repo", "n_assign", "n_access", "n_hex", _written(F.col("base")).alias("base"),
                           sealed.alias("all")), "secrets")
    rows = rows.withColumn("key", F.sha2(F.to_json(F.struct("doc_id", "all")), 256))
    some, none = rows.where(F.size("all") > 0), rows.where(F.size("all") == 0)
    held = some.select("key", F.struct(F.col("owner").alias("x")).alias("owner"), F.struct(F.col("repo").alias("x")).alias("repo"),
                       F.explode("all").alias("s")).select("key", "owner", "repo", "s.*")
    # Distinct repositories and owners per value, each deduplicated before its count.
    n_owners = held.select("value", "owner").distinct().groupBy("value").agg(F.count("*").alias("owners"))
    n_repos = held.select("value", "repo").distinct().groupBy("value").agg(F.count("*").alias("repos"))
    known = cut(n_owners.join(n_repos, "value"), "secret-owners")
    live = F.col("mixed") & (F.col("owners") <= rule.owners)
    if rule.repos is not None:
        live &= F.col("repos") <= rule.repos
    judged = (held.drop("owner", "repo").distinct().join(known, "value").withColumn("live", live)
              .where("live or kind <> 'opaque'")
              .groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "o", "end", "kind"))).alias("kept"),
                                  F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_example")))
    judged = cut(judged, "secret-verdicts")
    found = (some.join(judged, "key", "left")
             .withColumn("spans", F.coalesce(_written(F.col("kept")), F.lit(""))))
    empty = none.withColumns({"spans": F.lit(""), "n_live": F.lit(0).cast("long"), "n_example": F.lit(0).cast("long")})
    cols = ["doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans",
            F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"),
            F.coalesce("n_example", F.lit(0)).cast("long").alias("n_example")]
    return found.select(*cols).union(empty.select(*cols))


def _sql_spans(kind: str, keep: str, value: str) -> str:
    p = PATTERNS[kind].replace("'", "''")
    return f"""
  {kind}_m AS (SELECT rid, doc_id, source, generate_subscripts(m, 1) AS j, unnest(m) AS m, unnest(p[1:len(m)]) AS p
    FROM (SELECT rid, doc_id, source, regexp_extract_all(t, '{p}') AS m, string_split_regex(t, '{p}') AS p FROM docs)),
  {kind}_s AS (SELECT rid, doc_id, source, {KINDS.index(kind)} AS o, '{kind}' AS kind, {value} AS v,
      sum(length(p) + length(m)) OVER (PARTITION BY rid ORDER BY j) AS e, e - length(m) AS s
    FROM {kind}_m QUALIFY {keep})"""


def oracle(rule: Ownership = Ownership()) -> str:
    """The same rows in DuckDB SQL: matches placed by running sums, ownership by distinct counts."""
    group2 = "regexp_extract(m, '" + ASSIGN.replace("'", "''") + "', 2)"
    parts = [_sql_spans("assign", "length(v) >= 8", group2), _sql_spans("access", "true", "m"), _sql_spans("hex", "true", "m"),
             _sql_spans("opaque", "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]')", "m")]
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),{",".join(parts)},
  base AS (SELECT * FROM assign_s UNION ALL SELECT * FROM access_s UNION ALL SELECT * FROM hex_s),
  cand AS (SELECT * FROM base UNION ALL SELECT * FROM opaque_s q
    WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = q.rid AND b.s < q.e AND b.e > q.s)),
  owned AS (SELECT v, count(DISTINCT coalesce('s' || source, '')) AS owners FROM cand GROUP BY v),
  judged AS (SELECT c.*, owners <= {rule.owners}
      AND len(list_distinct(string_split(v, ''))) >= {rule.distinct_chars} AS live FROM cand c JOIN owned USING (v)),
  b AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
      count(*) FILTER (kind = 'hex') AS n_hex, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) AS base
    FROM base GROUP BY rid),
  a AS (SELECT rid, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) AS spans,
      count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example
    FROM judged WHERE live OR kind <> 'opaque' GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM docs LEFT JOIN b USING (rid) LEFT JOIN a USING (rid)"""
