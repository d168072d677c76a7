"""Operator 11: tree merge of sorted digest runs."""

import hashlib
from collections import defaultdict

import pytest

from pricescope.llm import exact_dedup as ed

SCHEMA = "doc_id long, text string"


def _fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def _want(rows, keep):
    groups = defaultdict(list)
    for i, t in rows:
        groups[_fold(t)].append(i)
    pick = max if keep == "largest" else min
    return sorted((i, pick(groups[_fold(t)]), len(groups[_fold(t)]), i == pick(groups[_fold(t)]),
                   hashlib.sha256(_fold(t).encode()).hexdigest()) for i, t in rows)


@pytest.mark.parametrize("parts", [1, 3, 16, 40])
@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_groups_equal_brute_force_over_any_number_of_runs(spark, parts, keep):
    texts = ["", None, "Äpfel", "äpfel", "Plain", "PLAIN", "plain ", "x" * 100_000, "Éa\nB"]
    rows = [(i * 7 % 301, "hot Copy" if i % 3 == 0 else texts[i % len(texts)] if i % 2 else f"text {i % 50}") for i in range(300)]
    rows = [(i, t) for i, t in dict(rows).items()]
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = ed.exact_groups(df, keep=keep)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect())) == _want(rows, keep)


def test_null_and_repeated_ids_keep_one_row_a_group(spark):
    rows = [(None, "a"), (None, "A"), (5, "b"), (None, "B"), (5, "b"), (5, "c")]
    got = ed.exact_groups(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    by = defaultdict(list)
    for r in got:
        by[r.text_sha256].append(r)
    assert sorted((len(g), sum(r.kept for r in g), g[0].keep_id) for g in by.values() if g[0].keep_id) == [(1, 1, 5), (3, 1, 5)]
    (nameless,) = [g for g in by.values() if g[0].keep_id is None]
    assert len(nameless) == 2 and sum(r.kept for r in nameless) == 1


def test_kept_rows_have_all_columns_whatever_their_names(spark):
    cols = ["doc_id", "text", "slot", "digest", "size", "witness", "row", "held", "best", "n", "keep_id", "c0", "own", "a.b"]
    rows = [(i, "same" if i < 4 else f"t{i}", *[f"{c}{i}" for c in cols[2:]]) for i in range(8)]
    df = spark.createDataFrame(rows, cols).repartition(4)
    got = ed.exact_dedup(df)
    assert got.columns == cols
    assert sorted(map(tuple, got.collect())) == sorted(r for r in rows if r[0] not in (1, 2, 3))


def test_empty_table(spark):
    assert ed.exact_groups(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_witness_that_disagrees_keeps_entries_apart(spark):
    rows = [(0, b"d", 3, 7, 1), (0, b"d", 3, 8, 1), (0, b"d", 3, 7, 2)]
    df = spark.createDataFrame(rows, "slot int, digest binary, size int, witness long, n long").selectExpr(
        "*", "struct(false as z, n as id, n as row) as best")
    assert sorted((r.witness, r.n) for r in ed._merge(df, 2, "smallest").collect()) == [(7, 3), (8, 1)]


def test_a_merge_sorts_once_and_uses_no_python(spark, tmp_path):
    spark.range(100).selectExpr("id as doc_id", "concat('t', id % 10) as text").repartition(4).write.parquet(str(tmp_path / "d"))
    leaves = ed._leaves(spark.read.parquet(str(tmp_path / "d")), "doc_id", "text", True, [])
    e = leaves.selectExpr("slot", "digest", "size", "witness", "1L as n", "struct(false as z, id, row) as best")
    plan = ed._merge(e, 4, "smallest")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1 and "Python" not in plan and "Arrow" not in plan
