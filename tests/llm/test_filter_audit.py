"""Operator 12: contingency tensors of filters."""

import itertools
import random
import re
from collections import Counter

from pricescope.llm import filter_audit as fa

DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"


def _fails(rows):
    first = {}
    for i, t, _ in rows:
        first[t or ""] = min(i, first.get(t or "", i))
    out = {}
    for i, t, _ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        out[i] = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                  "D": bool(re.search(r"[#$%&*|]", t)), "E": i > first[t]}
    return out


def _want(rows, labels):
    fails, marks = _fails(rows), {i: (q == 1, x == 1) for i, q, x in labels}
    out, taken = {}, Counter()
    for part in {lang or "" for *_, lang in rows}:
        ids = [i for i, _, lang in rows if (lang or "") == part]
        for order in itertools.permutations("ABCDE"):
            left = list(ids)
            for step, f in enumerate(order, 1):
                gone = [i for i in left if fails[i][f]]
                left = [i for i in left if not fails[i][f]]
                taken[part, f] += len(gone)
                out[part, "".join(order), step] = (
                    f, len(left), len(gone), sum(fails[i][f] for i in ids) - len(gone),
                    sum(fails[i][f] and sum(fails[i].values()) == 1 for i in ids),
                    sum(marks.get(i, (0, 0))[0] for i in gone), sum(marks.get(i, (0, 0))[1] for i in gone))
    return {k: (*v, taken[k[0], v[0]]) for k, v in out.items()}


def _got(df):
    return {(r.part, r.filter_order, r.step): (r.filter, r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
            for r in df.collect()}


def _rows(n=150, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rnd.choice("abcdefgh") * rnd.randint(1, 9) + str(rnd.randint(0, 40)) for _ in range(rnd.choice([0, 20, 100, 130]))]
        if rnd.random() < 0.3:
            words = [f"w{k}" for k in range(len(words))]
        t = rnd.choice([" ", "\t\n", " \x0b"]).join(words)
        t = t.upper() if rnd.random() < 0.2 else t
        t += rnd.choice(["", "", " | $", " é"])
        rows.append((i, rnd.choice([t, t, "hot copy " * 60, None, ""]), rnd.choice(["en", "de", None, ""])))
    return rows


def test_audit_equals_running_the_filters_in_every_order(spark):
    rows = _rows()
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 150, 2)]
    got = _got(fa.filter_audit(spark.createDataFrame(rows, DOCS).repartition(5), spark.createDataFrame(labels, LABELS)))
    assert got == _want(rows, labels)
    assert len(got) == 3 * 600


def test_order_never_changes_what_all_filters_keep(spark):
    got = fa.filter_audit(spark.createDataFrame(_rows(60, 9), DOCS), spark.createDataFrame([], LABELS))
    last = got.where("step = 5").select("part", "kept").distinct().collect()
    assert len(last) == len({r.part for r in last})
    assert got.agg({"good_lost": "sum", "toxic_lost": "sum"}).first() == (0, 0)


def test_labels_listed_twice_nulls_and_clashing_columns(spark):
    rows = [(1, "a b", "en", 1, 2, "x"), (2, None, "en", 1, 2, "x"), (None, None, "en", 1, 2, "x"), (3, "w " * 200_000, None, 1, 2, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, code int, part int, held string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (None, 1, 1), (9, 1, 1), (2, None, None)], LABELS)
    got = _got(fa.filter_audit(docs, labels))
    # All four texts are short or repetitive; the row without an id repeats the empty text.
    assert got["en", "ABCDE", 1][:7] == ("A", 0, 3, 0, 2, 1, 1)
    assert got["en", "EABCD", 1][2] == 1 and got["", "ABCDE", 2][:3] == ("B", 0, 1)


def test_empty_tables_give_no_rows(spark):
    assert fa.filter_audit(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).collect() == []


def test_texts_are_read_in_the_jvm_and_python_gets_one_row_a_part(spark):
    rows = spark.range(1000).selectExpr("'p' || id % 3 as part", "cast(id % 32 as int) as code", "1 as good", "0 as toxic")
    parts = fa.tensors(rows, "part", "code", ["good", "toxic"], 5)
    assert parts.count() == 3 and {len(r.cells) for r in parts.collect()} == {96}
