"""Containment search against a plain statement of the rule."""

import random
import re

from pricescope.llm import decontaminate as dc


def sets(text, k=5):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


def brute(docs, items):
    out = set()
    for d, text in docs:
        have = sets(text)
        for q, item in items:
            s = sets(item)
            if s and 10 * len(s & have) >= 8 * len(s):
                out.add((d, q, len(s & have), len(s)))
    return out


def test_matches_brute_force_around_the_threshold(spark):
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(3000)}"
    items = [(i * 7, " ".join(word() for _ in range(rng.choice((1, 3, 5, 6, 9, 14, 15, 25, 31, 60, 64, 120))))) for i in range(60)]
    items += [(1000, None), (1001, " - "), (1002, items[5][1])]
    docs = []
    for i in range(300):
        w = [word() for _ in range(rng.choice((0, 4, 40, 400)))]
        for _ in range(rng.randint(0, 2)):
            x = rng.choice(items)[1] or ""
            part = x.split()
            for _ in range(rng.randint(0, 3)):
                if part:
                    part[rng.randrange(len(part))] = word()
            cut = rng.randint(0, len(part) // 4)
            at = rng.randint(0, len(w))
            w[at:at] = part[cut:] if rng.random() < 0.5 else part[:len(part) - cut]
        docs.append((i, rng.choice((" ", ", ", "\n")).join(x.upper() if rng.random() < 0.1 else x for x in w)))
    docs += [(500, None), (501, ""), (502, items[0][1]), (503, "long text " * 5000 + items[9][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' as item", "1 as item_id", "text as hash")
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'y' as doc_id")
    out = dc.contained(d, q).collect()
    assert len(out) > 30 and {tuple(r)[:4] for r in out} == brute(docs, items)
    broad, dc.BROADCAST_ROWS = dc.BROADCAST_ROWS, 0
    try:
        assert {tuple(r) for r in dc.contained(d, q).collect()} == {tuple(r) for r in out}
    finally:
        dc.BROADCAST_ROWS = broad
    clean = dc.decontaminate(d, q)
    assert clean.columns == d.columns
    assert {r["doc_id"] for r in clean.collect()} == {i for i, _ in docs} - {r["doc_id"] for r in out}


def test_null_ids_repeats_and_empty_tables(spark):
    q = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "v w x y z")], "item_id long, text string")
    d = spark.createDataFrame([(None, "q A B, c d e f."), (4, "a b c d e f"), (4, "a b c d e f"), (5, "clean"), (None, "clean")],
                              "doc_id long, text string")
    assert sorted((tuple(r)[:4] for r in dc.contained(d, q).collect()), key=str) == [(4, 1, 2, 2), (None, 1, 2, 2)]
    assert [r["doc_id"] for r in dc.decontaminate(d, q).collect()] == [5]
    assert dc.contained(d.limit(0), q).collect() == [] and dc.contained(d, q.limit(0)).collect() == []
    assert dc.decontaminate(d, q.limit(0)).count() == 5


def test_columns_of_any_name_flow_through(spark):
    cols = ["bad_id", "_bad", "row", "hash", "item", "s", "d", "item_id", "n_common", "c", "m"]
    item = "one two three four five six seven eight nine ten"
    rows = [(i, t, *[f"{c}{i}" for c in cols]) for i, t in enumerate([item, "clean text of five words only", None, "x " * 50_000])]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *cols])
    got = dc.decontaminate(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == sorted(rows[1:])
