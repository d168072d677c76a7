"""Parity join against a plain all-pairs statement of the rule."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pricescope.llm import parity_join as pj

SF = "/root/testdata/sf0.01"


def brute(rows, words, num, den):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        k = min(words, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    up = {i: i for i, _ in rows}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    by = {}
    for j, s in enumerate(sets):
        near = set()
        for x in s:
            near.update(by.setdefault(x, []))
            by[x].append(j)
        for i in near:
            inter = len(s & sets[i])
            if den * inter >= num * (len(s) + len(sets[i]) - inter):
                a, b = sorted((top(rows[i][0]), top(rows[j][0])))
                up[b] = a
    return sorted((i, len(s), top(i)) for (i, _), s in zip(rows, sets, strict=True))


def got(spark, rows, spec):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(tuple(r)[:2] + (r["component_id"],) for r in pj.parity_join(df, spec).collect())


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_groups_of_near_copies_match_brute_force(spark):
    rng = random.Random(5)
    texts = []
    for size in (1, 2, 4, 9, 18, 30, 60, 150, 400):
        base = [f"w{rng.randrange(500)}" for _ in range(size)]
        texts += family(rng, base, 25, max(1, size // 40 + 1))
    texts += ["", None, "  \n", "Same Words here", "same words\there", "a", "A"]
    rng.shuffle(texts)
    rows = list(enumerate(texts, 7))
    for words, num, den in ((3, 90, 100), (5, 8, 10)):
        spec = pj.JoinSpec(words=words, num=num, den=den)
        assert got(spark, rows, spec) == brute(rows, words, num, den)


def test_query_on_whole_table_matches_brute_force(spark):
    from pricescope.llm import queries
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    out = queries.op1_parity_join(spark, SF).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out) == brute(rows, 3, 90, 100)


def test_nulls_ties_extra_columns_and_empty_table(spark):
    schema = "n long, text string, doc_id long, component_id string"
    df = spark.createDataFrame([(9, "a b c d", 4, "z"), (9, "a b c d", 4, "z"), (1, "a b c d", None, None),
                                (None, "A b c d", 2, ""), (0, None, 3, "q")], schema)
    rows = sorted((tuple(r) for r in pj.parity_join(df).collect()), key=str)
    assert rows == sorted([(4, 1, 2, 2), (4, 1, 2, 2), (None, 1, None, None), (2, 1, 2, 2), (3, 0, 3, 3)], key=str)
    assert pj.parity_join(df.limit(0)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=5, max_size=90), st.integers(0, 9), st.integers(0, 9),
       st.sampled_from([(90, 100), (8, 10)]), st.randoms())
def test_linked_sets_share_a_block_and_keep_the_hamming_bound(base, drop, add, t, rng):
    np = pytest.importorskip("numpy")
    spec = pj.JoinSpec(num=t[0], den=t[1])
    other = set(rng.sample(sorted(base), max(1, len(base) - drop))) | {rng.getrandbits(64) for _ in range(add)}
    a, b = (np.array(sorted(x), np.uint64) for x in (base, other))
    inter = len(base & other)
    diff = len(base ^ other)
    assert int(np.bitwise_count(pj.bit_sketch(a) ^ pj.bit_sketch(b)).sum()) <= diff
    if diff and spec.den * inter >= spec.num * (len(a) + len(b) - inter):
        assert set(pj.block_keys(a, spec).tolist()) & set(pj.block_keys(b, spec).tolist())


def test_only_the_result_stays_in_the_shared_folder(spark):
    """What the join writes on its way is deleted (before, every table stayed)."""
    import os

    from pricescope.session import checkpoint_root

    root = checkpoint_root(spark).removeprefix("file:")
    held = lambda: set(os.listdir(f"{root}/llm")) if os.path.isdir(f"{root}/llm") else set()
    before = held()
    words = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, words), (2, words + " x"), (3, "other text"), (4, None)], "doc_id long, text string")
    out = pj.parity_join(docs, pj.JoinSpec())
    assert sorted((r["doc_id"], r["component_id"]) for r in out.collect()) == [(1, 1), (2, 1), (3, 3), (4, 4)]
    assert len(held() - before) == 1
