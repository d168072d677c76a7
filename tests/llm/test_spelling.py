"""Operator 13: finite-state composition of the vocabulary with one edit."""

import itertools
import random
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from pricescope.llm import spelling as sp

DOCS = "doc_id long, text string"


def _near(u, v):
    if abs(len(u) - len(v)) > 1 or u == v:
        return False
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v, strict=True)) == 1
    u, v = sorted((u, v), key=len)
    return any(v[:i] + v[i + 1:] == u for i in range(len(v)))


def _words(rows, typos):
    counts = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if typos and h % typos == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def _want(n):
    out = {}
    for w in n:
        near = [v for v in n if _near(w, v)]
        form = min(near, key=lambda v: (-n[v], v), default=None)
        if form is not None and n[form] < 2 * n[w]:
            form = None
        out[w] = [form, None, n[w], len(near), n[form] if form else None]
    for w in out:
        r = w
        while out[r][0] is not None:
            r = out[r][0]
        out[w][1] = r
    return {w: tuple(v) for w, v in out.items()}


def _corpus(seed=5, docs=120):
    rnd = random.Random(seed)
    base = ["colour", "colours", "éclair", "eclair", "ÉCLAIR", "grüße", "aaaaa", "aaaaaa", "abcab", "abcabc", "z" * 3000]
    rows = []
    for i in range(docs):
        words = []
        for _ in range(60):
            w = rnd.choice(base)
            for _ in range(rnd.choice([0, 0, 1, 2])):
                k = rnd.randrange(len(w))
                w = rnd.choice([w[:k] + w[k + 1:], w[:k] + rnd.choice("abé") + w[k:], w[:k] + rnd.choice("abÿ") + w[k + 1:]])
            words.append(rnd.choice([w, w.upper() if w.isascii() else w]))
        rows.append((i, rnd.choice([" ", "-", "1", "\n"]).join(words)))
    return [*rows, (None, None), (7, ""), (None, "colour " * 5), (1, None)]


def _got(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_words_forms_and_roots_equal_brute_force(spark):
    rows = _corpus()
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    want = _want(_words(rows, 7))
    assert _got(sp.variants(df, sp.Variants(typos=7))) == want
    assert len(want) > 100 and any(v[0] and v[1] != v[0] for v in want.values())


def test_large_partitions_dealt_by_place_give_the_same(spark):
    rows = _corpus(8, 60)
    df = spark.createDataFrame(rows, DOCS)
    want = _want(_words(rows, 0))
    assert _got(sp.variants(df, sp.Variants(most=2))) == want
    assert _got(sp.variants(df, sp.Variants())) == want


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("ab", min_size=2, max_size=5), max_size=30))
def test_composition_accepts_exactly_the_pairs_one_edit_apart(words):
    for m in range(2, 6):
        short, long = (sorted(w for w in words if len(w) == n) for n in (m, m + 1))
        got = list(sp.near_pairs(short, long))
        want = {(u, v) for u, v in itertools.combinations(short, 2) if _near(u, v)}
        want |= {(u, v) for u in short for v in long if _near(u, v)}
        assert len(got) == len(set(got)) and set(got) == want


def test_the_acceptor_is_minimal():
    a = sp.Acceptor()
    a.add(sorted(x + y for x in "abcdef" for y in ("ing", "ang")))
    assert len(a.arcs) == 5  # the end, "g", "ng", "ang|ing", the start


def test_very_long_words_take_linear_memory():
    w = "ab" * 50_000
    short, long = sorted([w, w[:-1] + "c"]), sorted([w[:50] + "x" + w[50:], w + "b"])
    assert sorted(sp.near_pairs(short, long)) == sorted([(w, w[:-1] + "c"), (w, w + "b"), (w, w[:50] + "x" + w[50:])])


def test_empty_and_clashing_columns(spark):
    assert sp.variants(spark.createDataFrame([], DOCS)).collect() == []
    cols = ["doc_id", "text", "word", "n", "h", "at", "w", "id", "part", "m", "back", "form"]
    df = spark.createDataFrame([(i, "Spelling spelling", *["q"] * 10) for i in range(3)], cols)
    assert _got(sp.variants(df)) == {"spelling": (None, "spelling", 6, 0, None)}
