"""Secret scan against Python's re and a hand-made ownership case."""

import hashlib
import random
import re

from pricescope.llm import secrets as sc

A = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    t = text or ""
    got = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in A.finditer(t) if len(m[2]) >= 8]
    got += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    got += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    n = [sum(g[1] == k for g in got) for k in range(3)]
    return (*n, hashlib.sha256(",".join(g[2] for g in sorted(got)).encode()).hexdigest())


def test_base_spans_match_python_on_awkward_texts(spark):
    rng = random.Random(3)
    bits = ["password=", "Token : ", "api_key\"='", "APIKEY=", "secret", "=", ":", " ", "abc12345", "short", "é🙂", "\n",
            "AKIA", "ABCDEFGH2345", "AKIAAKIA", "0123456789abcdef" * 2, "deadbeef", "passwd==x+/=-_.yyyyyyy", "tokentoken='aaaaaaaab"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 14))) for _ in range(400)]
    texts += [None, "", "token=abcdefgh1 " * 3000, "x" * 50_000 + "AKIAABCDEFGHIJKL" + "é" * 10]
    df = spark.createDataFrame([(i, t, f"s{i % 7}", "z") for i, t in enumerate(texts)], "doc_id long, text string, source string, owner string")
    out = {r["doc_id"]: r for r in sc.secret_scan(df).collect()}
    assert len(out) == len(texts)
    for i, t in enumerate(texts):
        r = out[i]
        assert (r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) == base(t), t
        mine = [s for s in r["spans"].split(",") if s and not s.startswith("opaque")]
        assert hashlib.sha256(",".join(mine).encode()).hexdigest() == r["base_sha256"]


def test_ownership_separates_examples_from_live_values(spark):
    live, shown, odd = "password=q8Zr5Lk2Vw9x", "password=Example123", "q7Rt9Lm2Xk4Vb8Nc3Zp6Wd1Fh5"
    rows = [(1, live, "a"), (2, shown, "a"), (3, shown, "b"), (4, shown, None), (5, odd, "a"), (6, f"{odd} {odd}x", "b"),
            (None, live, "a"), (None, live, "a"), (7, None, None), (8, "clean words only", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = [tuple(r) for r in sc.secret_scan(df).collect()]
    by = {}
    for r in out:
        by.setdefault(r[0], []).append(r)
    assert len(out) == len(rows) and len(by[None]) == 2 and by[None][0] == by[None][1]
    assert by[1][0][6:] == (1, 0) and by[3][0][6:] == (0, 1) and by[4][0][6:] == (0, 1)
    # the opaque run of 5 belongs to two owners; only 6's own variant is added
    assert by[5][0][5] == "" and by[6][0][5] == "opaque:27:54"
    assert by[8][0][1:] == (0, 0, 0, hashlib.sha256(b"").hexdigest(), "", 0, 0)
    assert sc.secret_scan(df.limit(0)).collect() == []


def test_a_value_of_one_owner_is_live_in_however_many_documents(spark):
    value, odd = "password=q8Zr5Lk2Vw9x", "q7Rt9Lm2Xk4Vb8Nc3Zp6Wd1Fh5"
    rows = [(i, f"{value} and {odd} in {i}", "a") for i in range(4)] + [(9, "password=Example123", "a"), (10, "password=Example123", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: r for r in sc.secret_scan(df).collect()}
    assert all((out[i].n_live, out[i].n_example) == (2, 0) and "opaque" in out[i].spans for i in range(4))
    assert (out[9].n_live, out[9].n_example) == (0, 1)
    strict = {r.doc_id: r for r in sc.secret_scan(df, sc.Ownership(repos=3)).collect()}
    assert (strict[0].n_live, strict[0].n_example) == (0, 1)
    copies = spark.createDataFrame([(i, value, "a") for i in range(9)], df.schema)
    assert {r.n_live for r in sc.secret_scan(copies, sc.Ownership(repos=1)).collect()} == {1}
