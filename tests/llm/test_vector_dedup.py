"""Vector dedup against brute force: exact within what it links, recall of what it finds."""

import numpy as np

from pricescope.llm import vector_dedup as vd

SF = "/root/testdata/sf0.1"


def brute(rows, least=0.9):
    ids = [i for i, _ in rows]
    unit = [None if (b := vd.normalised(v)) is None else np.frombuffer(b, "<f8") for _, v in rows]
    links, up = [0] * len(rows), list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                links[i] += 1
                links[j] += 1
                a, b = sorted((top(i), top(j)))
                up[b] = a
    first = {}
    for i, x in enumerate(ids):
        first[top(i)] = min(first.get(top(i), x), x)
    return sorted((x, links[i], first[top(i)], x == first[top(i)]) for i, x in enumerate(ids))


def groups(rng, n, dims):
    out = []
    while len(out) < n:
        x = rng.normal(size=dims)
        for _ in range(rng.choice((1, 1, 2, 9, 60))):
            out.append(x + rng.normal(size=dims) * rng.choice((0, 0.05, 0.2, 0.35)) * np.linalg.norm(x) / np.sqrt(dims))
    return out[:n]


def test_full_margin_equals_brute_force_in_many_cells_and_blocks(spark):
    rng = np.random.default_rng(7)
    rows = [(i * 3, [float(y) for y in x]) for i, x in enumerate(groups(rng, 500, 12))]
    rows += [(-1, None), (-2, []), (-3, [0.0] * 12), (-4, [float("nan")] + [1.0] * 11), (-5, [None] + [1.0] * 11), (-6, [float("inf")] * 12),
             (-7, [1e-300] * 12), (-8, [2e300] * 12), (-9, [3.0, 4.0]), (-10, [3.0, 4.0])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, cid int, mult int")
    cells = vd.Cells(margin=2 ** 0.5 * 0.1 ** 0.5 * 1.01, per_cell=60, block=32)
    assert sorted(tuple(r) for r in vd.vector_dedup(df, cells).collect()) == brute(rows)


def test_a_guest_of_many_cells_is_placed_once_a_bundle(spark, tmp_path):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 24))
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    cells = vd.Cells(per_cell=6, bundle=100, block=16)
    centres = {24: vd.spherical_kmeans(x, 500, 3)}
    df = spark.createDataFrame([(i, 1, bytearray(v.tobytes())) for i, v in enumerate(x)], "cid long, mult long, v binary")
    homes = df.select("v").mapInArrow(vd._homes(centres, cells), "dims int, cell int").groupBy("dims", "cell").count().collect()
    places, bundles = vd._bundles([tuple(r) for r in homes], cells.bundle)
    got = df.mapInArrow(vd._placed(centres, places, cells), "bundle int, to array<int>, cell int, cid long, mult long, v binary").collect()
    s = x @ centres[24].T
    home = s.argmax(axis=1)
    apart = vd._apart(centres[24])
    assert sorted(r.cid for r in got) == list(range(3000)) and bundles == 30
    at = {c: (p // 100, (p + n - 1) // 100) for c, (p, n) in places[24].items()}
    guests = 0
    for r in got:
        i, h = r.cid, int(home[r.cid])
        near = [c for c in at if c == h or c > h and s[i, h] - s[i, c] <= cells.margin * apart[h, c]]
        guests += len(near)
        assert r.cell == h and at[h][0] <= r.bundle <= at[h][1]
        assert r.to == sorted({b for c in near for b in range(at[c][0], at[c][1] + 1) if b > r.bundle})
    assert guests > 12 * len(x) and max(len(r.to) for r in got) < 30       # rows before: one for each cell
    # A link at the very threshold is decided in double precision.
    y = np.array([[1.0, 0.0], [0.9, (1 - 0.81) ** 0.5], [0.9 - 1e-9, (1 - (0.9 - 1e-9) ** 2) ** 0.5]])
    assert [tuple(map(int, p)) for p in zip(*vd._linked(y, y.astype(np.float32), np.array([0]), 1, 3, 0.9))] == [(0, 1)]


def test_bundles_rounds_and_lengths_equal_brute_force(spark):
    rng = np.random.default_rng(11)
    rows = [(i, [float(y) for y in v]) for i, v in enumerate([*groups(rng, 330, 8), *groups(rng, 150, 6)])]
    rows += [(900 + i, v) for i, (_, v) in enumerate(rows[:40])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    cells = vd.Cells(margin=2 ** 0.5 * 0.1 ** 0.5 * 1.01, per_cell=40, block=8, bundle=60, copies=3)
    assert sorted(tuple(r) for r in vd.vector_dedup(df, cells).collect()) == brute(rows)


def test_query_recall_on_the_given_table(spark):
    from pricescope.llm import queries
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    x = np.array([np.frombuffer(vd.normalised(v)) for _, v in rows])
    hit = x @ x.T >= 0.9
    want = {i: int(h) - 1 for (i, _), h in zip(rows, hit.sum(1), strict=True)}
    out = {r["vec_id"]: r["n_links"] for r in vd.vector_dedup(spark.read.parquet(f"{SF}/embeddings.parquet"), vd.Cells(per_cell=50)).collect()}
    assert all(out[i] <= want[i] for i in want) and sum(out.values()) >= 0.99 * sum(want.values())
    whole = {r["vec_id"]: r["n_links"] for r in queries.op9_vector_dedup(spark, SF).collect()}
    assert whole == want


def test_null_ids_repeats_and_empty_table(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0]), (5, [2.0, 0.0]), (5, [0.0, 1.0]), (None, None), (4, [0.0, 3.0])], "vec_id long, embedding array<float>")
    out = sorted((tuple(r) for r in vd.vector_dedup(df).collect()), key=str)
    assert out == sorted([(None, 1, 5, False), (5, 1, 5, True), (5, 1, 4, False), (None, 0, None, False), (4, 1, 4, True)], key=str)
    assert vd.vector_dedup(df.limit(0)).collect() == []
