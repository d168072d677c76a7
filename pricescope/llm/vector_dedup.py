"""Embedding near-dedup by spherical k-means cells (operator 9).

Vectors are normalised in double precision and equal ones form a class.
Spherical k-means, fitted on a bounded sample (``Cells.sample`` rows), gives
the centres; every vector has the cell of its nearest centre as home.  A
vector close to the border of a later cell is a guest there too, so a pair
across the border is compared once, in the later cell.  ``margin`` is the
distance to the border up to which a vector is a guest: with
sqrt(2 - 2 * least) no pair can be missed; a smaller margin misses pairs
that straddle a border along its normal, and the tests measure the recall.

Vectors in the order of their home cells are dealt into bundles of bounded
size: many small cells, or a part of a large one.  A vector goes once to each
later bundle with a cell it is a guest in, however many cells that are, and a
pair of bundles is compared there cell by cell, in tiles, as matrix products.
A pair of bundles returns the number of links of each vector and a spanning
forest of the links, never the links themselves, so a large group of near
copies stays linear in what is shuffled.  The pairs are dealt into rounds that
move each vector a few times each; a round's shuffle files go before the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricescope.llm.common import components, cut, drop


@dataclass(frozen=True)
class Cells:
    """``per_cell`` vectors a cell are aimed at, with at most ``most`` centres from ``sample`` rows at most.

    A task holds two bundles of ``bundle`` vectors and compares ``block`` with
    four times as many at once; a round moves a vector ``copies`` times or so.
    """

    least: float = 0.9
    margin: float = 0.3
    per_cell: int = 1500
    most: int = 1024
    sample: int = 20_000
    rounds: int = 8
    block: int = 1024
    bundle: int = 32_768
    copies: int = 4


def normalised(v) -> bytes | None:
    """Unit vector as little-endian doubles; None for a null or zero vector or one with a null or non-finite part."""
    if v is None or not len(v) or any(x is None for x in v):
        return None
    x = np.array(v, "<f8")
    if not np.isfinite(x).all() or not x.any():
        return None
    x = x / np.abs(x).max()
    return (x / np.sqrt((x * x).sum())).astype("<f8").tobytes()


def spherical_kmeans(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """k unit centres of the rows of x: the first by order, each next far from the last ones, then Lloyd rounds."""
    rng = np.random.default_rng(0)
    c = x[rng.permutation(len(x))[:k]]
    for _ in range(rounds):
        at = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        size = np.sqrt((total * total).sum(axis=1, keepdims=True))
        c = np.where(size > 1e-12, total / np.maximum(size, 1e-12), c)
    return c


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        v = [normalised(x) for x in b.column("v").to_pylist()]
        yield pa.record_batch({"vec_id": b.column("vec_id"), "v": pa.array(v, pa.binary())})


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of unit vectors of one length."""
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1)


def _by_length(b: pa.RecordBatch, tile: int) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    """The rows of each vector length, in tiles: (length, places in the batch, rows)."""
    dims = np.fromiter((len(v) // 8 for v in b.column("v").to_pylist()), np.int64, b.num_rows)
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        for i in range(0, len(at), tile):
            yield int(d), at[i:i + tile], b.take(pa.array(at[i:i + tile]))


def _apart(c: np.ndarray) -> np.ndarray:
    """Distances between centres, which turn a difference of cosines into a distance to the border."""
    return np.sqrt(np.maximum(2 - 2 * (c @ c.T), 1e-12))


def _homes(centres: dict[int, np.ndarray], cells: Cells):
    """Home cell of each class: (dims, cell)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, at, part in _by_length(b, cells.block):
                home = (_matrix(part.column("v")) @ centres[d].T).argmax(axis=1) if d in centres else np.zeros(len(at), np.int64)
                yield pa.record_batch({"dims": pa.array(np.full(len(at), d), pa.int32()), "cell": pa.array(home, pa.int32())})
    return run


def _bundles(sizes: list[tuple[int, int, int]], size: int) -> tuple[dict[int, dict[int, tuple[int, int]]], int]:
    """Place of each cell, (first place, places), in the order of length and cell, and the number of bundles; the
    bundle of a place is place // size, and no bundle holds two lengths."""
    out, place, last = {}, 0, None
    for dims, cell, n in sorted(sizes):
        if dims != last and place % size:
            place += size - place % size
        out.setdefault(dims, {})[cell] = (place, n)
        place, last = place + n, dims
    return out, -(-place // size)


def _placed(centres: dict[int, np.ndarray], places: dict[int, dict[int, tuple[int, int]]], cells: Cells):
    """Bundle of each class and the later bundles (``to``) where it has to meet others: (bundle, to, cell, cid, mult, v)."""
    # Cells with vectors, in order, and the first and last bundle of each.
    held = {d: (np.array(sorted(p)), np.array([p[c] for c in sorted(p)])) for d, p in places.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apart = {d: _apart(c) for d, c in centres.items()}
        for b in batches:
            for d, at, part in _by_length(b, cells.block):
                names, spans = held[d]
                low, high = spans[:, 0] // cells.bundle, (spans.sum(axis=1) - 1) // cells.bundle
                cid = np.asarray(part.column("cid"))
                if d in centres:
                    s = _matrix(part.column("v")) @ centres[d].T
                    # Only cells that were counted: a product of other shape may round a tie the other way.
                    home = names[s[:, names].argmax(axis=1)]
                    rows = np.arange(len(home))
                    near = (s[rows, home][:, None] - s)[:, names] <= cells.margin * apart[d][home][:, names]
                    near &= names > home[:, None]
                    near[rows, np.searchsorted(names, home)] = True
                else:
                    home, near = np.zeros(len(at), np.int64), np.ones((len(at), 1), bool)
                mine = spans[np.searchsorted(names, home)]
                # Multiplied first: ids count up, and neighbours need not share a bundle.
                scattered = (cid.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                bundle = (mine[:, 0] + (scattered % mine[:, 1].astype(np.uint64)).astype(np.int64)) // cells.bundle
                # A cell's bundles are low..high: marks at their ends, summed up along the bundles.
                first = int(low[0])
                marks = np.zeros((len(names), int(high[-1]) - first + 2), np.int32)
                np.add.at(marks, (np.arange(len(names)), low - first), 1)
                np.add.at(marks, (np.arange(len(names)), high - first + 1), -1)
                meets = (near.astype(np.float32) @ marks.cumsum(axis=1)[:, :-1].astype(np.float32)) > 0
                to = [(np.flatnonzero(m[g + 1 - first:]) + g + 1).tolist() for m, g in zip(meets, bundle.tolist(), strict=True)]
                yield pa.record_batch({"bundle": pa.array(bundle, pa.int32()), "to": pa.array(to, pa.list_(pa.int32())),
                                       "cell": pa.array(home, pa.int32()), "cid": part.column("cid"), "mult": part.column("mult"),
                                       "v": part.column("v")})
    return run


def _roots(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label``, the smallest member of each group, with the groups joined that the edges (a, b) link."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not ((up := label[label]) == label).all():
            label = up


def _linked(x: np.ndarray, short: np.ndarray, at: np.ndarray, left: int, right: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows ``at`` and ``left:right`` of ``x`` with a cosine of at least ``least``; ``short`` is x in single
    precision, and only what it leaves open is worked out in double."""
    doubt = max(1e-6, 2e-7 * x.shape[1])
    cosine = short[at] @ short[left:right].T
    a, b = np.nonzero(cosine >= least - doubt)
    open_ = np.flatnonzero(cosine[a, b] < least + doubt)
    keep = np.ones(len(a), bool)
    for i in range(0, len(open_), 1 << 14):
        some = open_[i:i + (1 << 14)]
        keep[some] = (x[at[a[some]]] * x[left + b[some]]).sum(axis=1) >= least
    return at[a[keep]], b[keep] + left


def _compare(centres: dict[int, np.ndarray], cells: Cells):
    """Links between the two sides of a pair of bundles: rows (kind 0: cid, number of links) and (kind 1: forest edge)."""
    def run(t: pa.Table) -> pa.Table:
        side, cell = (np.asarray(t.column(c).combine_chunks()) for c in ("side", "cell"))
        order = np.lexsort((cell, side))
        cid, mult = (np.asarray(t.column(c).combine_chunks())[order] for c in ("cid", "mult"))
        x, cell = _matrix(t.column("v"))[order], cell[order]
        short = x.astype(np.float32)
        same = t.column("i")[0].as_py() == t.column("j")[0].as_py()
        n = len(x) if same else int((side == 0).sum())
        start = 0 if same else n                      # the later bundle's vectors are x[start:], by cell
        names, first = np.unique(cell[start:], return_index=True)
        ends = np.append(first[1:], len(x) - start) + start
        c = centres.get(x.shape[1])
        apart = None if c is None else _apart(c)
        links, label = np.zeros(len(x), np.int64), np.arange(len(x))
        for lo in range(0, n, cells.block):
            tile, home = x[lo:min(lo + cells.block, n)], cell[lo:min(lo + cells.block, n)]
            near = home[:, None] == names
            if c is not None:
                gap = (tile * c[home]).sum(axis=1)[:, None] - tile @ c[names].T
                near |= (gap <= cells.margin * apart[home][:, names] + 1e-9) & (home[:, None] < names)
            for k in np.flatnonzero(near.any(axis=0)):
                at = np.flatnonzero(near[:, k]) + lo
                for left in range(first[k] + start, ends[k], 4 * cells.block):
                    right = min(left + 4 * cells.block, ends[k])
                    a, b = _linked(x, short, at, left, right, cells.least)
                    if same:                          # both orders and the vector itself meet in the home cell
                        a, b = a[a < b], b[a < b]
                    if len(a):
                        np.add.at(links, a, mult[b])
                        np.add.at(links, b, mult[a])
                        label = _roots(label, a, b)
        counted, joined = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(x)))
        return pa.table({"kind": pa.array(np.repeat([0, 1], [len(counted), len(joined)]), pa.int32()),
                         "a": pa.array(np.concatenate([cid[counted], cid[joined]]), pa.int64()),
                         "b": pa.array(np.concatenate([links[counted], cid[label[joined]]]), pa.int64())})
    return run


def _found(classes: DataFrame, centres: dict[int, np.ndarray], cells: Cells) -> list[DataFrame]:
    """What ``_compare`` returns for all pairs of bundles that can hold a link, by round."""
    lone = classes.select("v").mapInArrow(_homes(centres, cells), "dims int, cell int").groupBy("dims", "cell").count()
    places, bundles = _bundles([tuple(r) for r in lone.collect()], cells.bundle)      # a row a centre
    placed = cut(classes.select("cid", "mult", "v").mapInArrow(
        _placed(centres, places, cells), "bundle int, to array<int>, cell int, cid long, mult long, v binary"), "vector-bundles")
    # The earlier bundles that a bundle's vectors meet.
    pairs = placed.select("bundle", F.explode("to").alias("j")).distinct()
    pairs = cut(pairs.groupBy(F.col("j").alias("bundle")).agg(F.collect_list(F.col("bundle")).alias("of")), "vector-pairs")
    put = placed.join(pairs, "bundle", "left").withColumn("of", F.coalesce("of", F.array().cast("array<int>")))
    rounds = max(1, -(-bundles // cells.copies))

    def moves(r):
        """The pairs of round ``r`` that a row goes to."""
        me, none = F.col("bundle"), F.array().cast("array<struct<i:int,j:int,side:int>>")

        def pair(i, j, side):
            return F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("side"))

        def due(other):
            return F.pmod(me + other, F.lit(rounds)) == r

        return F.concat(F.when(due(me), F.array(pair(me, me, 0))).otherwise(none),
                        F.transform(F.filter("to", due), lambda j: pair(me, j, 0)),
                        F.transform(F.filter("of", due), lambda i: pair(i, me, 1)))

    out = []
    for r in range(rounds):
        rows = put.select(F.explode(moves(r)).alias("p"), "cell", "cid", "mult", "v").select("p.*", "cell", "cid", "mult", "v")
        out.append(cut(rows.groupBy("i", "j").applyInArrow(_compare(centres, cells), "kind int, a long, b long"), "vector-links"))
    drop(placed, pairs)
    return out


def vector_dedup(vectors: DataFrame, cells: Cells = Cells(), id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector.

    Vectors that are null, zero, empty, or hold a null or non-finite part
    link with nothing, as do vectors of different lengths.  A row with a null
    id is compared like others; its component is null if no member has an id,
    and it is never kept.  Rows that share an id count as vectors of their own.
    """
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    rows = cut(rows.mapInArrow(_rows, "vec_id long, v binary"), "vectors")
    classes = rows.where("v is not null").groupBy("v").agg(F.count("*").alias("mult"), F.min("vec_id").alias("rep"))
    classes = cut(classes.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    total = classes.count()
    k = max(1, min(cells.most, total // cells.per_cell))
    centres = {}
    if k > 1:
        want = min(1.0, cells.sample / total)
        sample = (classes.where(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < want * (1 << 30)).select("v").limit(2 * cells.sample).collect())
        by_size: dict[int, list[bytes]] = {}
        for (v,) in sorted(sample):
            by_size.setdefault(len(v) // 8, []).append(v)
        for size, got in by_size.items():
            x = np.frombuffer(b"".join(bytes(g) for g in got), "<f8").reshape(len(got), size)
            centres[size] = spherical_kmeans(x, min(k, len(x)), cells.rounds)
    parts = _found(classes, centres, cells)
    found = reduce(DataFrame.union, parts)
    links = found.where("kind = 0").groupBy(F.col("a").alias("cid")).agg(F.sum("b").alias("n"))
    joined = components(found.where("kind = 1").select("a", "b"), "vector-groups").withColumnRenamed("node", "cid")
    known = cut(classes.select("v", "cid", "mult", "rep").join(links, "cid", "left").join(joined, "cid", "left")
                .withColumn("component", F.coalesce("component", "cid")), "vector-known")
    drop(classes, *parts)
    first = cut(known.groupBy("component").agg(F.min("rep").alias("first")), "vector-firsts")
    known = cut(known.join(first, "component").select("v", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"), "first"),
                "vector-results")
    some = rows.where("v is not null").join(known, "v").select("vec_id", "n_links", F.col("first").alias("component_id"))
    none = rows.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return some.union(none).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
