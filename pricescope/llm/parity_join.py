"""N-gram Jaccard join by parity sketches (operator 1).

A document is its set of distinct word shingles.  The shingles' hashes are
dealt into blocks and XOR-ed: equal blocks have (but for 64-bit hash
collisions) equal parts, and the bit sketch, one toggled bit per shingle,
has a Hamming distance that never exceeds the symmetric difference.

For a Jaccard threshold t two linked sets differ in at most
``(1 - t) / (1 + t) * (m + n)`` shingles, so with more blocks than that per
size level at least one block is equal (pigeonhole).  Documents that share a
block are candidates; the Hamming bound removes most of the rest and the
shingle sets decide.

Groups of copies are never expanded into pairs.  Equal sets collapse into a
class first.  Members of a bucket are compared with its smallest and largest
member; only what these stars leave in different components is compared
further, so the result loses no link that joins two components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricescope.llm.common import components, cut, cut_alone, drop, only

# Fixed odd multipliers and the finaliser of splitmix64 (public domain).
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: 64-bit words of the folded bit sketch that travels with leftover bucket rows.
FOLD = 8
#: Block keys are exchanged in as many parts, by key; each part's shuffle files go before the next.
PARTS = 4


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser over unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class JoinSpec:
    """Shingle length and threshold ``num / den``; ``ratio`` is the width of a size level.

    Blocks beyond the pigeonhole bound, one and ``slack`` of the others,
    allow as many empty blocks to be left out; a document with more empty
    blocks than that emits them too.  At a threshold of 0.8 a block holds 2.5
    to 4.5 shingles and up to a twelfth of a long document's blocks are empty;
    at 0.9 hardly one is.
    """

    words: int = 5
    num: int = 8
    den: int = 10
    ratio: float = 1.3
    slack: float = 0.125

    def extra(self, least: int) -> int:
        """Blocks in addition to the ``least`` that the pigeonhole needs."""
        return 1 + int(least * self.slack)

    def differ(self, total):
        """Largest symmetric difference of a linked pair with |A| + |B| = total."""
        return (self.den - self.num) * total // (self.den + self.num)

    def starts(self, upto: int) -> list[int]:
        """First sizes of the levels that can hold a set of ``upto`` shingles, ascending."""
        out = [1]
        while out[-1] <= upto:
            out.append(max(out[-1] + 1, int(out[-1] * self.ratio)))
        return out

    def levels(self, n: int) -> list[tuple[int, int, int]]:
        """(level start, blocks, of them extra) of each level a set of n shingles takes part in.

        A set belongs to the level of its size, and also to the next when a
        larger partner may stand there.  Levels in which linked sets are
        equal need no blocks: equal sets are one class already.
        """
        if not n:
            return []
        s = self.starts(n)
        own, after = s[-2], s[-1]
        out = [(own, after)]
        if n * self.den >= after * self.num:
            out.append((after, max(after + 1, int(after * self.ratio))))
        got = []
        for lo, hi in out:
            k = self.differ(2 * (hi - 1))
            if k > 0:
                got.append((lo, k + 1 + self.extra(k + 1), self.extra(k + 1)))
        return got


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text.

    A-Z are lower-cased; words are runs without space and 0x09-0x0D.  A text
    with fewer words than a shingle is one shingle; without words, none.
    """
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    k = min(words, len(w))
    m = len(w) - k + 1
    acc = np.full(m, k, np.uint64)
    for j in range(k):
        acc = mix((acc + _GOLD) ^ h[j:j + m])
    return np.unique(acc)


def block_keys(s: np.ndarray, spec: JoinSpec) -> np.ndarray:
    """One 64-bit join key per block of every level of the set."""
    out = []
    for lo, blocks, extra in spec.levels(len(s)):
        at = (s % np.uint64(blocks)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        filled, first = np.unique(at[order], return_index=True)
        value = np.zeros(blocks, np.uint64)
        value[filled] = np.bitwise_xor.reduceat(mix(s[order] + _GOLD), first)
        name = mix(np.uint64(lo) * _GOLD + np.arange(blocks, dtype=np.uint64))
        use = np.arange(blocks) if blocks - len(filled) > extra else filled
        out.append(mix(name[use] ^ value[use]))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def bit_sketch(s: np.ndarray, words: int = FOLD) -> np.ndarray:
    """Parity of the shingles at each of ``64 * words`` bit places."""
    place = ((s >> np.uint64(17)) % np.uint64(64 * words)).astype(np.int64)
    bits = (np.bincount(place, minlength=64 * words) & 1).astype(np.uint8)
    return np.packbits(bits, bitorder="little").view("<u8")


def _features(spec: JoinSpec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, xa, xb, keys = [], [], [], []
            for text in b.column("text"):
                s = shingles(text.as_py(), spec.words)
                n.append(len(s))
                xa.append(int(np.bitwise_xor.reduce(mix(s ^ _M1))) if len(s) else 0)
                xb.append(int(np.add.reduce(mix(s ^ _M2), dtype=np.uint64)) if len(s) else 0)
                keys.append(block_keys(s, spec).view(np.int64))
            yield pa.record_batch({
                "doc_id": b.column("doc_id"), "n": pa.array(n, pa.int64()),
                "sig_a": np.array(xa, np.uint64).view(np.int64), "sig_b": np.array(xb, np.uint64).view(np.int64),
                "keys": pa.array(keys, pa.list_(pa.int64()))})
    return run


def _sets(spec: JoinSpec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [shingles(t.as_py(), spec.words) for t in b.column("text")]
            sk = np.array([bit_sketch(s) for s in got], np.uint64).reshape(len(got), FOLD).view(np.int64)
            yield pa.record_batch({"id": b.column("doc_id"), "n": pa.array([len(s) for s in got], pa.int64()),
                                   "s": pa.array([s.tobytes() for s in got], pa.binary()),
                                   **{f"w{j}": pa.array(sk[:, j]) for j in range(FOLD)}})
    return run


def _decide(spec: JoinSpec):
    """Pairs whose shingle sets meet the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            for i, (sa, sb) in enumerate(zip(b.column("sa"), b.column("sb"), strict=True)):
                x, y = np.frombuffer(sa.as_buffer(), "<u8"), np.frombuffer(sb.as_buffer(), "<u8")
                inter = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = spec.den * inter >= spec.num * (len(x) + len(y) - inter)
            yield b.select(["a", "b"]).filter(pa.array(keep))
    return run


def _near(spec: JoinSpec):
    """Length filter and Hamming bound of the sketches x0.. and y0.. of sets of na and nb shingles."""
    apart = sum((F.bit_count(F.col(f"x{j}").bitwiseXOR(F.col(f"y{j}"))) for j in range(FOLD)), F.lit(0))
    return ((F.least("na", "nb") * spec.den >= F.greatest("na", "nb") * spec.num)
            & (apart * (spec.den + spec.num) <= (F.col("na") + F.col("nb")) * (spec.den - spec.num)))


def _side(sets: DataFrame, key: str, size: str, word: str) -> DataFrame:
    """Sketches under the names of one side of a pair."""
    return sets.select(F.col("id").alias(key), F.col("n").alias(size), *[F.col(f"w{j}").alias(f"{word}{j}") for j in range(FOLD)])


def _verified(sets: DataFrame, pairs: DataFrame, spec: JoinSpec, name: str) -> DataFrame:
    """The pairs (a, b) of ids that link, decided on whole shingle sets."""
    pairs = cut(pairs, f"{name}-pairs")
    left, right = (sets.select(F.col("id").alias(k), F.col("s").alias(f"s{k}")) for k in "ab")
    return pairs.join(right, "b").join(left, "a").mapInArrow(_decide(spec), "a long, b long").distinct()


def parity_join(docs: DataFrame, spec: JoinSpec = JoinSpec(), id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Similarity classes of documents: one row (doc_id, n_shingles, class_id, component_id) per row.

    ``class_id`` is the smallest id with the same shingle set and
    ``component_id`` the smallest id reachable by links, itself included.
    A null or empty text has no shingles and links with nothing.  Rows that
    share an id are one node of the link graph: their classes are joined.
    A row with a null id is returned with its count and no component.  Only
    the result's table stays in the shared folder.
    """
    return cut_alone(lambda: _classes(docs, spec, id_col, text_col), "parity-classes")


def _held(reps: DataFrame, part: int) -> DataFrame:
    """One part's (key, rep, lo, hi): blocks that several sets share, with the smallest and largest of these."""
    blocks = reps.select(F.explode("keys").alias("key"), F.col("doc_id").alias("rep"))
    # One exchange by key serves the groups and the join; neither holds a group's rows together.
    blocks = blocks.where(F.pmod("key", F.lit(PARTS)) == part).repartition("key")
    many = blocks.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi")
    return cut(blocks.join(many.hint("shuffle_hash"), "key"), "parity-held")


def _classes(docs: DataFrame, spec: JoinSpec, id_col: str, text_col: str) -> DataFrame:
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").alias("text"))
    feats = cut(docs.mapInArrow(_features(spec), "doc_id long, n long, sig_a long, sig_b long, keys array<long>"),
                "parity-features")
    all_keys = feats
    feats = cut(feats.drop("keys"), "parity-sizes")
    some = all_keys.where("n > 0 and doc_id is not null")
    classes = cut(some.groupBy("sig_a", "sig_b", "n").agg(F.min("doc_id").alias("rep")), "parity-classes")
    # The few ids that are repeated may stand for several texts: each text is looked at.
    reps = some.join(classes.select("sig_a", "sig_b", "n", F.col("rep").alias("doc_id")),
                     ["sig_a", "sig_b", "n", "doc_id"], "left_semi")
    reps = cut(reps.select("doc_id", "keys"), "parity-reps")
    drop(all_keys)
    parts = [_held(reps, i) for i in range(PARTS)]
    drop(reps)
    held = reduce(DataFrame.union, parts)
    # Whole sets of the documents that share a block with another, for every later check.
    sets = cut(docs.join(held.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
               .mapInArrow(_sets(spec), "id long, n long, s binary, " + ", ".join(f"w{j} long" for j in range(FOLD))),
               "parity-sets")
    stars = (held.select(F.col("lo").alias("a"), F.col("rep").alias("b"))
             .union(held.select(F.col("rep").alias("a"), F.col("hi").alias("b"))).where("a < b").distinct())
    stars = stars.join(_side(sets, "b", "nb", "y"), "b").join(_side(sets, "a", "na", "x"), "a").where(_near(spec))
    links = cut(_verified(sets, stars.select("a", "b").distinct(), spec, "parity-star"), "parity-links")
    label = components(links, "parity-stars")
    open_rows = (held.select("key", "rep").distinct()
                 .join(label.withColumnRenamed("node", "rep"), "rep", "left")
                 .select("key", "rep", F.coalesce("component", "rep").alias("c")))
    open_rows = cut(open_rows, "parity-labelled")
    drop(*parts)
    unsettled = cut(open_rows.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y"))
                    .where("x < y").select("key"), "parity-unsettled")
    rest = cut(open_rows.join(unsettled, "key"), "parity-rest")
    drop(open_rows)
    left = rest.select("key", F.col("rep").alias("a"), F.col("c").alias("ca"))
    right = rest.select("key", F.col("rep").alias("b"), F.col("c").alias("cb"))
    more = _residual(sets, left, right, spec)
    links = links.union(more)
    same = feats.where("n > 0 and doc_id is not null").join(classes, ["sig_a", "sig_b", "n"])
    same = cut(same.select("doc_id", "n", "rep"), "parity-members")
    edges = links.union(same.where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
    found = components(edges, "parity-all").withColumnRenamed("node", "doc_id")
    none = feats.where("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("rep"))
    return (same.union(none).join(found, "doc_id", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.col("rep").alias("class_id"),
                    F.coalesce("component", "doc_id").alias("component_id")))


def _residual(sets: DataFrame, left: DataFrame, right: DataFrame, spec: JoinSpec) -> DataFrame:
    """Links among bucket members that the stars left in different components.

    Each row carries its set's size and folded sketch, and the join itself
    keeps only pairs within the Hamming bound.
    """
    x = cut(left.join(_side(sets, "a", "na", "x"), "a"), "parity-left")
    y = cut(right.join(_side(sets, "b", "nb", "y"), "b"), "parity-right")
    near = (x["key"] == y["key"]) & (x["a"] < y["b"]) & (x["ca"] != y["cb"]) & _near(spec)
    return _verified(sets, x.join(y, near).select("a", "b").distinct(), spec, "parity-rest")
