"""Spelling variant grouping by finite-state composition (operator 13).

The vocabulary's words are accepted by a minimised acyclic automaton ``A``.
Composing it with the one-edit transducer ``T`` (copy, then one replacement or
insertion, then copy) and with ``A`` again gives a machine that accepts just
the pairs of words one edit apart.  Its states are (state of A, edit done?,
state of A), and as long as no edit is done both sides are in the same state.
So the machine is cut at that state: two words of lengths ``m`` and ``m`` or
``m + 1`` that share their first ``m // 2`` characters are in one partition of
the forward machine, and all others, whose edit lies in that part, share their
last ``m - m // 2`` and are in one partition of the backward machine (the same
over the reversed words).  Spark deals four rows a word to these partitions,
and every pair is accepted in one of them only.

Inside a partition the words left after the shared part are minimised by hash
consing from their sorted order.  Pairs of states are joined once: what two
states both accept is remembered for the pair, which minimisation makes few.

A partition of more than ``most`` words is cut further, not enumerated in one
task: its words are dealt by the place of the edit and what stands before and
after it, where at most one word a character of the alphabet meets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricescope.llm.common import cut
from pricescope.llm.exact_dedup import ascii_lower

_PART = ["back", "m", "part"]
_FOUND = "word string, n_near long, n long, form string"


@dataclass(frozen=True)
class Variants:
    """Rules of the vocabulary and of forms."""

    #: Characters that words are maximal runs of, as a character class.
    letters: str = r"[A-Za-zÀ-ÿ]+"
    #: Code points and occurrences a word must have.
    length: int = 5
    count: int = 3
    #: A form occurs at least this many times as often as its word.
    times: int = 2
    #: One in this many (document, word) pairs is misspelt by one deletion, by crc32; 0: none.
    typos: int = 0
    #: Words of a partition that one task enumerates.
    most: int = 100_000


# ------------------------------------------------------------ the vocabulary
def vocabulary(docs: DataFrame, rule: Variants, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words of all texts that are long and frequent enough."""
    runs = F.explode(F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(rule.letters), F.lit(0)))
    words = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), runs.alias("run"))
    words = words.select("id", ascii_lower(F.col("run")).alias("w"))
    if rule.typos:
        h = F.crc32(F.concat_ws(":", "id", "w"))
        at = (h % F.length("w")).cast("int")
        cut_out = F.concat(F.expr("substring(w, 1, at)"), F.expr("substring(w, at + 2)"))
        words = (words.withColumn("h", h).withColumn("at", at)
                 .select(F.when(F.col("h") % rule.typos == 0, cut_out).otherwise(F.col("w")).alias("w")))
    words = words.where(F.length("w") >= rule.length)
    return words.groupBy(F.col("w").alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= rule.count)


def _partitions(words: DataFrame, shortest: int) -> DataFrame:
    """Four rows a word (two for the shortest): the partitions where its pairs as shorter and as longer word are."""
    size = F.length("word")

    def part(m: Column, back: bool) -> Column:
        k = F.floor(m / 2).cast("int")
        key = F.substring(F.reverse("word"), F.lit(1), (m - k).cast("int")) if back else F.substring("word", F.lit(1), k)
        return F.struct(F.lit(back).alias("back"), m.cast("int").alias("m"), key.alias("part"))

    parts = F.array(*[part(m, back) for m in (size, size - 1) for back in (False, True)])
    rows = words.select("word", "n", F.explode(parts).alias("p")).where(F.col("p.m") >= shortest)
    return rows.select("p.*", "word", "n")


# ---------------------------------------------------------- one partition
class Acceptor:
    """Minimised acyclic automata over words of one length each, sharing their states."""

    def __init__(self):
        self.ids: dict[tuple, int] = {(): 0}
        self.arcs: list[tuple] = [()]
        self._both: dict[tuple[int, int], tuple] = {(0, 0): (None,)}

    def _state(self, arcs: list[tuple]) -> int:
        key = tuple(arcs)
        if key not in self.ids:
            self.ids[key] = len(self.arcs)
            self.arcs.append(key)
        return self.ids[key]

    def add(self, words: list[str]) -> int:
        """The start state for sorted distinct ``words`` of one length: suffixes are frozen as the next word leaves them."""
        size, last = len(words[0]), words[0]
        open_: list[list[tuple]] = [[] for _ in range(size + 1)]
        for w in [*words[1:], None]:
            same = 0
            while w is not None and last[same] == w[same]:
                same += 1
            for i in range(size, same, -1):
                open_[i - 1].append((last[i - 1], self._state(open_[i])))
                open_[i] = []
            last = w
        return self._state(open_[0])

    def both(self, q: int, r: int) -> tuple:
        """All strings that lead from both states to the end (the composition after its edit), as linked characters."""
        key = (q, r) if q <= r else (r, q)
        todo = [key]
        while todo:
            top = todo[-1]
            if top in self._both:
                todo.pop()
                continue
            right = dict(self.arcs[top[1]])
            steps = [(c, (s, right[c]) if s <= right[c] else (right[c], s)) for c, s in self.arcs[top[0]] if c in right]
            wait = [p for _, p in steps if p not in self._both]
            if wait:
                todo += wait
            else:
                self._both[top] = tuple((c, y) for c, p in steps for y in self._both[p])
                todo.pop()
        return self._both[key]


def _read(link: tuple | None) -> list[str]:
    """The characters of a linked string, in the order of the links."""
    got = []
    while link:
        got.append(link[0])
        link = link[1]
    return got


def near_pairs(short: list[str], long: list[str]) -> Iterator[tuple[str, str]]:
    """Pairs of ``short`` words that differ by a replacement, and of a short and a ``long`` word (one character
    more) that differ by an insertion.  Both lists are sorted, distinct and of one length each; each pair comes once.
    Strings are linked characters until a pair is found, so the work is linear in the length of words."""
    if not short or len(short) + len(long) < 2:
        return
    a = Acceptor()
    todo = [(None, a.add(short), a.add(long) if long else None)]
    while todo:
        x, s, t = todo.pop()
        arcs, more = a.arcs[s], dict(a.arcs[t]) if t is not None else {}
        ends = [(c, d, y) for i, (c, q) in enumerate(arcs) for d, r in arcs[i + 1:] for y in a.both(q, r)]
        # In a run of one character the last place of an insertion counts.
        ends += [("", c, y) for c, q in more.items() for y in a.both(s, q) if not (y and y[0] == c)]
        if ends:
            before = "".join(reversed(_read(x)))
            for c, d, y in ends:
                after = "".join(_read(y))
                yield before + c + after, before + d + after
        todo += [((c, x), q, more.get(c)) for c, q in arcs]


def _partition(key: tuple, words: list[str], ns: list[int]) -> Iterator[tuple]:
    """(word, n_near, n of the best near word, that word) of one partition."""
    back, m, part = key
    if len(words) < 2:
        return
    k, count, best = m // 2, {}, {}
    turn = (lambda w: w[::-1]) if back else (lambda w: w)
    freq = dict(zip(words, ns, strict=True))
    tails = {turn(w)[len(part):] for w in freq}
    size = m - len(part)
    short, long = (sorted(t for t in tails if len(t) == n) for n in (size, size + 1))
    for pair in near_pairs(short, long):
        u, v = (turn(part + t) for t in pair)
        if back and u[:k] == v[:k]:
            continue  # accepted by the forward machine
        for w, other in ((u, v), (v, u)):
            count[w] = count.get(w, 0) + 1
            if w not in best or (-freq[other], other) < best[w]:
                best[w] = (-freq[other], other)
    for w, c in count.items():
        yield w, c, -best[w][0], best[w][1]


def _enumerate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partitions one after the other: their rows come sorted by partition."""
    names = ["word", "n_near", "n", "form"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    out: list[tuple] = []

    def flush():
        rows = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
        out.clear()
        return pa.RecordBatch.from_arrays(rows, names)

    key, words, ns = None, [], []
    for b in batches:
        for *k, w, n in zip(*[b.column(c).to_pylist() for c in (*_PART, "word", "n")], strict=True):
            if k != key:
                if len(words) > 1:
                    out += _partition(tuple(key), words, ns)
                if len(out) >= 10_000:
                    yield flush()
                key, words, ns = k, [], []
            words.append(w)
            ns.append(n)
    if len(words) > 1:
        out += _partition(tuple(key), words, ns)
    if out:
        yield flush()


# ------------------------------------------------------------- large partitions
def _by_place(rows: DataFrame) -> DataFrame:
    """Near words of large partitions: dealt by the place of the edit and the characters before and after it.

    A word as the shorter one stands at every place between two characters
    (``gap``), as the longer one it gives up its character there; words of
    one length meet where both give up a character.
    """
    size, at = F.length("word"), F.col("i")
    word = F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word"))
    rows = rows.select(*_PART, "word", "n", word.alias("x"), (size > F.col("m")).alias("long"))
    last = F.length("x") - F.when(F.col("long"), 1).otherwise(0)
    dealt = rows.select("*", F.explode(F.sequence(F.length("part"), last)).alias("i"))
    without = F.concat(F.expr("substring(x, 1, i)"), F.lit("\n"), F.expr("substring(x, i + 2)"))
    gap = F.concat(F.expr("substring(x, 1, i)"), F.lit("\n"), F.expr("substring(x, i + 1)"))
    char = F.expr("substring(x, i + 1, 1)")
    here = [*_PART, "i"]
    dealt = dealt.withColumns({"without": without, "gap": gap, "char": char})
    short, long = dealt.where(~F.col("long")), dealt.where("long")
    lead = lambda d, side, k: d.select(*here, F.col(k).alias("meet"), F.col("word").alias(f"w{side}"),
                                       F.col("n").alias(f"n{side}"), F.col("char").alias(f"c{side}"))
    inner = short.where(at < F.length("x"))
    swap = lead(inner, 1, "without").join(lead(inner, 2, "without"), [*here, "meet"]).where("w1 < w2")
    put = lead(short, 1, "gap").join(lead(long, 2, "without"), [*here, "meet"]).where("coalesce(c1, '') <> c2")
    pairs = swap.unionByName(put)
    k = F.floor(F.col("m") / 2).cast("int")
    pairs = pairs.where(~F.col("back") | (F.substring("w1", F.lit(1), k) != F.substring("w2", F.lit(1), k)))
    return pairs.select(F.explode(F.array(F.struct(F.col("w1").alias("word"), F.col("w2").alias("form"), F.col("n2").alias("n")),
                                          F.struct(F.col("w2").alias("word"), F.col("w1").alias("form"), F.col("n1").alias("n")))).alias("p")
                        ).select("p.word", F.lit(1).cast("long").alias("n_near"), "p.n", "p.form")


def near_words(words: DataFrame, rule: Variants) -> DataFrame:
    """(word, n_near, form, form_n): near words counted, and the most frequent of them, of words that have any.
    ``words(word, n)`` holds every word once."""
    rows = _partitions(words, rule.length)
    large = cut(rows.groupBy(*_PART).agg(F.count("*").alias("c")).where(F.col("c") > rule.most).drop("c"), "spelling-large")
    some = not large.isEmpty()
    few = rows.join(large, _PART, "left_anti") if some else rows
    found = few.repartition(*_PART).sortWithinPartitions(*_PART).select(*_PART, "word", "n").mapInArrow(_enumerate, _FOUND)
    if some:
        found = found.unionByName(_by_place(rows.join(large, _PART, "left_semi")))
    # The largest n first, then the smallest word: strings compare by bytes of UTF-8, which is code-point order.
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("n")).alias("n"), "form")).alias("best")
                                     ).select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.n")).alias("form_n"))


def variants(docs: DataFrame, rule: Variants = Variants(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every word of the vocabulary with its form: (word, form, root, n, n_near, form_n).

    A word's form is its most frequent near word (one inserted, deleted or
    replaced code point; ties: the smallest), if that is ``rule.times`` as
    frequent; ``root`` is the end of the chain of forms.  A null text has no
    words and an empty table no rows; repeated rows count each; a null id is
    an empty one.  Texts and words may be of any length; other columns are
    not read.
    """
    words = cut(vocabulary(docs, rule, id_col, text_col), "spelling-words")
    near = near_words(words, rule)
    out = words.join(near, "word", "left")
    sure = F.col("form_n") >= rule.times * F.col("n")
    out = cut(out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         F.when(sure, F.col("form")).alias("form"), F.when(sure, F.col("form_n")).alias("form_n")), "spelling-forms")
    # Pointers double: n at least doubles along a chain, so there are few rounds.
    jump = out.where("form is not null").select("word", F.col("form").alias("to"))
    while True:
        ahead = jump.select(F.col("word").alias("to"), F.col("to").alias("next"))
        far = cut(jump.join(ahead, "to", "left").select("word", F.coalesce("next", "to").alias("to"),
                                                        F.col("next").isNotNull().alias("moved")), "spelling-roots")
        jump = far.select("word", "to")
        if far.where("moved").isEmpty():
            break
    return (out.join(jump, "word", "left")
            .select("word", "form", F.coalesce("to", "word").alias("root"), "n", "n_near", "form_n"))


def oracle(rule: Variants) -> str:
    """The same words in DuckDB: crc32 bit by bit over UTF-8, near words by equal strings around the edit, roots by recursion."""
    return rf"""
WITH RECURSIVE k AS (SELECT list(v ORDER BY i) AS crc FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
      lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) t(i))),
  r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{rule.letters}')) AS w FROM documents),
  c AS (SELECT id, w, count(*) AS c FROM r GROUP BY id, w),
  b AS (SELECT w, c, flatten(list_transform(string_split(concat(id, ':', w), ''), lambda x: CASE WHEN unicode(x) < 128
      THEN [unicode(x)] ELSE [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)] END)) AS bytes FROM c),
  h AS (SELECT w, c, xor(list_reduce(list_prepend(4294967295, list_transform(bytes, lambda x: CAST(x AS BIGINT))),
      lambda a, x: xor(a >> 8, crc[1 + (xor(a, x) & 255)])), 4294967295) AS h FROM b, k),
  v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (SELECT c, CASE WHEN {rule.typos or 1} > 1 AND h % {rule.typos or 1} = 0
      THEN concat(substr(w, 1, h % length(w)), substr(w, h % length(w) + 2)) ELSE w END AS word FROM h)
    WHERE length(word) >= {rule.length} GROUP BY word HAVING sum(c) >= {rule.count}),
  d AS (SELECT word, n, i, substr(word, 1, i) AS x, substr(word, i + 2) AS y
    FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
  e AS (SELECT a.word AS a, b.word AS b, b.n FROM d a JOIN d b USING (i, x, y) WHERE a.word <> b.word
    UNION SELECT v.word, d.word, d.n FROM v JOIN d ON v.word = concat(d.x, d.y)
    UNION SELECT d.word, v.word, v.n FROM v JOIN d ON v.word = concat(d.x, d.y)),
  g AS (SELECT a AS word, count(*) AS n_near, min((-n, b)) AS best FROM e GROUP BY a),
  f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= {rule.times} * v.n THEN best[2] END AS form,
      CASE WHEN -best[1] >= {rule.times} * v.n THEN -best[1] END AS form_n FROM v LEFT JOIN g USING (word)),
  p AS (SELECT word, word AS root, 0 AS depth FROM f
    UNION ALL SELECT p.word, f.form, depth + 1 FROM p JOIN f ON f.word = p.root WHERE f.form IS NOT NULL)
SELECT f.word, form, arg_max(root, depth) AS root, n, n_near, form_n FROM f JOIN p USING (word) GROUP BY ALL"""
