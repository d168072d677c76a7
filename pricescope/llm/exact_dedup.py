"""Exact dedup by a tree merge of sorted digest runs (operator 11), DataFrame functions only.

Every input partition is a run.  Its rows are reduced to one entry a text:
the SHA-256 of the normalised text, a witness (length in bytes and a 64-bit
hash of another family), the number of rows and the row that stays.  Runs are
then exchanged in binomial rounds: in round ``k`` the next ``BITS`` bits of a
run's number are replaced by as many bits of the digest, so ``2 ** BITS``
partners swap parts of their sorted runs, and each merges what it gets.
Entries of one text meet at most ``2 ** BITS`` at a time, whatever the size of
its group, and after the last round the slot is a function of the digest.

An entry is merged only if digest and witness agree (a digest that two texts
share leaves two entries), and every level keeps the row that stays.  The
verdicts go back down the same tree: a level's entries look their parent up,
only those of texts that occur more than once, and the rows look up the entry
of their own run.  No join meets a key that holds more than a run's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricescope.llm.common import cut

#: Bits of the run number that one round replaces: 16 sorted runs are merged at a time.
BITS = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY = ["slot", "digest", "size", "witness"]


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z, and nothing else, in lower case."""
    # Text of one byte a character has only A-Z to lower, which is much cheaper.
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def _leaves(docs: DataFrame, id_col: str, text_col: str, fold: bool, carry: list[str]) -> DataFrame:
    """A row per document: its run, digest, witness and place, and the carried columns in a struct."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    held = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]) if carry else F.lit(None)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), (ascii_lower(text) if fold else text).alias("t"), held.alias("held"))
    return rows.select(F.spark_partition_id().alias("slot"), F.unhex(F.sha2("t", 256)).alias("digest"),
                       F.octet_length("t").alias("size"), F.xxhash64("t").alias("witness"),
                       "id", F.monotonically_increasing_id().alias("row"), "held")


def _merge(entries: DataFrame, runs: int, keep: str) -> DataFrame:
    """One entry a slot and text of sorted runs: the sort that deals them out is the one the aggregate merges by."""
    pick = (F.max if keep == "largest" else F.min)("best")
    dealt = entries.repartition(runs, "slot").sortWithinPartitions(*_KEY)
    return dealt.groupBy(*_KEY).agg(F.sum("n").alias("n"), pick.alias("best"))


def _parent(at: int, bits: int) -> Column:
    """Slot of an entry's parent: ``bits`` bits of its slot from bit ``at`` on give way to those of the digest."""
    mask = (2**bits - 1) << at
    digest = F.xxhash64("digest").bitwiseAND(F.lit(mask)).cast("int")
    return F.col("slot").bitwiseAND(F.lit(~mask)).bitwiseOR(digest)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                 fold: bool = True, carry: list[str] | None = None) -> DataFrame:
    """A row per row of ``docs``: id, keep_id, group_size, kept, text_sha256, then the ``carry`` columns.

    Texts are equal if identical (after lower-casing A-Z only with ``fold``);
    a null text is an empty one.  ``keep`` says which row of a group stays,
    that of the ``smallest`` or ``largest`` id.  A row without an id stays
    only where no row of the group has one (keep_id is null then); of rows
    that repeat an id exactly one stays.  An empty table gives an empty
    result.  ``carry`` names columns to hand through as ``c0``, ``c1``, ...;
    other columns of ``docs`` are not read, so no name can clash.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    leaves = cut(_leaves(docs, id_col, text_col, fold, list(carry or [])), "exact-leaves")
    runs = int(leaves.agg(F.max("slot")).first()[0] or 0) + 1
    bits = (runs - 1).bit_length()
    none = F.col("id").isNotNull() if keep == "largest" else F.col("id").isNull()
    best = F.struct(none.alias("z"), "id", F.col("row"))
    levels = [cut(_merge(leaves.select(*_KEY, F.lit(1).cast("long").alias("n"), best.alias("best")), runs, keep), "exact-level-0")]
    parents = [_parent(at, min(BITS, bits - at)) for at in range(0, bits, BITS)]
    for k, slot in enumerate(parents):
        up = levels[k].select(slot.alias("slot"), *_KEY[1:], "n", "best")
        levels.append(cut(_merge(up, 2**bits, keep), f"exact-level-{k + 1}"))
    found = levels[-1].where("n > 1").select(*_KEY, "n", "best")
    for k, slot in reversed(list(enumerate(parents))):
        child = levels[k].select(slot.alias("slot"), *_KEY[1:], F.col("slot").alias("own"))
        found = cut(child.join(found, _KEY).select(F.col("own").alias("slot"), *_KEY[1:], "n", "best"), f"exact-down-{k}")
    out = leaves.join(found, _KEY, "left")
    alone = F.col("best").isNull()
    held = [F.col(f"held.c{i}").alias(f"c{i}") for i in range(len(carry or []))]
    return out.select(F.col("id").alias(id_col), F.when(alone, F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
                      F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
                      (alone | (F.col("best.row") == F.col("row"))).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"), *held)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                fold: bool = True) -> DataFrame:
    """The rows of ``docs`` that stay, all columns under their own names, by the rules of ``exact_groups``."""
    got = exact_groups(docs, id_col, text_col, keep, fold, docs.columns).where("kept")
    return got.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def oracle(keep: str = "largest") -> str:
    """The same groups in DuckDB, texts compared as such."""
    best = "max" if keep == "largest" else "min"
    return f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
  g AS (SELECT t, {best}(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM t JOIN g USING (t)"""
