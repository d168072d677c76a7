"""Language identification by Bayesian evidence fusion (operator 3).

Evidence about a row's language is combined as independent factors: the
likelihood of its text under letter-trigram models, its declared markup
language, its address suffix, and a prior of its host.  Host priors are
counted over the corpus by grouped aggregation of what the row's own evidence
says, and smoothed hierarchically: a host towards its domain, a domain
towards the corpus.  A row's own evidence is left out of its prior.

Every label has a trigram model, fitted on a bounded sample of its labelled
rows: the first ``Settings.sample_chars`` characters of at most
``Settings.rows_per_language`` distinct texts, those of the smallest hashes.
Everything else covers all rows and whole texts; a row's evidence is one
number a label, so time and memory grow with the number of labels.  ``und`` is a language of its own with
uniform trigrams: texts without letters, or in no language known, end there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricescope.llm.common import cut, unused

UND = "und"
_SPACE = np.uint32(32)


@dataclass(frozen=True)
class Settings:
    """``rows_per_language`` and ``sample_chars`` bound the sample that the text models are fitted on.

    ``grams`` effective trigrams at most speak for a text, as neighbours are
    not independent; ``declared`` and ``address`` are the chances that a
    declaration or an address suffix names the right language; ``pull`` is
    the weight, in rows, of the level above in a host's prior.
    """

    rows_per_language: int = 400
    sample_chars: int = 4000
    slots: int = 1 << 15
    smooth: float = 0.5
    grams: int = 60
    declared: float = 0.9
    address: float = 0.8
    pull: float = 10.0
    least: float = 0.5


def letters(text: str | None) -> np.ndarray:
    """Lower-cased code points with every run of other characters as one space, one space around."""
    t = (text or "").lower()
    c = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = (c >= 97) & (c <= 122)
    high = np.flatnonzero(c >= 128)
    if len(high):
        seen, at = np.unique(c[high], return_inverse=True)
        letter[high] = np.array([chr(x).isalpha() for x in seen.tolist()])[at]
    c = np.where(letter, c, _SPACE)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    c = c[keep]
    if not len(c):
        return c
    return np.concatenate(([_SPACE], c, [_SPACE] if c[-1] != _SPACE else np.empty(0, np.uint32))).astype(np.uint32)


def grams(text: str | None, slots: int) -> np.ndarray:
    """Hash slot of every letter trigram of the whole text."""
    c = letters(text)
    if len(c) < 3:
        return np.empty(0, np.int64)
    h = c[:-2] * np.uint32(0x9E3779B1) ^ c[1:-1] * np.uint32(0x85EBCA77) ^ c[2:] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    return (h * np.uint32(0x2C1B3C6D) >> np.uint32(32 - (slots.bit_length() - 1))).astype(np.int64)


@dataclass(frozen=True)
class TextModels:
    """Log-probability of each slot under each language; ``languages`` end with ``und``."""

    languages: list[str]
    logp: np.ndarray

    def evidence(self, text: str | None, settings: Settings) -> np.ndarray:
        """Log-likelihood of the text by language, tempered to at most ``settings.grams`` trigrams."""
        g = grams(text, settings.slots)
        if not len(g):
            out = np.full(len(self.languages), -1.0)
            out[-1] = 0.0
            return out * settings.grams
        total = np.array([row[g].sum() for row in self.logp])
        return (total - total.max()) * min(1.0, settings.grams / len(g))


def sample(labelled: DataFrame, text_col: str, lang_col: str, settings: Settings) -> DataFrame:
    """(lang, text): of every label the ``rows_per_language`` distinct texts of the smallest hashes, cut to ``sample_chars``.

    A group of copies is one text, and the same rows give the same sample.
    """
    rows = labelled.select(F.col(f"`{text_col}`").alias("text"), F.lower(F.trim(F.col(f"`{lang_col}`"))).alias("lang"))
    rows = rows.where(f"text is not null and lang is not null and lang not in ('', '{UND}')").withColumn("h", F.xxhash64("text"))
    counts = cut(rows.groupBy("lang", "h").agg(F.lit(1).alias("one")).groupBy("lang").agg(F.count("*").alias("n")), "language-labels")
    # Twice the rows wanted are expected to pass, so that the order below sees few rows of any label.
    share = F.least(F.lit(1.0), 2.0 * settings.rows_per_language / F.col("n"))
    picked = rows.join(F.broadcast(counts), "lang").where(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30))
    texts = picked.groupBy("lang", "h").agg(F.min(F.substring("text", 1, settings.sample_chars)).alias("text"))
    order = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 30)), "h")
    return texts.withColumn("r", F.row_number().over(order)).where(F.col("r") <= settings.rows_per_language).select("lang", "text")


def _slots(slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: dict[str, np.ndarray] = {}
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                n = np.bincount(grams(text, slots), minlength=slots)
                found[lang] = found[lang] + n if lang in found else n
            for lang, n in found.items():
                at = np.flatnonzero(n)
                yield pa.record_batch({"lang": pa.array([lang] * len(at), pa.string()), "slot": pa.array(at, pa.int32()),
                                       "n": pa.array(n[at], pa.int64())})
    return run


def fit(labelled: DataFrame, text_col: str, lang_col: str, settings: Settings) -> TextModels:
    """Trigram models of all labels, each from its ``sample``; trigrams are counted in Spark, the driver holds ``slots`` numbers a label."""
    texts = cut(sample(labelled, text_col, lang_col, settings), "language-sample")
    langs = sorted(r["lang"] for r in texts.select("lang").distinct().collect())
    if not langs:
        return TextModels([UND], np.full((1, settings.slots), -np.log(settings.slots), np.float32))
    at = {lang: i for i, lang in enumerate(langs)}
    logp = np.full((len(langs) + 1, settings.slots), settings.smooth, np.float32)
    counts = texts.mapInArrow(_slots(settings.slots), "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    for b in counts.toArrow().to_batches():
        logp[[at[x] for x in b.column("lang").to_pylist()], b.column("slot").to_numpy()] += b.column("n").to_numpy()
    logp[-1] = 1.0
    for row in logp:
        row[:] = np.log(row / row.sum(dtype=np.float64))
    return TextModels([*langs, UND], logp)


def _scores(models: TextModels, settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ll = [models.evidence(t.as_py(), settings) for t in b.column("text")]
            names = [n for n in b.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(ll, pa.list_(pa.float64()))], [*names, "ll"])
    return run


def _says(code: Column, langs: list[str], right: float) -> Column:
    """Log-factors of a declaration by language; none if it is absent or names no known language."""
    known = langs[:-1]
    wrong = (1 - right) / max(1, len(known))
    factors = F.array(*[F.when(code == lang, float(np.log(right))).otherwise(float(np.log(wrong))) for lang in langs])
    return F.when(code.isin(known), factors).otherwise(F.array(*[F.lit(0.0)] * len(langs)))


def _let(x: Column, f) -> Column:
    """f of x, with x evaluated once and not again for each element that f goes through."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def _softmax(x: Column) -> Column:
    total = lambda e: F.aggregate(e, F.lit(0.0), lambda a, y: a + y)
    powers = _let(x, lambda y: _let(F.array_max(y), lambda m: F.transform(y, lambda v: F.exp(v - m))))
    return _let(powers, lambda e: _let(total(e), lambda t: F.transform(e, lambda v: v / t)))


def _plus(*xs: Column) -> Column:
    out = xs[0]
    for x in xs[1:]:
        out = F.zip_with(out, x, lambda a, b: a + b)
    return out


def _sums(rows: DataFrame, key: str, k: int) -> DataFrame:
    """Summed own evidence by language and key: a partial sum per task, then one per key."""
    return rows.groupBy(key).agg(F.array(*[F.sum(F.col("own")[i]) for i in range(k)]).alias(f"n_{key}"))


def identify(rows: DataFrame, models: TextModels, settings: Settings = Settings()) -> DataFrame:
    """Rows (id, text, declared, address, host, domain) -> id, lang, confidence, text_lang, prior_lang.

    ``lang`` is the language of the greatest posterior, of equal ones the
    first in order; ``confidence`` is that posterior.  Null evidence is no
    evidence; a null host is a host of its own.  Repeated rows are kept.
    """
    langs, k = models.languages, len(models.languages)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    rows = rows.mapInArrow(_scores(models, settings), f"{schema}, ll array<double>")
    code = lambda c: F.lower(F.regexp_extract(F.coalesce(F.trim(F.col(c)), F.lit("")), r"^([A-Za-z]+)", 1))
    rows = rows.withColumns({"host": F.coalesce("host", F.lit("")), "domain": F.coalesce("domain", F.lit("")),
                             "said": _plus(_says(code("declared"), langs, settings.declared), _says(code("address"), langs, settings.address))})
    rows = rows.withColumn("mine", _plus(F.col("ll"), F.col("said")))
    rows = cut(rows.withColumn("own", _softmax(F.col("mine"))).select("id", "host", "domain", "ll", "mine", "own"), "language-evidence")
    hosts = cut(_sums(rows, "host", k).join(rows.groupBy("host").agg(F.min("domain").alias("domain")), "host"), "language-hosts")
    domains = cut(rows.groupBy("domain").agg(F.array(*[F.sum(F.col("own")[i]) for i in range(k)]).alias("n_domain")), "language-domains")
    whole = rows.agg(*[F.sum(F.col("own")[i]).alias(f"l{i}") for i in range(k)]).first()
    whole = np.array([x or 0.0 for x in whole]) + 1.0
    base = F.array(*[F.lit(float(x)) for x in whole / whole.sum()])
    pull = settings.pull
    # The domain's counts less the host's, then pulled towards the corpus; the host's are pulled towards that.
    def pulled(counts: Column, above: Column) -> Column:
        total = _let(counts, lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x))
        return _let(F.greatest(total, F.lit(0.0)) + pull,
                    lambda t: F.zip_with(counts, above, lambda n, p: (F.greatest(n, F.lit(0.0)) + pull * p) / t))
    priors = cut(hosts.join(domains, "domain").withColumn("d", pulled(F.zip_with("n_domain", "n_host", lambda a, b: a - b), base))
                 .select("host", "n_host", "d"), "language-priors")
    out = rows.join(priors, "host").withColumn("prior", pulled(F.zip_with("n_host", "own", lambda a, b: a - b), F.col("d")))
    out = out.withColumn("post", _softmax(_plus(F.col("mine"), F.transform("prior", lambda p: F.ln(p)))))
    name = lambda c: F.get(F.array(*[F.lit(x) for x in langs]), (F.array_position(c, F.array_max(c)) - 1).cast("int"))
    return out.select("id", name("post").alias("lang"), F.array_max("post").alias("confidence"),
                      name("ll").alias("text_lang"), name("prior").alias("prior_lang"))


def _documents(docs: DataFrame, key: Column, settings: Settings, text_col: str, declared_col: str, host_col: str) -> DataFrame:
    """Languages and verdicts of documents under a key of the caller's."""
    models = fit(docs, text_col, declared_col, settings)
    host = F.col(f"`{host_col}`").cast("string")
    rows = docs.select(key.alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{declared_col}`").alias("declared"),
                       F.lit(None).cast("string").alias("address"), host.alias("host"), F.substring_index(host, ".", -2).alias("domain"))
    out = identify(rows, models, settings)
    return out.withColumn("kept", (F.col("lang") != UND) & (F.col("confidence") >= settings.least))


def document_languages(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
                       declared_col: str = "lang", host_col: str = "source") -> DataFrame:
    """doc_id, lang, confidence, text_lang, prior_lang and kept of every document.

    The declared language is the table's, the host its source; documents have
    no address.  A document is rejected (``kept`` false) when the posterior
    favours no known language or stays below ``settings.least``.
    """
    out = _documents(docs, F.col(f"`{id_col}`"), settings, text_col, declared_col, host_col)
    return out.withColumnRenamed("id", "doc_id")


def keep_known(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
               declared_col: str = "lang", host_col: str = "source") -> DataFrame:
    """The rows of ``docs`` in a known language, all columns as they are, whatever their names; rows of one id and text
    stay or go together.  A null or empty text is judged by declaration and host alone; an empty table stays empty."""
    key = F.struct(F.col(f"`{id_col}`").alias("d"), F.xxhash64(F.col(f"`{text_col}`")).alias("h"))
    d, h = unused("lost_id", docs), unused("lost_hash", docs)
    out = _documents(docs, key, settings, text_col, declared_col, host_col)
    lost = cut(out.where("not kept").select(F.col("id.d").alias(d), F.col("id.h").alias(h)).distinct(), "language-rejects")
    return docs.join(lost, F.col(f"`{id_col}`").eqNullSafe(F.col(d)) & (F.xxhash64(F.col(f"`{text_col}`")) == F.col(h)), "left_anti")


def _visible(html: Column) -> Column:
    """Text of a page without scripts, styles, comments, tags and character references."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    return F.regexp_replace(bare, r"&[#A-Za-z0-9]+;", " ")


def page_languages(pages: DataFrame, labelled: DataFrame, settings: Settings = Settings(), id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, lang, confidence, text_lang, prior_lang of every page.

    Declared is the markup's ``lang`` attribute, the address suffix the first
    path step if it is a code of two letters, else the top-level domain; the
    domain is the host's last two labels.  Models are fitted on ``labelled``
    (text, lang).
    """
    models = fit(labelled, "text", "lang", settings)
    url, page = F.coalesce(F.col(f"`{url_col}`"), F.lit("")), F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    step = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*/([A-Za-z]{2})(?:[/?#]|$)", 1)
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), _visible(page).alias("text"),
                        F.regexp_extract(page, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z-]+)""", 1).alias("declared"),
                        F.when(step != "", step).otherwise(F.substring_index(host, ".", -1)).alias("address"),
                        host.alias("host"), F.substring_index(host, ".", -2).alias("domain"))
    return identify(rows, models, settings).withColumnRenamed("id", "page_id")
