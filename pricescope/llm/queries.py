"""Registered queries of the subpackage: name -> callable(spark, sf_dir), and their oracle SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricescope.llm import decontaminate as dc
from pricescope.llm import exact_dedup as ed
from pricescope.llm import filter_audit as fa
from pricescope.llm import html_main, pieces, secrets
from pricescope.llm import language_id as li
from pricescope.llm import line_dedup as ld
from pricescope.llm import parity_join as pj
from pricescope.llm import spelling as sp
from pricescope.llm import token_counts as tc
from pricescope.llm import token_files as tf
from pricescope.llm import vector_dedup as vd
from pricescope.llm.common import scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents by 3-word shingle Jaccard of at least 0.9, per document."""
    spec = pj.JoinSpec(words=3, num=90, den=100, slack=0.0)
    return pj.parity_join(table(spark, sf_dir, "documents"), spec)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, with the shared and the item's shingles."""
    return dc.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document from its text, declared language and source, and whether it is kept."""
    return li.document_languages(table(spark, sf_dir, "documents"))


def page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page from its text, markup, address suffix and host; models fitted on documents."""
    return li.page_languages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that match an earlier line of the corpus."""
    return ld.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals by source, language and tokenizer version after three batches of changes.

    All documents are inserted; those labelled toxic are deleted and those
    labelled of low quality are revised to single spaces; then the first
    batch is sent once more, which changes nothing.
    """
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    insert = docs.select(F.lit("insert").alias("op"), "doc_id", "text", "source", "lang")
    gone = labels.where("toxic = 1").select(F.lit("delete").alias("op"), "doc_id", *[F.lit(None).cast("string").alias(c) for c in ("text", "source", "lang")])
    low = labels.where("quality = 0 and toxic = 0").select("doc_id").distinct()
    plain = F.btrim(F.regexp_replace("text", r"\s+", " "))
    # Up to a million ids of 8 bytes are broadcast; beyond that the join deals the texts out by id.
    low = F.broadcast(low) if low.count() <= 1_000_000 else low
    revise = docs.join(low, "doc_id", "left_semi").select(F.lit("revise").alias("op"), "doc_id", plain.alias("text"), "source", "lang")
    store = tc.CountStore(spark, scratch(spark, "token-counts"), {"byte_bpe_50k": public_tokenizers.path("byte_bpe_50k.tiktoken")})
    for batch, changes in ((1, insert), (2, gone.unionByName(revise)), (1, insert)):
        store.apply(batch, changes)
    return store.totals()


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: base spans, owner-specific additions and ownership verdicts."""
    return secrets.secret_scan(table(spark, sf_dir, "documents"))


def op7_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, extracted at its host's winning path."""
    return html_main.main_text(table(spark, sf_dir, "pages"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, decoded again for comparison."""
    return pieces.encode_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and representative of every vector at a cosine of 0.9."""
    return vd.vector_dedup(table(spark, sf_dir, "embeddings"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document written as token files in doc_id order and read back, per document."""
    return tf.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1)


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group, size and digest of every document's text after lower-casing A-Z; the largest doc_id stays."""
    return ed.exact_groups(table(spark, sf_dir, "documents"), keep="largest")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters take out of every language's documents, in all 120 orders and steps."""
    return fa.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Words of five letters and three occurrences; one in 97 words of a document is misspelt by a deletion.
SPELLING = sp.Variants(typos=97)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its most frequent near word and the root of its chain of forms."""
    return sp.variants(table(spark, sf_dir, "documents"), SPELLING)


QUERIES = {
    "op1_parity_join": op1_parity_join,
    "op2_decontaminate": op2_decontaminate,
    "op3_language_id": op3_language_id,
    "op4_line_dedup": op4_line_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_secrets": op6_secrets,
    "op7_html_main": op7_html_main,
    "op8_pieces": op8_pieces,
    "op9_vector_dedup": op9_vector_dedup,
    "op10_token_files": op10_token_files,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_filter_audit": op12_filter_audit,
    "op13_spelling_variants": op13_spelling_variants,
    "page_languages": page_languages,
}

ORACLE: dict[str, str] = {
    "op2_decontaminate": dc.oracle(),
    "op4_line_dedup": ld.oracle(),
    "op6_secrets": secrets.oracle(),
    "op11_exact_dedup": ed.oracle(),
    "op12_filter_audit": fa.oracle(),
    "op13_spelling_variants": sp.oracle(SPELLING),
}
