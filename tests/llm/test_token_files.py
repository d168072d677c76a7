"""Token files against whole-text encoding and the file format's own rules."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pricescope.llm import token_files as tf

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


def expect(tok, rows):
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, (r[1] or "").encode())):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


PIECES = ["The", "word,", "it's", "'S", "don't!", "é", "É", "straße", "ΣΑΣ", "á", "́b", "42", "x1y", "<|endoftext|>",
          "a<|startoftext|>b", "%%%", "...", " ", " ", "\x1c", "\t", "\r\n", "日本", "🙂", "ǅ", "İ", "!'s", "a'", "_a_",
          "I'LL.", "ſ", "K", "½", "٣", "-", "re:", "'re", "ab''ll"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=8)), max_size=12), st.sampled_from(["", " ", "\n", "  "]))
def test_pieces_give_the_ids_of_the_whole_text(parts, sep):
    text = sep.join(parts)
    global _words, _tok
    try:
        _words
    except NameError:
        _words, _tok = tf.WordIds(PATH, "<u4"), Tokenizer.from_file(PATH)
    assert np.frombuffer(_words.encode(text), "<u4").tolist() == _tok.encode(text, add_special_tokens=False).ids


def test_every_word_with_every_mark_after_and_before_it():
    words, tok = tf.WordIds(PATH, "<u4"), Tokenizer.from_file(PATH)
    stems = [*PIECES, "İİ", "aİ", "ﬁ", "ŉ", "ǰ", "ẞ", "Å", "ﬃx", "ΐ", "한", "가", "e\u0301"]
    marks = [*tf.MARKS, "'", "...", ",'", "—", "\u0307", "İ"]
    for text in [x for w in stems for m in marks for x in (w + m, m + w, w + m + w)]:
        assert np.frombuffer(words.encode(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, text


def test_the_encoder_is_kept_in_the_worker():
    assert tf.word_ids(PATH, "<u2") is tf.word_ids(PATH, "<u2")


def test_query_matches_whole_text_encoding(spark, tok):
    from pricescope.llm import queries
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    out = queries.op10_token_files(spark, SF).collect()
    assert sorted(tuple(r) for r in out) == sorted(expect(tok, rows))


def test_nulls_ties_and_bases_over_many_shards(spark, tok, tmp_path):
    rows = [(5, "b c"), (5, "a"), (None, "x y"), (None, None), (2**60, "long " * 3000), (-3, ""), (7, "same"), (7, "same")]
    df = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id long, text string, start string")
    m = tf.write_token_files(df, str(tmp_path / "f"), PATH, 1, partitions=4)
    out = tf.read_token_files(spark, str(tmp_path / "f")).orderBy("start").collect()
    assert [tuple(r) for r in out] == expect(tok, rows)
    ends = np.cumsum([s["tokens"] for s in m["shards"]])
    assert [s["token_base"] for s in m["shards"]] == [0, *ends[:-1].tolist()] and m["width"] == 2
    assert not [p for p in (tmp_path / "f").iterdir() if p.name.startswith("_")]
    empty = tf.token_digests(df.limit(0), PATH, folder=str(tmp_path / "g"))
    assert empty.collect() == []
