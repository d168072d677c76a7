"""Piece encoding against a quadratic Viterbi over the whole text, and exact round trips."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pricescope.llm import pieces as pc

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def coder():
    return pc.PieceCoder(MODEL)


def plain(coder, text):
    """Best segmentation by trying every piece at every position of the whole text."""
    words = dict((k, v) for k, v in coder.auto.items())
    out, longest = [], max(map(len, words))
    for p in f" {text}".split("▁"):
        t = p.replace(" ", "▁")
        best, back = [0.0], [None]
        for e in range(1, len(t) + 1):
            s, b = best[e - 1] + coder.unknown, None
            for size in range(min(longest, e), 0, -1):
                w = words.get(t[e - size:e])
                if w and best[e - size] + w[2] > s:
                    s, b = best[e - size] + w[2], w
            best.append(s)
            back.append(b)
        ids, e = [], len(t)
        while e:
            if back[e]:
                ids.append(back[e][0])
                e -= back[e][1]
            else:
                ids += [coder.byte[x] for x in reversed(t[e - 1].encode())]
                e -= 1
        out.append(ids[::-1])
    got = out[0]
    for ids in out[1:]:
        got = got + [coder.byte[x] for x in "▁".encode()] + ids
    return got if text else []


TEXTS = st.lists(st.one_of(st.sampled_from(["the ", "tion", "  ", "\n", "▁", "é", "日本", "🙂", "<0x0A>", "<s>", "\x00", "ing", "12"]),
                           st.text(max_size=6)), max_size=10).map("".join)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_best_segmentation_and_round_trip(coder, text):
    ids = coder.encode(text)
    assert ids.tolist() == plain(coder, text)
    assert coder.decode(ids) == text


def test_long_text_without_spaces(coder):
    text = "abcdéfghij🙂" * 20_000
    assert coder.decode(coder.encode(text)) == text


def test_query_round_trips_whole_table_and_decodes_in_spark(spark):
    from pricescope.llm import queries
    out = queries.op8_pieces(spark, SF)
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    back = {r[0]: r[1] for r in pc.decode_pieces(out, MODEL).collect()}
    assert back == texts
    assert out.where("not exact or n_tokens <> size(ids)").count() == 0


def test_nulls_repeats_and_empty_table(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, "", "a"), (None, "x y", "b"), (None, "x y", "b")], "doc_id long, text string, ids string")
    out = sorted((tuple(r) for r in pc.encode_pieces(df, MODEL).collect()), key=str)
    assert (1, None, 0, 0, None) in out and (1, [], 0, 0, True) in out and len(out) == 4
    assert pc.encode_pieces(df.limit(0), MODEL).collect() == []


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def merger():
    return pc.piece_coder(MODEL)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_bpe_ids_are_the_librarys(merger, library, text):
    text = text.replace("▁", "")  # a space mark in the text is spelt by bytes here, so that decoding is exact
    assert isinstance(merger, pc.MergeCoder)
    assert merger.encode(text).tolist() == library.encode(text)


def test_bpe_documents_have_the_librarys_ids(spark, merger, library):
    from pricescope.llm import queries
    assert [library.id_to_piece(int(i)) for i in merger.encode("The Device is working")] == ["▁The", "▁Device", "▁is", "▁working"]
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    out = {r["doc_id"]: r["ids"] for r in queries.op8_pieces(spark, SF).collect()}
    assert all(out[i] == library.encode(t) for i, t in texts.items() if "▁" not in t)


def test_long_runs_and_marks_merge_exactly(merger, library):
    for text in ("a" * 5000, " " * 3001, "abcdéfghij🙂" * 2000, "the" * 3000 + "  \n\n   x", "日本語の文" * 500):
        assert merger.encode(text).tolist() == library.encode(text)
        assert merger.decode(merger.encode(text)) == text
    text = "a▁b ▁▁"
    assert merger.decode(merger.encode(text)) == text
