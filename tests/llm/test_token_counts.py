"""Delta rollups against recounting from scratch, replays and a crash before the commit."""

import random
from collections import Counter

import public_tokenizers
import pytest

from pricescope.llm import token_counts as tc

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "op string, doc_id long, text string, source string, lang string, seq int, n_tokens string"


def count(text):
    import base64

    import tiktoken
    global ENC
    if "ENC" not in globals():
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
        ENC = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return len(ENC.encode_ordinary(text or ""))


def rolled(state):
    out = Counter(), Counter()
    for source, lang, text in state:
        out[0][source, lang] += 1
        out[1][source, lang] += count(text)
    return sorted(((s, g, "v1", n, out[1][s, g]) for (s, g), n in out[0].items()), key=str)


def test_batches_equal_a_recount_and_replays_change_nothing(spark, tmp_path):
    rng = random.Random(2)
    store = tc.CountStore(spark, str(tmp_path / "s"), {"v1": PATH})
    assert store.totals().collect() == []
    state, loose, sent = {}, [], []
    for batch in (3, 1, 7):
        changes = []
        for k in range(60):
            op, i = rng.choice(("insert", "insert", "delete", "revise")), rng.choice((None, *range(30)))
            text = rng.choice((None, "", "<|endoftext|>", " ".join(rng.choices(["tok", "être", "🙂"], k=rng.randint(1, 30)))))
            changes.append((op, i, text, rng.choice(("hot", "hot", "b", None)), rng.choice(("en", None)), k, "x"))
        for op, i, text, source, lang, _, _ in changes:
            if i is None:
                loose += [] if op == "delete" else [(source, lang, text)]
            elif op == "delete":
                state.pop(i, None)
            else:
                state[i] = (source, lang, text)
        sent.append((batch, changes))
        assert store.apply(batch, spark.createDataFrame(changes, SCHEMA))
    want = rolled([*state.values(), *loose])
    assert sorted((tuple(r) for r in store.totals().collect()), key=str) == want
    for batch, changes in sent:
        assert not store.apply(batch, spark.createDataFrame(changes, SCHEMA))
    assert sorted((tuple(r) for r in store.totals().collect()), key=str) == want


def test_a_batch_that_fails_before_its_commit_is_invisible_and_can_be_sent_again(spark, tmp_path):
    store = tc.CountStore(spark, str(tmp_path / "s"), {"v1": PATH})
    ok = spark.createDataFrame([("insert", 1, "a b c", "s", "en", 0, "")], SCHEMA)
    bad = spark.createDataFrame([("insert", 2, "d", "s", "en", 0, ""), ("upsert", 3, "d", "s", "en", 0, "")], SCHEMA)
    store.apply(1, ok)
    with pytest.raises(Exception, match="unknown change"):
        store.apply(2, bad)
    # rows and deltas of a half-written batch
    spark.createDataFrame([("s", "en", "v1", 9, 9)], "source string, lang string, version string, n_docs long, n_tokens long") \
        .write.parquet(f"{store.root}/deltas/batch=2")
    assert [tuple(r) for r in store.totals().collect()] == [("s", "en", "v1", 1, 3)]
    assert store.apply(2, ok.limit(0)) and store.committed() == [1, 2]
    assert [tuple(r) for r in store.totals().collect()] == [("s", "en", "v1", 1, 3)]


def test_query_equals_a_recount_of_the_whole_table(spark):
    from pricescope.llm import queries
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    marks = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    state = []
    for r in docs:
        m = marks.get(r["doc_id"])
        if not (m and m["toxic"] == 1):
            text = " ".join(r["text"].split()) if m and m["quality"] == 0 else r["text"]
            state.append((r["source"], r["lang"], text))
    want = [(a, b, "byte_bpe_50k", n, t) for a, b, _, n, t in rolled(state)]
    assert sorted(tuple(r) for r in queries.op5_token_counts(spark, sf).collect()) == sorted(want)
