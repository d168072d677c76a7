"""Every stage of the pipeline against brute force on its own input, and run() against the stages."""

import corpus_pipeline as cp
import test_decontaminate
import test_line_dedup
import test_parity_join
import test_pieces

from pricescope.llm import pieces as pc

SF = "/root/testdata/sf0.01"


def test_stages_on_their_own_input_and_run(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, step = docs.columns, {}
    for name, stage in cp.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        if name != "sentencepiece":
            assert sorted(out.columns) == sorted(columns)
        step[name] = [{r["doc_id"]: r for r in x.collect()} for x in (docs, out)]
        docs = out

    before, after = step["language_id"]
    assert len(after) >= 0.98 * len(before) and all(after[i] == before[i] for i in after)

    before, after = step["line_dedup"]
    want = test_line_dedup.brute([(i, r["text"]) for i, r in before.items()])
    assert {i: r["text"] for i, r in after.items()} == {i: t for i, (t, _, gone) in want.items() if not gone or t.strip()}
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())

    before, after = step["ngram_jaccard"]
    groups = test_parity_join.brute([(i, r["text"]) for i, r in before.items()], 5, 8, 10)
    assert set(after) == {top for _, _, top in groups}

    before, after = step["decontaminate"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    leaks = {d for d, *_ in test_decontaminate.brute([(i, r["text"]) for i, r in before.items()], items)}
    assert set(after) == set(before) - leaks

    before, after = step["sentencepiece"]
    coder = pc.PieceCoder(test_pieces.MODEL)
    assert all(coder.decode(__import__("numpy").array(after[i]["ids"])) == before[i]["text"] for i in before) and set(after) == set(before)
    assert {r["doc_id"]: r for r in cp.run(spark, SF).collect()} == after


def test_stages_take_empty_and_null_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (2, "The cat and the dog", "en", "s", 9),
                                 (2, "The cat and the dog", "en", "s", 9)], docs.schema)
    for rows in (odd, docs.limit(0)):
        for name, stage in cp.STAGES:
            rows = spark.createDataFrame(stage(spark, rows, SF).collect(), rows.schema) if name != "sentencepiece" else stage(spark, rows, SF)
        rows.collect()
