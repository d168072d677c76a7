"""Language identification: held-out accuracy, priors by a plain restatement, and edge cases."""

import numpy as np

from pricescope.llm import language_id as li

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_of_text_alone(spark):
    s = li.Settings()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    train, held = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1 and n_chars >= 80").collect()
    models = li.fit(train, "text", "lang", s)
    right = [models.languages[int(models.evidence(r["text"], s).argmax())] == r["lang"] for r in held]
    assert len(right) > 300 and sum(right) / len(right) >= 0.97


def test_query_keeps_documents_in_known_languages(spark):
    from pricescope.llm import queries
    out = queries.op3_language_id(spark, SF).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(out) == len(docs)
    same = [r["lang"] == docs[r["doc_id"]]["lang"] for r in out]
    assert sum(same) / len(same) >= 0.98 and sum(r["kept"] for r in out) / len(out) >= 0.98


def test_pages_use_markup_address_and_host(spark):
    from pricescope.llm import queries
    out = queries.page_languages(spark, SF).collect()
    html = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(out) == len(html)
    assert sum(f'lang="{r["lang"]}"' in html[r["page_id"]] for r in out) / len(out) >= 0.97


def test_fusion_matches_a_plain_restatement(spark):
    s = li.Settings(pull=2.0)
    rng = np.random.default_rng(1)
    logp = np.log(rng.dirichlet(np.ones(s.slots), 3))
    models = li.TextModels(["aa", "bb", li.UND], logp)
    rows = [(i, t, d, a, h, h and h.split(".", 1)[-1]) for i, (t, d, a, h) in enumerate([
        ("some words here", "aa", None, "x.one"), ("other words", "BB-xx", "aa", "x.one"), ("", None, "bb", "y.one"), (None, "zz", None, "z.two"),
        ("more text of this kind", None, None, None), ("12 34", "bb", "bb", "y.one"), ("some words here", "aa", None, "x.one")])]
    df = spark.createDataFrame(rows, "id long, text string, declared string, address string, host string, domain string")
    out = {r["id"]: r for r in li.identify(df, models, s).collect()}
    ll = np.array([models.evidence(r[1], s) for r in rows])
    for j, right in ((2, s.declared), (3, s.address)):
        for i, r in enumerate(rows):
            code = (r[j] or "").split("-")[0].lower()
            if code in ("aa", "bb"):
                ll[i] += [np.log(right) if x == code else np.log((1 - right) / 2) for x in models.languages]
    soft = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    own = np.array([soft(x) for x in ll])
    base = (own.sum(0) + 1) / (own.sum() + 3)
    pulled = lambda n, p: (np.maximum(n, 0) + s.pull * p) / (max(n.sum(), 0) + s.pull)
    for i, r in enumerate(rows):
        host = own[[x[4] == r[4] for x in rows]].sum(0)
        domain = own[[x[5] == r[5] for x in rows]].sum(0)
        post = soft(ll[i] + np.log(pulled(host - own[i], pulled(domain - host, base))))
        assert out[i]["lang"] == models.languages[int(post.argmax())] and abs(out[i]["confidence"] - post.max()) < 1e-9


def test_empty_null_and_clashing_columns(spark):
    schema = "doc_id long, text string, lang string, source string, host string, ll int, own string"
    df = spark.createDataFrame([(None, None, None, None, "h", 1, "x"), (1, "", "en", "s", "h", 1, "x"), (1, "", "en", "s", "h", 1, "x"),
                                (2, "the words " * 20_000, "en", None, "h", 1, "x")], schema)
    out = li.document_languages(df).collect()
    assert sorted((str(r["doc_id"]), r["kept"]) for r in out) == [("1", False), ("1", False), ("2", True), ("None", False)]
    assert li.document_languages(df.limit(0)).collect() == []


def test_every_label_has_a_model_and_copies_count_once(spark):
    s = li.Settings(rows_per_language=5, slots=1 << 10)
    rows = [(f"text number {j} of label {i}", f"l{i:03d}") for i in range(230) for j in range(2)]
    rows += [("one text copied very often", "copied")] * 500 + [(f"other text {j}", "copied") for j in range(40)]
    rows.append(("the rarest label of all", "rare"))
    df = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    got = [sorted(map(tuple, li.sample(d, "text", "lang", s).collect())) for d in (df, df.repartition(3))]
    assert got[0] == got[1]
    texts = {}
    for lang, text in got[0]:
        texts.setdefault(lang, []).append(text)
    assert len(texts) == 232 and texts["rare"] == ["the rarest label of all"] and len(texts["l007"]) == 2
    assert len(texts["copied"]) == len(set(texts["copied"])) == 5
    models = li.fit(df, "text", "lang", s)
    assert models.languages == [*sorted(texts), li.UND]
    assert np.allclose(np.exp(models.logp).sum(axis=1), 1, atol=1e-3)
    n = sum(np.bincount(li.grams(t, s.slots), minlength=s.slots) for t in texts["copied"]) + s.smooth
    assert np.allclose(models.logp[models.languages.index("copied")], np.log(n / n.sum()), atol=1e-4)


def test_documents_of_rare_labels_are_identified(spark):
    from functools import reduce
    words = [f"{a}{b}{c}" for a in "kmpt" for b in "aeiou" for c in "lnrsvz"]
    rows, n = [], 210
    for i in range(n):
        mine = [words[(7 * i + 11 * j) % len(words)] + chr(0x4e00 + i) for j in range(12)]
        rows += [(1000 * i + j, reduce(lambda x, y: f"{x} {y}", mine[j:] + mine[:j]), f"x{chr(97 + i // 26)}{chr(97 + i % 26)}", "s")
                 for j in range(3 if i < 200 else 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = {r["doc_id"]: r for r in li.document_languages(df, li.Settings(slots=1 << 12)).collect()}
    assert all(out[r[0]]["lang"] == r[2] and out[r[0]]["kept"] for r in rows)


def test_keep_known_lets_columns_of_any_name_through(spark):
    cols = ["_d", "_h", "lost_id", "lost_hash", "id", "address", "domain", "declared", "host", "confidence", "kept"]
    rows = [(i, f"the river and the house of the old man number {i}", "en", "a.example", *[f"{c}{i}" for c in cols]) for i in range(30)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", *cols])
    got = li.keep_known(docs)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == sorted(rows)
