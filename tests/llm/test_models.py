from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from ledgersieve.llm import decontam_lsa, html_mss, langid, quality_mil

SYLLABLES = {"aa": "ba be bi bo bu", "bb": "ka ke ki ko ku"}


def text(draw, lang, n=60):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(draw.choices(parts, k=3)) for _ in range(n))


def test_languages_of_held_out_and_awkward_rows(docs_of, awkward):
    draw = random.Random(1)
    table = [(i, text(draw, lang), lang) for i, lang in enumerate(list(SYLLABLES) * 40)]
    train = docs_of([(*r, None) for r in table[:60]], extra=True).withColumnRenamed("id", "id2").withColumnRenamed("doc_id", "id")
    model = langid.fit(train)
    found = {r.doc_id: r.lang_pred for r in langid.identify(docs_of([(*r, None) for r in table[60:]]), model).collect()}
    assert found == {r[0]: r[2] for r in table[60:]}
    out = langid.identify(docs_of(awkward, extra=True), model).collect()
    assert len(out) == len(awkward) and all(0 <= r.score <= 1 for r in out)
    assert {r.lang_pred for r in out if r.doc_id in (4, 5, 6)} == {"und"}
    none = langid.fit(docs_of([]).withColumnRenamed("doc_id", "id"))
    assert [r.lang_pred for r in langid.identify(docs_of([(1, "abc")]), none).collect()] == ["und"]


def test_score_and_rejection_are_set_by_all_training_rows(docs_of):
    draw = random.Random(5)
    table = [(i, text(draw, lang, 4 + i % 9), lang) for i, lang in enumerate(list(SYLLABLES) * 1300)]
    table += [(90_000 + i, "zq " * (i + 1), lang) for i, lang in enumerate(list(SYLLABLES) * 5)]
    table += [(95_000, "1 2 3", "en"), (95_001, None, "en"), (95_002, "abc", None)]
    model = langid.fit(docs_of([(*r, None) for r in table]).withColumnRenamed("doc_id", "id"))
    rows = [r for r in table[:-3]]
    entropy, _ = model.entropies([r[1] for r in rows])
    true = np.array([model.languages.index(r[2]) for r in rows])
    expected = [np.quantile(entropy[true == k, k], 1 - langid.REJECT_SHARE) * 1.1 for k in range(len(model.languages))]
    assert np.allclose(model.limits, expected, rtol=1e-9)
    odds = {x: np.exp(-x * (entropy - entropy.min(axis=1, keepdims=True))) for x in langid.SHARPNESS}
    loss = {x: -np.log(o[np.arange(len(true)), true] / o.sum(axis=1) + 1e-9).mean() for x, o in odds.items()}
    assert model.sharpness == min(loss, key=loss.get)


def test_model_keeps_every_gram_whatever_the_number_of_languages(docs_of):
    draw = random.Random(8)
    texts = ["".join(chr(0x4E00 + draw.randrange(40)) for _ in range(2000)) for _ in range(30)]
    table = [(i, t, "zz") for i, t in enumerate(texts)] + [(100 + i, text(draw, "aa", 3), f"l{i:03}") for i in range(300)]
    model = langid.fit(docs_of([(*r, None) for r in table]).withColumnRenamed("doc_id", "id"))
    codes, counts = np.unique(langid.grams(texts)[0], return_counts=True)
    assert (counts == 1).any()
    kept, expected = model.models[model.languages.index("zz")], langid.KneserNey(codes, counts)
    for a, b in zip(kept.levels, expected.levels):
        assert np.array_equal(a.grams, b.grams) and np.allclose(a.logp, b.logp)


def test_kneser_ney_probabilities_sum_to_one():
    import numpy as np

    codes, counts = np.unique(langid.grams(["abracadabra abba", "bad cab"])[0], return_counts=True)
    model = langid.KneserNey(codes, counts)
    letters = np.unique(codes & np.uint64(0xFFFF))
    for context in np.unique(codes >> np.uint64(16))[:5]:
        total = np.exp(model.log(context << np.uint64(16) | letters)).sum()
        assert 0.95 < total <= 1.001


def test_quality_learns_junk_and_takes_awkward_rows(docs_of, awkward):
    draw = random.Random(3)
    table = [(i, text(draw, "aa") if i % 3 else text(draw, "aa").replace(" ", "### ")) for i in range(150)]
    docs = docs_of(table, extra=True)
    labels = docs.select(F.col("doc_id").alias("id"), (F.col("doc_id") % 3 != 0).cast("int").alias("label"))
    model = quality_mil.fit(docs, labels.where("id < 100"))
    found = {r.doc_id: r.score >= 0.3 for r in quality_mil.score(docs, model).where("doc_id >= 100").collect()}
    assert found == {i: bool(i % 3) for i in range(100, 150)}
    for m in (model, None):
        scores = quality_mil.score(docs_of(awkward, extra=True), m).collect()
        assert len(scores) == len(awkward) and all(0 <= r.score <= 1 for r in scores)
    assert quality_mil.fit(docs_of([]), labels) is None


PAGE = """<!DOCTYPE html><html><head><title>T x</title><script>var a="</p>";</script></head><body><nav><ul><li><a href="/a">menu</a></li>
<li><a href="/b">words here</a></li></ul></nav><div class="ad">Buy this thing now today</div>{0}<h1>Head &amp; line</h1><p><b>First {2}<br>
text&nbsp;of   it<p>Second&#33; part wo<i>rd</i> of the body goes on and on</p>{1}<footer>&copy; some foot words</footer>"""


def test_main_text_without_and_with_labels(spark):
    pages = [PAGE.format("<article>", "</article></body></html>", i) for i in range(20)]
    weights = html_mss.learn(pages)
    expected = "Head & line First 7 text of it Second! part word of the body goes on and on"
    assert html_mss.main_text(pages[7], weights) == expected
    assert html_mss.main_text(PAGE.format("", "", 7), weights).startswith("Head & line First 7")
    rows = [(1, "u", pages[7], "x"), (None, None, None, "x"), (2, "u", "", "x"), (2, "u", "", "x"), (3, "u", "a < b", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = [r.text for r in html_mss.extract(df, weights).collect()]
    assert found == [expected, "", "", "", "a < b"]
    assert html_mss.extract(df.limit(0), html_mss.fit(df.limit(0))).count() == 0


def test_items_are_found_copied_or_edited(docs_of, awkward, spark):
    draw = random.Random(9)
    word = lambda: "".join(draw.choices("abcdefghijklm", k=5))
    items = [(k, " ".join(word() for _ in range(draw.randrange(14, 60))) + ".") for k in range(20)]
    table, truth = list(awkward), set()
    for d in range(100, 220):
        body = [word() for _ in range(draw.randrange(20, 400))]
        if d % 2:
            k = draw.randrange(20)
            leak = items[k][1].split()
            if d % 4 == 1:
                leak[3] = "changed"
            at = draw.randrange(len(body))
            body[at:at] = leak
            truth.add((d, k))
        table.append((d, " ".join(body)))
    benchmark = spark.createDataFrame([*items, (None, None), (98, ""), (99, " . ")], "item_id long, text string")
    docs = docs_of(table, extra=True)
    found = {(r.id, r.item_id) for r in decontam_lsa.find_items(docs, benchmark).collect()}
    assert found <= truth and len(found) >= 0.95 * len(truth)
    kept = decontam_lsa.clean_documents(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == len(table) - len({d for d, _ in found})
    assert decontam_lsa.find_items(docs, benchmark.limit(0)).count() == 0
    assert decontam_lsa.find_items(docs_of([]), benchmark).count() == 0


def test_long_items_and_rewritten_rare_words_are_found(docs_of, spark):
    draw = random.Random(10)
    rare = lambda: "".join(draw.choices("abcdefghijklm", k=6))
    prose = lambda n: [draw.choice(["the", "of", "and", "to", "in", "is"]) if i % 2 else rare() for i in range(n)]
    items = [prose(n) for n in (40, 200, 250, 300, 700)]
    rewritten = []
    for item in items:
        copy = list(item)
        copy[: int(0.6 * len(item)) : 2] = [rare() for _ in copy[: int(0.6 * len(item)) : 2]]  # 30 % of the words, all rare
        rewritten.append(copy)
    table = [(i, " ".join(prose(300))) for i in range(60)]
    for k, copies in enumerate(zip(items, rewritten)):
        table += [(100 + 10 * k + j, " ".join([*prose(90), *copy, *prose(90)])) for j, copy in enumerate(copies)]
    benchmark = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    found = {(r.id, r.item_id) for r in decontam_lsa.find_items(docs_of(table), benchmark).collect()}
    assert found == {(100 + 10 * k + j, k) for k in range(len(items)) for j in range(2)}


def test_pipeline_stages_keep_columns_and_clean_rows(docs_of, spark, tmp_path):
    import corpus_pipeline

    draw = random.Random(4)
    body = lambda: " ".join("".join(draw.choices("abcdefghijklm", k=5)) for _ in range(120))
    item = " ".join("".join(draw.choices("nopqrst", k=6)) for _ in range(30))
    table = [(i, body(), "en", "a") for i in range(20)]
    table += [(20, table[3][1], "en", "a"), (21, body() + " " + item + " " + body(), "en", "a"), (22, "short", "en", "a"), (23, None)]
    table += [(30 + i, body() + "\nthis very line is in all of them", "en", "b") for i in range(4)]
    sf = str(tmp_path)
    docs_of(table).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, sf).write.parquet(f"{sf}/stage{k}")
        docs = spark.read.parquet(f"{sf}/stage{k}")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert set(kept) == {*range(20), 30, 31, 32, 33}
    assert sum("this very line" in t for t in kept.values()) == 1
    pieces = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in pieces.collect()} == set(kept)


def test_near_duplicates_without_or_with_one_id_keep_unlike_rows(docs_of, spark):
    import corpus_pipeline

    draw = random.Random(6)
    texts = [" ".join("".join(draw.choices("abcdefghijklm", k=5)) for _ in range(120)) for _ in range(7)]
    table = [(i, t) for i, t in zip([None, None, None, 7, 7, 7, 8], texts)]
    table += [(None, texts[0]), (9, texts[1]), (7, texts[3]), (12, texts[3]), (11, texts[6])]
    kept = corpus_pipeline.drop_near_duplicates(spark, docs_of(table), "")
    expected = [(None, texts[0]), (9, texts[1]), (None, texts[2]), *[(7, t) for t in texts[3:6]], (8, texts[6])]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(expected, key=repr)
