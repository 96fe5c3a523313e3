import numpy as np
from helpers import DOCS, SMALL, documents, odd_texts

from slotviews.llm import langid
from slotviews.llm.common import table
from slotviews.llm.queries import op8_language_codes


def test_held_out_accuracy(spark):
    rows = op8_language_codes(spark, SMALL.replace("sf0.001", "sf0.01")).collect()
    truth = {r.doc_id: r.lang for r in table(spark, SMALL.replace("sf0.001", "sf0.01"), "documents").collect()}
    held = [r for r in rows if r.held_out]
    assert 150 < len(held) < 350
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text", "lang")
    known = langid.train(docs.filter(~langid.held_out(docs["doc_id"])))
    changed = docs.selectExpr("doc_id", "text", "if(crc32(cast(doc_id as string)) % 4 = 2, 'xx', lang) AS lang")
    again = langid.train(changed.filter(~langid.held_out(docs["doc_id"])))
    assert known.languages == again.languages and np.array_equal(known.weights, again.weights)


def test_odd_texts(spark):
    model = langid.train(table(spark, SMALL, "documents"))
    rows = documents(spark, [*odd_texts(), "123 !! 456", "É"]).withColumnRenamed("n", "score")
    got = {r.doc_id: r for r in langid.predict(rows, model).collect()}
    assert got[0].lang_pred == got[1].lang_pred == got[2].lang_pred == "und" and got[0].score == 0 and got[0].ambiguous
    assert got[len(got) - 2].lang_pred == "und"
    assert got[len(got) - 1].lang_pred in model.languages
    assert len(got) == rows.count() and got[4].block == 1


def test_mixed_texts_are_ambiguous_and_plain_ones_are_not(spark):
    rows = [r for r in table(spark, SMALL.replace("sf0.001", "sf0.01"), "documents").collect() if r.lang and len(r.text or "") > 400]
    model = langid.train(table(spark, SMALL.replace("sf0.001", "sf0.01"), "documents"))
    mixed = [a.text[:400] + " " + b.text[:400] for a, b in zip(rows, rows[7:], strict=False) if a.lang != b.lang]
    flagged = lambda texts: np.mean([r.ambiguous for r in langid.predict(documents(spark, texts), model).collect()])
    assert flagged(mixed) > 0.15 and flagged([r.text for r in rows]) < 0.01


def test_nothing_learned(spark):
    model = langid.train(spark.createDataFrame([(1, "text", None, "s", 1, 1, 1, "x", "y"), (2, None, "en", "s", 1, 1, 1, "x", "y")], DOCS))
    assert {r.lang_pred for r in langid.predict(documents(spark, ["some text"]), model).collect()} == {"und"}


def test_one_language(spark):
    model = langid.train(documents(spark, ["some text", "more"]))
    assert [(r.lang_pred, r.score) for r in langid.predict(documents(spark, ["other"]), model).collect()] == [("en", 1.0)]


def test_codewords_differ():
    for n in (2, 3, 4, 5, 6, 20):
        code = langid.codewords(n)
        apart = (code[:, None] != code[None]).sum(2) + 1000 * np.eye(n)
        assert len(code) == n and apart.min() >= 1 and (np.abs(code.sum(0)) < n).all()
    assert (langid.codewords(4)[:, None] != langid.codewords(4)[None]).sum(2).max() == 4
