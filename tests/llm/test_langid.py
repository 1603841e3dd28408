"""Held-out accuracy and awkward rows of the compression classifier."""

from pyspark.sql import functions as F

from eventloom.llm import langid, queries
from eventloom.llm.common import table


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op7_language_id"](spark, folder).join(table(spark, folder, "documents"), "doc_id").where("held_out").collect()
    assert len(rows) > 150
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.96
    assert sum(r.rejected for r in rows) / len(rows) <= 0.02
    assert all(0 <= r.score <= 1 for r in rows)


def test_awkward_rows(spark, docs, no_docs):
    clashing = docs.withColumns({"score": F.lit("mine"), "lang_pred": F.lit("mine"), "_text": F.lit(1)})
    learned = langid.learned(clashing)
    assert set(learned.content) <= {"en", "fr", "de"}
    result = langid.identify(clashing, learned, carry=("doc_id", "score", "_text"), prefix="p_").collect()
    assert len(result) == docs.count() and all(r.score == "mine" for r in result)
    by = {r.doc_id: r for r in result}
    for i in (4, 5, 8, 16):  # NULL, empty, no letter, blanks
        assert (by[i].p_lang_pred, by[i].p_score, by[i].p_rejected) == ("und", 0.0, True)
    assert by[6].p_lang_pred in learned.content
    assert langid.identify(no_docs, learned).count() == 0


def test_nothing_learned(spark, docs, no_docs):
    rows = langid.identify(docs, langid.learned(no_docs)).collect()
    assert {r.lang_pred for r in rows} == {"und"} and all(r.rejected for r in rows)


def test_training_ignores_the_held_out_fold(spark, docs):
    train = langid.training_rows(docs, F.col("doc_id") != 6)
    assert all("w0x0" not in r.text or r.lang == "fr" for r in train.collect())


def test_ties_are_rejected():
    same = langid.Languages({"a": b"one two three", "b": b"one two three"}).compressors()
    lang, score, margin, rejected = langid.decide("one two", same)
    assert (lang, round(score, 6), margin, rejected) == ("a", 0.5, 0.0, True)
