"""Presence kernel against sets, and accuracy on texts that the fit never saw."""

import numpy as np

from pedalgrid.llm import lang_id
from pedalgrid.llm.common import table

FOLDER = "/root/testdata/sf0.01"


def gram_set(text):
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
    return {data[k : k + n] for n in (1, 2, 3) for k in range(len(data) - n + 1)}


def codes(text):
    return np.sort(lang_id._distinct(lang_id._grams(np.frombuffer(text.encode(), np.uint8)))).astype(np.int64)


def test_kernel_is_shared_grams_over_the_root_of_sizes():
    texts = ["The cat sat", "le chat était là", "a", "Der Hund über dem Haus", "zzz"]
    model = lang_id.fit([codes(t) for t in texts], ["en", "fr", "en", "de", "de"], landmarks=4)
    order = [3, 0, 1, 4]  # by language in turn
    kernel = model.kernel([np.frombuffer(t.encode(), np.uint8) for t in texts])
    for i, a in enumerate(texts):
        for j, k in enumerate(order):
            x, y = gram_set(a), gram_set(texts[k])
            assert abs(kernel[i, j] - len(x & y) / (len(x) * len(y)) ** 0.5) < 1e-6


def test_held_out_accuracy(spark):
    docs = table(spark, FOLDER, "documents")
    found = docs.select("doc_id", "lang").join(lang_id.classify(docs), "doc_id").where("held_out").collect()
    assert len(found) > 200
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.98


def test_number_characters_are_no_letters(spark, documents):
    docs = documents(["½ ² ① 1⁄2", "Ⅷ", "a½", "the word of the day", "der Tag"], ids=[0, 4, 8, 12, 16])
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in lang_id.classify(docs).collect()}
    assert got[0] == ("und", 0.0) == got[4] and got[8][0] == "en"


def test_hard_rows(spark, documents):
    docs = documents([None, "", "123 .,!", "the word", "日本語", "x" * 200_000, "the word"], ids=[1, 2, 3, 4, 5, 6, 4])
    rows = [(r["doc_id"], r["lang_pred"], r["score"]) for r in lang_id.classify(docs).collect()]
    assert len(rows) == 7
    for k, lang, score in rows:
        assert (lang, score) == ("und", 0.0) if k < 4 else lang == "en" and 0 < score <= 1
    assert lang_id.classify(docs.where("doc_id < 0")).count() == 0
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r["lang_pred"] for r in lang_id.classify(unlabelled).collect()} == {"und"}


def test_answers_do_not_depend_on_language_source_or_id(spark):
    docs = table(spark, FOLDER, "documents")
    model = lang_id.train(docs.selectExpr("text", "lang", "xxhash64(text) rank"), sample=200, landmarks=40)
    some = docs.where("doc_id < 40")
    plain = {r["doc_id"]: r["lang_pred"] for r in lang_id.predict(some, model).collect()}
    other = some.selectExpr("doc_id + 1000 doc_id", "text", "'xx' lang", "'yy' source")
    assert plain == {r["doc_id"] - 1000: r["lang_pred"] for r in lang_id.predict(other, model).collect()}


def test_a_language_with_very_many_rows_stays(spark):
    # With a share of one row, more than 2,000,000 rows are above the threshold that a millionth is.
    many = spark.range(2_200_000).selectExpr("'word' text", "'aa' lang", "xxhash64(id) rank")
    few = spark.range(3).selectExpr("'Wort' text", "'bb' lang", "xxhash64(id) rank")
    assert lang_id.train(many, sample=1).langs == ["aa"]
    assert lang_id.train(many.union(few), sample=2).langs == ["aa", "bb"]
