"""Statistics, pooling, and the classifier on labels that the fit never saw."""

import numpy as np
import pyarrow as pa

from pedalgrid.llm import quality as q
from pedalgrid.llm.common import strings, table

FOLDER = "/root/testdata/sf0.1"


def stat(texts, name):
    return q.statistics(*strings(pa.array(texts, pa.string())))[:, q.STATS.index(name)]


def test_statistics_of_small_texts():
    texts = ["Ab c.\nAb c.\nde 12", "", None, "### $$$", "\n\n", "x"]
    assert np.allclose(stat(texts, "bytes"), np.log1p([17, 0, 0, 7, 2, 1]))
    assert np.allclose(stat(texts, "words"), np.log1p([6, 0, 0, 2, 0, 1]))
    assert np.allclose(stat(texts, "digits"), [2 / 17, 0, 0, 0, 0, 0])
    assert np.allclose(stat(texts, "symbols"), [0, 0, 0, 6 / 7, 0, 0])
    assert np.allclose(stat(texts, "distinct_words"), [4 / 6, 0, 0, 1, 0, 1])
    assert np.allclose(stat(texts, "repeated_lines"), [1 / 3, 0, 0, 0, 0.5, 0])
    assert not q.statistics(*strings(pa.array(["", None], pa.string()))).any()


def test_statistics_do_not_depend_on_neighbours(prose):
    together = q.statistics(*strings(pa.array(prose, pa.string())))
    for k, text in enumerate(prose):
        assert np.allclose(q.statistics(*strings(pa.array([text], pa.string())))[0], together[k])


def test_pooling_rises_and_keeps_the_mean():
    draw = np.random.default_rng(1)
    score, count = np.arange(50) / 50, draw.integers(1, 9, 50).astype(float)
    positive = np.minimum(count, draw.integers(0, 9, 50))
    knots, levels = q.pooled(score, positive, count)
    assert (np.diff(levels) > 0).all() and (np.diff(knots) > 0).all()
    assert 0 <= levels.min() and levels.max() <= 1
    assert [x.tolist() for x in q.pooled(np.array([0.1, 0.2]), np.array([1.0, 0.0]), np.array([1.0, 1.0]))] == [[0.15000000000000002], [0.5]]


def test_held_out_labels(spark):
    found = q.classify(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
    rows = found.join(table(spark, FOLDER, "labels"), "doc_id").where("held_out").collect()
    good = [r["predicted"] for r in rows if r["quality"] == 1]
    bad = [r["predicted"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.05
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_hard_rows(spark, documents, prose):
    docs = documents(prose)
    labels = spark.createDataFrame([(0, 1), (0, 1), (1, None), (4, 0), (5, 1), (8, 0), (999, 1)], "doc_id long, quality int")
    rows = q.classify(docs, labels).collect()
    assert len(rows) == len(prose) and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in q.classify(docs, labels.where("doc_id < 0")).collect()} == {0.5}
    assert q.classify(docs.where("doc_id < 0"), labels).count() == 0
    assert q.accepted(docs, labels).columns == docs.columns


def test_without_usable_labels_all_rows_stay(spark, documents):
    docs = documents(["a b c", "d", None, ""])
    labels = spark.createDataFrame([(0, None), (999, 1)], "doc_id long, quality int")
    for some in (labels, labels.where("doc_id < 0")):
        assert q.accepted(docs, some).count() == 4
