"""Seed families, and leaks against sliding every item over every document."""

import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa

from pedalgrid.llm import decontam as d
from pedalgrid.llm.common import strings, words


def expected(texts, items):
    split = lambda t: re.findall(r"[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = set()
    for k, text in enumerate(texts):
        doc = split(text)
        for i, item in items:
            want = split(item)
            size = min(len(want), d.WINDOW)
            if not want:
                continue
            best = 0
            for start in range(-len(want) + 1, len(doc)):
                equal = [0 <= start + q < len(doc) and doc[start + q] == want[q] for q in range(len(want))]
                best = max([best, *(sum(equal[q : q + size]) for q in range(len(want) - size + 1))])
            if best >= math.ceil(d.SHARE * size):
                out.add((k, i, best))
    return out


def test_any_text_with_a_fifth_of_other_words_shares_a_seed():
    for n in range(1, d.WINDOW + 1):
        family = next(f for least, f in d.FAMILIES if n >= least)
        for other in itertools.combinations(range(n), n - math.ceil(d.SHARE * n)):
            places = set(range(n)) - set(other)
            assert any(all(s + p in places for p in d._mask(m)) for m in family for s in range(n - len(m) + 1)), (n, other)


def test_equals_sliding(spark, documents):
    draw = random.Random(6)
    vocabulary = [f"w{k}" for k in range(40)]
    items = [(k, " ".join(draw.choice(vocabulary) for _ in range(n))) for k, n in enumerate([1, 2, 3, 4, 5, 6, 9, 12, 15, 17, 25, 40, 60])]
    texts = [" ".join(draw.choice(vocabulary) for _ in range(draw.choice([0, 4, 30, 90]))) for _ in range(25)]
    for _, item in items:
        for share in (0, 0.1, 0.2, 0.3):
            other = item.split(" ")
            for q in draw.sample(range(len(other)), int(share * len(other))):
                other[q] = "new"
            texts.append("Before, " + ". ".join(other).upper() + "! after")
        texts.append(" ".join(item.split(" ")[: max(4, len(item.split(" ")) // 2)]))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {tuple(r) for r in d.leaks(documents(texts), benchmark).collect()}
    assert found == expected(texts, items)
    assert len({r[0] for r in found}) > 20


def test_blocks_of_the_benchmark_give_the_same(spark, documents, monkeypatch):
    items = [(k, " ".join(f"a{k}x{q}" for q in range(20))) for k in range(6)]
    docs = documents([f"say {t} now" for _, t in items] + ["nothing here"])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = {tuple(r) for r in d.leaks(docs, benchmark).collect()}
    monkeypatch.setattr(d, "BLOCK_BYTES", 200)
    assert {tuple(r) for r in d.leaks(docs, benchmark).collect()} == whole == {(k, k, 20) for k in range(6)}
    assert sorted(r["doc_id"] for r in d.clean(docs, benchmark).collect()) == [6]


def test_blocks_are_bounded_by_bytes(spark, monkeypatch):
    """One word a line: there are no blanks to count."""
    monkeypatch.setattr(d, "BLOCK_BYTES", 20_000)
    benchmark = spark.createDataFrame([(k, "\n".join(f"w{k}x{q}" for q in range(200))) for k in range(40)], "item_id long, text string")
    assert len(list(d._blocks(benchmark))) >= 3


def test_short_items_and_long_texts(spark, documents):
    """Items of one to four words count where they stand whole; a very long text full of seeds ends in time."""
    benchmark = spark.createDataFrame([(1, "a b c d"), (2, "Word"), (3, "e f"), (4, " ".join(["x"] * 30))], "item_id long, text string").withColumn("doc_id", j_lit(9))
    docs = documents(["say a b c d.", "a b c e f", "a b cd", "word", "w " * 5 + "x " * 30_000, None, ""])
    found = {tuple(r) for r in d.leaks(docs, benchmark).collect()}
    assert found == {(0, 1, 4), (1, 3, 2), (3, 2, 1), (4, 4, 20)}


def test_rows_that_share_an_id_are_judged_each(spark, documents):
    benchmark = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    docs = documents(["one two three four five six", "clean", "clean", "one two three four five six"], ids=[4, 4, None, None])
    assert sorted(str(r["doc_id"]) + r["text"] for r in d.clean(docs, benchmark).collect()) == ["4clean", "Noneclean"]


def test_seeds_stay_in_their_document():
    word, doc = words(*strings(pa.array(["a b c", "d e f g"])), marks=True)
    assert d.seeds(word, doc, np.array([0, 2]))[1].tolist() == [0, 3, 4]


def j_lit(value):
    from pyspark.sql import functions as F

    return F.lit(value)


def test_hard_rows(spark, documents):
    schema = "item_id long, text string"
    item = " ".join(f"i{k}" for k in range(20))
    benchmark = spark.createDataFrame([(1, item), (1, item), (None, item), (2, None), (3, ""), (4, "one two")], schema)
    docs = documents([item, item, None, "", "one two"], ids=[5, 5, 6, 7, 8])
    assert sorted(tuple(r) for r in d.leaks(docs, benchmark).collect()) == [(5, 1, 20), (8, 4, 2)]
    assert d.leaks(docs, spark.createDataFrame([], schema)).count() == 0
    assert d.leaks(docs.where("doc_id < 0"), benchmark).count() == 0
    kept = d.clean(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == 2
