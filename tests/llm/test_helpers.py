"""Hashes over Arrow batches, packed key counts, components."""

import random

import numpy as np
import pyarrow as pa
import pytest

from pedalgrid.llm import common, key_counts
from pedalgrid.llm.links import components, contracted


def test_strings_of_sliced_and_null_values():
    column = pa.array(["ab", None, "", "é", "xyz"]).slice(1)
    raw, at = common.strings(column)
    assert [bytes(raw[a:b]).decode() for a, b in zip(at[:-1], at[1:])] == ["", "", "é", "xyz"]
    raw, at = common.strings(pa.array([], pa.string()))
    assert len(raw) == 0 and at.tolist() == [0]


def test_steps_cover_every_document_once():
    at = np.cumsum([0, 5, 0, 100, 3, 3, 0])
    found = list(common.steps(at, 8))
    assert [k for a, b in found for k in range(a, b)] == list(range(6))


def test_words_do_not_cross_documents_and_ignore_case():
    raw, at = common.strings(pa.array(["Ab c", "", "ab\tC  ab"]))
    word, doc = common.words(raw, at)
    assert doc.tolist() == [0, 0, 2, 2, 2]
    assert word[0] == word[2] == word[4] and word[1] == word[3] != word[0]
    raw, at = common.strings(pa.array(["one,two"]))
    assert len(common.words(raw, at)[0]) == 1 and len(common.words(raw, at, marks=True)[0]) == 2


def test_shingles_of_short_documents_are_their_whole_sequence():
    raw, at = common.strings(pa.array(["a b", "a b", "a b c", "a b c d", "", "a"]))
    code, doc = common.shingles(*common.words(raw, at), 3)
    by = {d: set(code[doc == d].tolist()) for d in range(6)}
    assert [len(by[d]) for d in range(6)] == [1, 1, 1, 2, 0, 1]
    assert by[0] == by[1] and by[2] < by[3] and by[0] != by[5]


@pytest.mark.parametrize("kind", [np.uint8, np.uint16, np.int64, np.uint64])
def test_packing_round_trip(kind):
    values = np.random.default_rng(1).integers(0, 200, 1000).astype(kind)
    assert (key_counts.unpack(key_counts.pack(values)) == values).all()
    assert len(key_counts.unpack(key_counts.pack(values[:0]))) == 0
    rising = np.sort(np.random.default_rng(2).integers(0, 1 << 63, 500, dtype=np.uint64))
    assert (key_counts.unpack_sorted(key_counts.pack_sorted(rising)) == rising).all()


def test_ranges_hold_all_keys():
    keys = np.sort(np.random.default_rng(3).integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2))
    at = key_counts.ranges_of(keys, 4)
    assert at[0] == 0 and at[-1] == 400 and len(at) == 17
    for k, (a, b) in enumerate(zip(at[:-1], at[1:])):
        assert (keys[a:b] >> np.uint64(60) == k).all()


def test_components_of_chains_stars_and_loops(spark):
    random.seed(5)
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    random.shuffle(edges)
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}, 200: 200, 201: 200}


def test_components_of_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_contracted_ids_are_connected_to_their_parents(spark):
    random.seed(6)
    edges = [(random.randrange(60), random.randrange(60)) for _ in range(45)] + [(100, k) for k in range(101, 130)]
    root = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    found = {r["id"]: r["parent"] for r in contracted(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(root[k] == root[p] and p < k for k, p in found.items())
    assert {found[k] for k in range(101, 130)} == {100}
    assert contracted(spark.createDataFrame([], "a long, b long")).count() == 0
