"""Minimal perfect hash, and exact duplicates against grouping in memory."""

import hashlib
import re

import numpy as np
import pytest

from pedalgrid.llm import exact_dedup as e


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows, early=()):
    groups = {}
    for k, t in rows:
        groups.setdefault(normal(t), []).append(k)
    out = []
    for k, t in rows:
        same = groups[normal(t)]
        known = [x for x in same if x is not None and x in early]
        ids = known or [x for x in same if x is not None]
        keep = min(ids) if ids else None
        out.append((k, keep, len(same), k == keep, hashlib.sha256(normal(t).encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_hash_is_minimal_and_perfect(n):
    keys = np.random.default_rng(n).integers(0, 256, (n, 32)).astype(np.uint8)
    levels, slots = e.build_levels(keys)
    assert sorted(slots) == list(range(n))
    assert (e.find_slots(levels, keys) == slots).all()


def test_strangers_fall_through_or_fail_the_byte_check():
    digest = np.random.default_rng(1).integers(0, 256, (200, 32)).astype(np.uint8)
    levels, _ = e.build_levels(digest[:100])
    slots = e.find_slots(levels, digest[100:])
    assert (slots < 100).all()


def test_equal_digests_fail_and_nearly_equal_ones_part():
    digest = np.zeros((300, 32), np.uint8)
    digest[:, 7] = np.arange(300) % 256
    digest[:, 31] = np.arange(300) // 256
    levels, slots = e.build_levels(digest)
    assert sorted(slots) == list(range(300)) and (e.find_slots(levels, digest) == slots).all()
    with pytest.raises(ValueError, match="equal digests"):
        e.build_levels(digest[[5, 5, 9]])


def test_unique_keeps_each_text_once(documents):
    rows = [(3, "A"), (5, "A"), (5, "B"), (7, "C"), (7, "C"), (None, "D"), (None, "D"), (None, "B"), (8, None), (9, "")]
    docs = documents([t for _, t in rows], ids=[k for k, _ in rows])
    kept = e.unique(docs)
    assert kept.columns == docs.columns
    got = sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect())
    assert got == [("3", "A"), ("5", "B"), ("7", "C"), ("8", "None"), ("None", "D")]


def test_equals_grouping(documents, prose):
    docs = documents(prose)
    early, late = e.halves(docs)
    assert found(e.decide(late, early)) == expected(list(enumerate(prose)))
    assert found(e.decide(docs)) == expected(list(enumerate(prose)))


def test_history_wins_over_smaller_ids(documents):
    old, new = documents(["a  b", "c"], ids=[50, 51]), documents(["a b", "c", "d", "d"], ids=[1, 2, 3, 4])
    rows = [(50, "a  b"), (51, "c"), (1, "a b"), (2, "c"), (3, "d"), (4, "d")]
    assert found(e.decide(new, old)) == expected(rows, early={50, 51})


def test_null_and_repeated_ids(documents):
    rows = [(None, "a"), (None, "b"), (5, "a"), (5, "a"), (None, None), (6, "")]
    docs = documents([t for _, t in rows], ids=[k for k, _ in rows])
    assert [r[:3] for r in found(e.decide(docs))] == [r[:3] for r in expected(rows)]
    early, late = e.halves(docs)
    assert [r[:3] for r in found(e.decide(late, early))] == [r[:3] for r in expected(rows)]


def test_empty_tables(documents):
    none = documents(["x"]).where("doc_id < 0")
    assert found(e.decide(none, none)) == []
    assert e.unique(none).count() == 0
    assert [r[:4] for r in found(e.decide(documents(["x"]), none))] == [(0, 0, 1, True)]


def test_unique_keeps_columns_and_rows(documents, prose):
    docs = documents(prose)
    kept = e.unique(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({r[1] for r in expected(list(enumerate(prose)))})


def test_shards_follow_the_larger_side_and_halves_the_median(documents, monkeypatch):
    docs = documents([f"t{k}" for k in range(100)], ids=[-(10**12), *range(1, 100)])
    early, late = e.halves(docs)
    assert 40 <= early.count() <= 60 and early.count() + late.count() == 100
    monkeypatch.setattr(e, "SHARD_KEYS", 1)
    few, many = docs.limit(1), docs
    assert e.shard_count(few, many) == e.shard_count(many, few) == 100
