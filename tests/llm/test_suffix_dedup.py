"""Front coding, loser trees, and removed bytes against a dictionary of all strings."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from pedalgrid.llm import suffix_dedup as s
from pedalgrid.llm.common import strings


def expected(rows):
    texts = [(s.NEVER if k is None else k, (t or "").encode()) for k, t in rows]
    first = {}
    for k, b in sorted(texts):
        for at in range(len(b) - 49):
            first.setdefault(b[at : at + 50], k)
    out = []
    for (k, _), (own, b) in zip(rows, texts):
        gone = np.zeros(len(b), bool)
        for at in range(len(b) - 49):
            if first[b[at : at + 50]] < own:
                gone[at : at + 50] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((k, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return sorted(out, key=str)


def found(docs):
    df = s.digest(s.strip(docs))
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def runs_of(seed):
    draw = np.random.default_rng(seed)
    out = []
    for _ in range(draw.integers(1, 9)):
        rows = draw.integers(1, 4, (draw.integers(0, 500), s.WIDTH), dtype=np.uint8)
        rows[:, : draw.integers(0, s.WIDTH - 1)] = 2
        out.append(s.distinct_rows(rows)[0] if len(rows) else rows)
    return out


def coded(runs):
    """What a range receives: the rows and prefixes of each run."""
    return zip(*[s.front_decode(*s.front_code(rows)) for rows in runs])


@pytest.mark.parametrize("seed", range(8))
def test_merge_is_sorted_with_right_prefixes(seed):
    runs = runs_of(seed)
    order, lcp = s.merge_runs(*coded(runs))
    rows = np.concatenate(runs)[order]
    assert sorted(order) == list(range(len(rows)))
    text = [bytes(r) for r in rows]
    assert text == sorted(text)
    for k in range(1, len(rows)):
        unlike = np.flatnonzero(rows[k] != rows[k - 1])
        assert lcp[k] == (unlike[0] if len(unlike) else s.WIDTH)


@pytest.mark.parametrize("seed", range(4))
def test_front_coding_round_trip(seed):
    for rows in runs_of(seed):
        decoded, prefix = s.front_decode(*s.front_code(rows))
        assert (decoded == rows).all()
        assert all((rows[k, : prefix[k]] == rows[k - 1, : prefix[k]]).all() and rows[k, prefix[k]] != rows[k - 1, prefix[k]] for k in range(1, len(rows)))


def test_known_prefixes_are_not_read_again(monkeypatch):
    draw = np.random.default_rng(3)
    runs = []
    for _ in range(6):
        rows = draw.integers(1, 4, (700, s.WIDTH), dtype=np.uint8)
        rows[:, :20] = 2
        runs.append(s.distinct_rows(rows)[0])
    early, plain = [], s._common

    def watched(word, a, b, known):
        early.append(int((known < 20).sum()))
        return plain(word, a, b, known)

    monkeypatch.setattr(s, "_common", watched)
    order, _ = s.merge_runs(*coded(runs))
    lanes = len(order) // s.LANE_ROWS
    # Per lane the first row of each of six runs (a tree of eight leaves has seven matches), and the lane's border.
    assert len(order) > 4000 and sum(early) <= lanes * 8


def test_equal_windows_name_the_same_place():
    draw = random.Random(1)
    part = "".join(draw.choice("abcd ") for _ in range(400))
    a, b = "x" * 77 + part + "yy", "q" + part + "z" * 60
    raw, at = strings(pa.array([a, b, "short"]))
    place, key = s.anchors(raw, at)
    by_seed = {}
    for p, k in zip(place, key):
        assert by_seed.setdefault(bytes(raw[p : p + s.SEED]), k) == k
    assert len(set(key.tolist())) == len(by_seed)
    first, second = 77, len(a) + 1
    inner = lambda start: {p - start for p in place if start + 49 <= p < start + 400 - 49}
    assert inner(first) == inner(second)
    for start in range(400 - 49):
        assert any(first + start <= p <= first + start + s.BEFORE for p in place)


def test_equals_brute_force(documents, prose):
    assert found(documents(prose)) == expected(list(enumerate(prose)))


def test_periodic_texts_and_borders(documents):
    draw = random.Random(4)
    texts = ["".join(draw.choice("ab") for _ in range(draw.randint(0, 40))) * draw.randint(1, 6) for _ in range(80)]
    texts += ["x" * k for k in range(0, 140, 7)] + ["é" * 30, "é" * 60, "q" * 50, "q" * 49, "pq" + "q" * 49]
    draw.shuffle(texts)
    assert found(documents(texts)) == expected(list(enumerate(texts)))


def test_null_and_repeated_ids_and_empty_tables(documents):
    part = "".join(chr(97 + k % 23) for k in range(120))
    rows = [(None, part), (7, part), (7, part + "!"), (3, None), (9, "0" + part), (None, "1" + part)]
    docs = documents([t for _, t in rows], ids=[k for k, _ in rows])
    assert found(docs) == expected(rows)
    assert found(docs.where("doc_id < 0")) == []


def with_edges(n):
    """Texts with one passage, each between other words, so that rows at its edges differ in every document."""
    draw = random.Random(6)
    passage = "This notice must stay with every copy of the text, whole. "
    words = lambda k: "".join(draw.choice("abcdefgh ") for _ in range(k))
    ends = [words(45) for _ in range(20)]
    return [draw.choice(ends)[draw.randint(0, 9) :] + passage + draw.choice(ends) + words(30) for _ in range(n)] + [words(60) + passage * 2 + words(60) for _ in range(n)]


def test_hot_prefix_is_dealt_out(documents):
    texts = with_edges(400)
    borders = s.range_borders(documents(texts), 64)
    table = pa.table({"doc_id": np.arange(len(texts)), "text": texts, "part": pa.array(np.zeros(len(texts)), pa.int32())})
    keys, counts, _ = s._count(table)
    sent = s._send(table, counts, borders)
    rows = [len(s.unpack(x)) for x, k in zip(sent["ids"].to_pylist(), sent["bucket"].to_pylist()) if k <= len(borders)]
    hot = max(np.unique(s.as_text(s.rows_at(*strings(pa.array(texts)), *s._read(table)[2::2])[:, :20]), return_counts=True)[1])
    assert hot >= 800 and sum(rows) > 1000 and max(rows) < hot / 4


def test_windows_across_borders_equal_brute_force(documents):
    texts = with_edges(150) + with_edges(3)
    random.Random(8).shuffle(texts)
    assert found(documents(texts)) == expected(list(enumerate(texts)))
