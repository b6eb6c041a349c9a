"""Vector codes against a plain search with Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from pedalgrid.llm import vector_codes as vc

LAYOUT = "vec_id long, embedding array<float>, label int, part int, entry int, digit long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], LAYOUT)


def plain(rows, parts=8, entries=16, rounds=6):
    """The contract, entry by entry."""
    usable = [(i, v, l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    usable.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not usable:
        return []
    dim = len(usable[0][1])
    usable = [r for r in usable if len(r[1]) == dim]
    at = vc.cuts(dim, parts)
    ints = [[math.floor(4096 * float(np.float32(x))) for x in v] for _, v, _ in usable]
    books = [[v[a:b] for v in ints[:entries]] for a, b in at]

    def assign(v):
        out = []
        for (a, b), book in zip(at, books):
            d = [sum((x - y) ** 2 for x, y in zip(v[a:b], e)) for e in book]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        codes = [assign(v) for v in ints]
        new = []
        for p, ((a, b), book) in enumerate(zip(at, books)):
            grown = []
            for e, entry in enumerate(book):
                own = [v[a:b] for v, c in zip(ints, codes) if c[p][0] == e]
                grown.append([sum(x) // len(own) for x in zip(*own)] if own else entry)
            new.append(grown)
        books = new
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    out = [(r[0], "".join(f"{i:02x}" for i, _ in c), sum(d for _, d in c), r[2]) for r, c in ((r, assign(v)) for r, v in zip(usable, ints))]
    per = {}
    for _, _, e, l in out:
        per[l] = per.get(l, 0) + e
    top = 2**63 - 1
    return sorted((str(i), c, min(e, top), min(per[l], top), sha) for i, c, e, l in out)


def ours(df):
    return sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in df.collect())


def some_rows(n, dim, seed=3, spread=0.3):
    draw = random.Random(seed)
    rows = []
    for k in range(n):
        v = [float(np.float32(draw.gauss(0, spread))) for _ in range(dim)]
        rows.append((k * 3, v, draw.choice([None, 1, 1, 1, 2])))
    return rows


def test_equals_plain_search(spark):
    rows = some_rows(300, 16)
    rows += [(1000 + k, rows[5][1], 1) for k in range(150)]  # copies of one vector
    rows += [(1, rows[7][1], 2), (4, rows[7][1], None)]  # equal entries from the start: ties
    rows += [(2000, None, 1), (2001, [None] + rows[0][1][1:], 1), (2002, [float("nan")] + rows[0][1][1:], 1), (2003, [float("inf")] * 16, 2), (2004, [0.5] * 15, 1), (2005, [], 1)]
    assert ours(vc.compress(frame(spark, rows))) == plain(rows)


@pytest.mark.parametrize("dim,n", [(8, 40), (5, 30), (20, 7), (0, 3), (64, 17)])
def test_lengths_and_few_rows(spark, dim, n):
    rows = some_rows(n, dim, seed=dim)
    assert ours(vc.compress(frame(spark, rows))) == plain(rows)


def test_large_numbers_stay_exact(spark):
    rows = some_rows(40, 8, seed=1, spread=1e6) + [(500 + k, [float(np.float32(3e38 * (-1) ** k))] + [float(k)] * 7, 5) for k in range(4)]
    assert ours(vc.compress(frame(spark, rows))) == plain(rows)


def test_null_and_repeated_ids(spark):
    rows = some_rows(30, 8, seed=2)
    rows += [(None, [0.25] * 8, 1), (None, [0.5] * 8, 1), (0, [0.125] * 8, 2), rows[0], rows[0]]
    assert ours(vc.compress(frame(spark, rows))) == plain(rows)


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert vc.compress(empty).collect() == []
    assert vc.compress(frame(spark, [(1, None, 1), (2, [None], 1)])).collect() == []
    assert [f.name for f in vc.compress(empty).schema] == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_search_looks_at_few_entries_and_finds_the_first_of_equals():
    draw = np.random.default_rng(5)
    book = draw.integers(-50, 50, (64, 4))
    book[40] = book[3]
    vectors = draw.integers(-60, 60, (500, 4))
    vectors[0] = book[40]
    index, best = vc.nearest(vectors, book)
    full = ((vectors[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (index == full.argmin(axis=1)).all() and (best == full.min(axis=1)).all() and index[0] == 3


def test_sums_of_any_size_survive_their_digits():
    for value in (0, 1, -1, 2**32, -(2**32) - 1, 10**60, -(10**60) + 7):
        digits = list(vc._limbs(value))
        assert sum(d << (vc.LIMB_BITS * place) for place, d in digits) == value
        assert all(0 <= d < 2**32 for _, d in digits[:-1]) and abs(digits[-1][1]) <= 2**32
