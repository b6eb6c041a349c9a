"""Blocked products, and components against all pairs in memory."""

import itertools
import random
import re

import numpy as np
import pytest

from pedalgrid.llm import ngram_jaccard as j


def shingle_set(text, size):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def expected(rows, size, percent):
    sets = [(k, shingle_set(t, size)) for k, t in rows]
    root = {k: k for k, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return sorted((k, len(s), find(k)) for k, s in sets)


def found(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect())


def test_block_overlaps():
    draw = np.random.default_rng(4)
    a, b = ([np.unique(draw.integers(0, 60, 30)) for _ in range(n)] for n in (5, 7))
    table = j.block_overlaps(a, b)
    assert table.tolist() == [[len(np.intersect1d(x, y)) for y in b] for x in a]
    assert j.block_overlaps([a[0][:0]], b).tolist() == [[0] * 7]


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80)])
def test_equals_all_pairs(documents, prose, size, percent):
    assert found(j.cluster(documents(prose), size, percent)) == expected(list(enumerate(prose)), size, percent)


def test_star_of_near_copies_whose_rays_do_not_link(documents):
    """Each copy differs elsewhere: copies link with the base, not with each other."""
    draw = random.Random(2)
    base = [f"w{draw.randrange(10**6)}" for _ in range(60)]
    texts = []
    for k in range(25):
        words = list(base)
        words[2 * k + 3] = f"other{k}"
        texts.append(" ".join(words))
    texts.append(" ".join(base))
    texts += [" ".join(base[:30] + [f"n{k}x{i}" for i in range(30)]) for k in range(10)]
    assert found(j.cluster(documents(texts), 3, 90)) == expected(list(enumerate(texts)), 3, 90)


def test_documents_that_share_all_rare_words_but_are_unlike(documents):
    draw = random.Random(3)
    common = [f"c{k}" for k in range(12)]
    texts = [" ".join(draw.sample(common, 8)) for _ in range(80)] + [" ".join(common[:k]) for k in range(1, 12)]
    assert found(j.cluster(documents(texts), 3, 80)) == expected(list(enumerate(texts)), 3, 80)


def test_unlinked_documents_that_share_a_header_make_no_pairs(documents, monkeypatch):
    """Short texts of few words, none of which link: what they share is split until next to nothing is paired."""
    draw = random.Random(11)
    header = " ".join(f"h{k}" for k in range(8))
    texts = sorted({f"{header} " + " ".join(draw.choice("abcdefghijkl") for _ in range(draw.choice([9, 10, 11]))) for _ in range(900)})
    pairs, stage = [], j.staged

    def counted(df, name):
        out = stage(df, name)
        if name == "pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(j, "staged", counted)
    assert found(j.cluster(documents(texts), 5, 80)) == expected(list(enumerate(texts)), 5, 80)
    assert sum(pairs) < 30 * len(texts)


def test_copies_with_many_changes_are_not_split_column_by_column(documents, monkeypatch):
    """Copies of one text with one to four changes: some link, most do not, and all share most columns."""
    draw = random.Random(21)
    base = [f"b{k}" for k in range(90)]
    texts = []
    for k in range(260):
        words = list(base)
        for at in draw.sample(range(90), draw.choice([1, 2, 3, 4])):
            words[at] = draw.choice(["x", "y", f"n{k}"])
        texts.append(" ".join(words[: draw.choice([70, 88, 90, 90])]))
    texts = sorted(set(texts))
    tables, stage = [], j.staged

    def counted(df, name):
        out = stage(df, name)
        tables.append((name, out.count() if name in ("pairs", "entries") else 0))
        return out

    monkeypatch.setattr(j, "staged", counted)
    assert found(j.cluster(documents(texts), 5, 80)) == expected(list(enumerate(texts)), 5, 80)
    assert sum(n for name, n in tables if name == "pairs") < 30 * len(texts)
    entries = [n for name, n in tables if name == "entries"]
    assert max(entries) == entries[0] and sum(name == "split" for name, _ in tables) <= 2


def test_split_columns_lose_no_link(documents, monkeypatch):
    """Every column is split at once and again: links between unlike groups of one column stay."""
    monkeypatch.setattr(j, "ROUNDS", 1)
    monkeypatch.setattr(j, "SMALL", 2)
    monkeypatch.setattr(j, "_width", lambda percent: j.F.lit(0))
    draw = random.Random(12)
    common = [f"c{k}" for k in range(14)]
    texts = []
    for _ in range(15):
        words = draw.sample(common, 11)
        texts.append(" ".join(words))
        words[draw.randrange(11)] = draw.choice(common)
        texts.append(" ".join(words))
        texts.append(" ".join(words + [draw.choice(common)]))
    for size, percent in ((1, 80),):
        assert found(j.cluster(documents(texts), size, percent)) == expected(list(enumerate(texts)), size, percent)


def test_representatives_keep_one_row_of_each_text(documents):
    texts = ["a b c d e f", "a b c d e f", "q r s t u v w", "A b c d e f", "q r s t u v w", None, ""]
    docs = documents(texts, ids=[3, 5, 5, 7, None, 3, 3])
    kept = sorted((str(r["doc_id"]), str(r["text"])) for r in j.representatives(docs).collect())
    assert kept == [("3", ""), ("3", "None"), ("3", "a b c d e f"), ("5", "q r s t u v w")]


def test_nulls_repeats_and_empty_tables(documents):
    rows = [(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (9, "A b\tc d"), (5, None), (6, "")]
    docs = documents([t for _, t in rows], ids=[k for k, _ in rows])
    got = j.cluster(docs).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None) == [(4, 2, 4), (4, 2, 4), (5, 0, 5), (6, 0, 6), (9, 2, 4)]
    assert [(r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is None] == [(2, None)]
    assert found(j.cluster(docs.where("doc_id < 0"))) == []
    kept = j.representatives(docs)
    assert kept.columns == docs.columns and 9 not in [r["doc_id"] for r in kept.collect()]
