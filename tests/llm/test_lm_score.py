"""Scores against counting in memory."""

import collections
import math
import re

import pytest

from pedalgrid.llm import lm_score


def expected(rows, order=3):
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    words = [re.findall(r"[^\x20\x09-\x0D]+", lower(t)) for _, t in rows]
    own = [collections.Counter(tuple(w[k : k + n]) for n in range(1, order + 1) for k in range(len(w) - n + 1)) for w in words]
    total, n_words = sum(own, collections.Counter()), sum(map(len, words))
    out = []
    for (k, _), w, mine in zip(rows, words, own):
        score = 0.0
        for i in range(len(w)):
            best = math.log(max(total[w[i],] - mine[w[i],], 1) / max(n_words - len(w), 1))
            for n in range(2, min(order, i + 1) + 1):
                gram = tuple(w[i - n + 1 : i + 1])
                seen = total[gram] - mine[gram]
                best = math.log(seen / max(total[gram[:-1]] - mine[gram[:-1]], 1)) if seen else math.log(0.4) + best
            score += best
        out.append((k, len(w), score))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_counting(documents, prose, order):
    rows = list(enumerate(prose))
    found = {r["doc_id"]: r for r in lm_score.score(documents(prose), order).collect()}
    assert len(found) == len(rows)
    for k, n, score in expected(rows, order):
        assert found[k]["n_words"] == n
        assert found[k]["log_score"] == pytest.approx(score, rel=1e-9, abs=1e-9)


def test_null_and_repeated_ids_and_empty_tables(documents):
    docs = documents(["a b c", "a b c", None, "a b c"], ids=[1, 1, 2, None])
    scores = [r["log_score"] for r in lm_score.score(docs).collect() if r["n_words"]]
    assert len(scores) == 3 and len(set(scores)) == 1
    assert lm_score.score(docs.where("doc_id < 0")).count() == 0
