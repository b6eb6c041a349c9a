"""Stupid-backoff language-model scores: n-gram counts of the whole corpus, joined to each document's n-grams.

The count table is dealt by hash of the n-gram (``key_counts``); every group of documents gets the
counts of its own n-grams back and sums the scores per document. A document is scored by the counts of
all *other* documents: its own n-grams are taken off first, else every n-gram would have been seen and
nothing would back off.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pedalgrid.llm import key_counts
from pedalgrid.llm.common import mixed, words

ORDER = 3
BACKOFF = 0.4
STEP = 1 << 19

_STEP_UP = np.uint64(0x9E3779B97F4A7C15)


def grams(word: np.ndarray, doc: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each n: the hash of the n words that end at each word, and whether they lie in its document."""
    out = [(mixed(word + np.uint64(1)), np.ones(len(word), bool))]
    for n in range(2, order + 1):
        code, whole = np.zeros(len(word), np.uint64), np.zeros(len(word), bool)
        if len(word) >= n:
            total = np.full(len(word) - n + 1, n, np.uint64)
            for k in range(n):
                total = mixed(total * _STEP_UP + word[k : len(word) - n + 1 + k])
            code[n - 1 :] = total
            whole[n - 1 :] = doc[n - 1 :] == doc[: len(word) - n + 1]
        out.append((code, whole))
    return out


def _unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], order[1:] != order[:-1]])) if len(order) else np.zeros(0, np.int64)
    return order[first], np.diff(np.append(first, len(order)))


def _count(texts: pa.Table, order: int) -> tuple[np.ndarray, np.ndarray, int]:
    parts, n = [], 0
    for raw, at, _ in key_counts.in_steps(texts, STEP):
        word, doc = words(raw, at)
        n += len(word)
        parts.append(_unique(np.concatenate([c[w] for c, w in grams(word, doc, order)])))
        if len(parts) == 8:
            parts = [key_counts.merged(parts)]
    return *key_counts.merged(parts), n


def _own_counts(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """How often each entry's key stands in its document."""
    pair = mixed(keys + doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(pair)
    pair = pair[order]
    new = np.ones(len(pair), bool)
    new[1:] = pair[1:] != pair[:-1]
    sizes = np.diff(np.append(np.flatnonzero(new), len(pair)))
    out = np.empty(len(pair), np.int64)
    out[order] = sizes[np.cumsum(new) - 1]
    return out


def _score(texts: pa.Table, totals: np.ndarray, corpus: int, order: int) -> pa.Table:
    keys = _count(texts, order)[0]
    n_words, score = np.zeros(texts.num_rows, np.int64), np.zeros(texts.num_rows)
    for raw, at, rows in key_counts.in_steps(texts, STEP):
        word, doc = words(raw, at)
        if not len(word):
            continue
        length = np.bincount(doc, minlength=len(rows))
        others = (corpus - length)[doc].astype(float)
        counts, before = [], None
        place = np.arange(len(word)) - (np.cumsum(length) - length)[doc]
        for n, (code, whole) in enumerate(grams(word, doc, order), 1):
            seen = np.zeros(len(word), np.int64)
            seen[whole] = totals[np.searchsorted(keys, code[whole])] - _own_counts(code[whole], doc[whole])
            # The context of the n-gram is the (n-1)-gram that ends one word earlier.
            context = others if n == 1 else np.concatenate([[0], before[:-1]])
            counts.append((seen, context))
            before = seen
        # Backing off costs BACKOFF each time; a word that is seen nowhere else counts as once. A
        # document's first words have no longer n-gram: they start at the order they have, at no cost.
        each = np.log(np.maximum(counts[0][0], 1) / np.maximum(others, 1.0))
        for n, (seen, context) in enumerate(counts[1:], 2):
            there = place >= n - 1
            higher = np.where(seen > 0, np.log(np.maximum(seen, 1) / np.maximum(context, 1)), np.log(BACKOFF) + each)
            each = np.where(there, higher, each)
        n_words[rows] = length
        score[rows] = np.bincount(doc, each, minlength=len(rows))
    return pa.table({"doc_id": texts["doc_id"], "n_words": n_words, "log_score": score, "mean_log_score": score / np.maximum(n_words, 1)})


def score(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """``doc_id, n_words, log_score, mean_log_score`` for every row and whole text of ``docs``.

    Words are runs without a blank, A-Z as a-z. A text that is null or has no word has 0 words and
    scores of 0. A repeated row counts for its copies like any other document. Other columns are not read.
    """
    groups = key_counts.group_count(docs)
    return key_counts.with_totals(
        key_counts.dealt(docs, groups),
        groups,
        lambda t: _count(t, order),
        lambda t, totals, corpus: _score(t, totals, corpus, order),
        "doc_id long, n_words long, log_score double, mean_log_score double",
    )
