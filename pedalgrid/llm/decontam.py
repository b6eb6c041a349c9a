"""Benchmark passages in documents, by spaced seeds: word windows hashed with some places left out.

A fixed family of masks says which places of a window count. It is chosen so that any ``WINDOW`` words
of which at most a fifth differ still agree on all places of one mask somewhere. Benchmark windows and
document windows meet on the masks' hashes, and each meeting is verified along its diagonal: the best
``WINDOW`` words (or the whole item, if shorter) must agree in ``SHARE`` of their places.

The benchmark is the stated query set. It goes to the executors in blocks of a bounded number of bytes;
a benchmark of several blocks reads the documents once per block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalgrid.llm.common import mixed, row_by_row, steps, strings, without, words

WINDOW = 20
SHARE = 0.8
#: Least words of an item and the masks it is indexed by: as many words, a fifth of them other ones, still share a
#: seed with it (checked in the tests). Of fewer than five words none may differ: those items are their own seeds.
FAMILIES = (
    (17, ("1101111", "1110111", "1100010111")),
    (11, ("10111", "1111")),
    (8, ("111", "1101")),
    (5, ("11", "101")),
    (4, ("1111",)),
    (3, ("111",)),
    (2, ("11",)),
    (1, ("1",)),
)
#: Bytes of benchmark text in a block, which bound its words; at least one item.
BLOCK_BYTES = 4 << 20
#: Places that are compared at once.
CELLS = 1 << 20
_BITS = 20


def _mask(text: str) -> np.ndarray:
    return np.flatnonzero(np.array(list(text)) == "1")


def seeds(word: np.ndarray, doc: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of each window of the mask that lies in one document."""
    span = int(places[-1]) + 1
    n = len(word) - span + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.full(n, len(places) * 1_000_003 + span, np.uint64)
    for p in places:
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + word[p : p + n])
    whole = np.flatnonzero(doc[span - 1 :] == doc[:n])
    return total[whole], whole


@dataclass
class Block:
    item: np.ndarray  # id of each item
    at: np.ndarray  # borders of the items in ``word``
    word: np.ndarray
    masks: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # places, sorted hashes, first words, filter bits


def block(ids: list[int], texts: list[str]) -> Block:
    raw, at = strings(pa.array(texts, pa.large_string()))
    word, doc = words(raw, at, marks=True)
    counts = np.bincount(doc, minlength=len(ids))
    borders = np.concatenate([[0], np.cumsum(counts)])
    masks, most = [], np.inf
    for least, family in FAMILIES:
        for places in map(_mask, family):
            code, first = seeds(word, doc, places)
            size = counts[doc[first]]
            wanted = (size >= least) & (size < most)
            order = np.argsort(code[wanted], kind="stable")
            code, first = code[wanted][order], first[wanted][order]
            bits = np.zeros(1 << _BITS, bool)
            bits[(code >> np.uint64(64 - _BITS)).astype(np.int64)] = True
            if len(code):
                masks.append((places, code, first, bits))
        most = least
    return Block(np.array(ids), borders, word, masks)


def _diagonals(found: Block, word: np.ndarray, doc: np.ndarray) -> Iterator[np.ndarray]:
    """Rows ``item, first document word`` where an item laid over a document shares a seed with it."""
    owner = np.searchsorted(found.at, np.arange(len(found.word)), "right") - 1
    for places, code, first, bits in found.masks:
        here, start = seeds(word, doc, places)
        near = np.flatnonzero(bits[(here >> np.uint64(64 - _BITS)).astype(np.int64)])
        here, start = here[near], start[near]
        low, high = np.searchsorted(code, here, "left"), np.searchsorted(code, here, "right")
        hit = np.flatnonzero(high > low)
        count = (high - low)[hit]
        # A seed that many items share is expanded in slices of a bounded number of pairs.
        cut = np.searchsorted(np.cumsum(count), np.arange(0, count.sum() + 1, 1 << 20), "left")
        for a, b in zip(cut, [*cut[1:], len(hit)]):
            if a >= b:
                continue
            n = count[a:b]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[hit[a:b]], n)
            mine = first[at]
            item = owner[mine]
            yield np.unique(np.stack([item, np.repeat(start[hit[a:b]], n) - (mine - found.at[item]), doc[np.repeat(start[hit[a:b]], n)]], axis=1), axis=0)


def overlaps(found: Block, word: np.ndarray, doc: np.ndarray) -> dict[tuple[int, int], int]:
    """Most equal words in a window, by document and item, of those that reach the share."""
    best: dict[tuple[int, int], int] = {}
    n = len(word)
    for rows in _diagonals(found, word, doc):
        length = np.diff(found.at)[rows[:, 0]]
        for m in np.unique(length).tolist():
            same = rows[length == m]
            size = min(m, WINDOW)
            for first in range(0, len(same), max(1, CELLS // m)):
                item, start, own = same[first : first + max(1, CELLS // m)].T
                at = start[:, None] + np.arange(m)
                inside = (at >= 0) & (at < n)
                at = np.clip(at, 0, n - 1)
                equal = inside & (word[at] == found.word[found.at[item][:, None] + np.arange(m)]) & (doc[at] == own[:, None])
                sums = np.zeros((len(item), m + 1), np.int64)
                np.cumsum(equal, axis=1, out=sums[:, 1:])
                most = (sums[:, size:] - sums[:, :-size]).max(axis=1)
                for k in np.flatnonzero(most >= math.ceil(SHARE * size)).tolist():
                    key = int(own[k]), int(item[k])
                    best[key] = max(best.get(key, 0), int(most[k]))
    return best


def _scan(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    found = shared.value
    for batch in batches:
        raw, at = strings(batch["text"])
        for a, b in steps(at):
            word, doc = words(raw[at[a] : at[b]], at[a : b + 1] - at[a], marks=True)
            rows = sorted((own, item, n) for (own, item), n in overlaps(found, word, doc).items())
            if rows:
                own, item, most = map(np.array, zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(a, b - a).take(pa.array(own)), pa.array(found.item[item]), pa.array(most)],
                    ["doc_id", "item_id", "n_equal"],
                )


def _blocks(benchmark: DataFrame) -> Iterator[Block]:
    ids: list[int] = []
    texts: list[str] = []
    size = 0
    items = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    for row in items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        n = len(row[1].encode())
        if ids and size + n > BLOCK_BYTES:
            yield block(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(row[0])
        texts.append(row[1])
        size += n
    yield block(ids, texts)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, n_equal`` for each document that holds a benchmark item or ``WINDOW`` words of it.

    Words are runs of letters, digits and bytes beyond ASCII, A-Z as a-z. Null texts, empty texts and
    items without words match nothing; an item of one to four words matches where it stands whole. Items without an id are left out. Rows
    that repeat are reported once. ``n_equal`` is the number of equal words in the best window.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    layout = f"doc_id {dict(docs.dtypes)['doc_id']}, item_id long, n_equal long"
    parts = None
    for one in _blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(one)
        part = rows.mapInArrow(lambda b, s=shared: _scan(b, s), layout)
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("doc_id", "item_id").agg(F.max("n_equal").alias("n_equal"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; rows that share an id or have none are judged each."""
    return row_by_row(docs, lambda rows: without(rows, leaks(rows, benchmark)))
