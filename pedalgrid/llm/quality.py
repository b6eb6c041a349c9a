"""Quality by random Fourier features of document statistics, ridge regression and isotonic calibration.

Statistics of all texts are computed once and written. The fit sums normal equations in each
partition, then in groups of partitions, so only matrices of a fixed size reach the driver. The
calibration pools raw scores in bins of a fixed width and fits a monotone step to the bins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalgrid.llm.common import GIVEN, held_out, mixed, row_by_row, shingles, steps, strings, without, words
from pedalgrid.session import staged

FEATURES = 384
WIDTH = 0.12
RIDGE = 1e-3
SEED = 11
THRESHOLD = 0.7
BIN = 1e-3
#: Groups of partitions whose sums reach the driver, at most.
GROUPS = 64

STATS = (
    "bytes words word_mean word_dev letters digits upper stops symbols blanks lines distinct_words "
    "distinct_shingles line_words repeated_lines short_words capitals odd_ends other"
).split()


def _kinds() -> np.ndarray:
    """Byte to kind: 0 letter, 1 digit, 2 upper case, 3 sentence mark, 4 symbol, 5 blank, 6 line end, 7 control."""
    kind = np.full(256, 4, np.uint8)
    kind[:32] = 7
    kind[97:123] = 0
    kind[128:] = 0
    kind[48:58] = 1
    kind[65:91] = 2
    kind[[ord(c) for c in ".,;:!?'\"()-"]] = 3
    kind[[9, 11, 12, 13, 32]] = 5
    kind[10] = 6
    return kind


_KIND = _kinds()


def _distinct(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct values of each document."""
    pair = mixed(values + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(pair, return_index=True)
    return np.bincount(doc[first], minlength=n)


def statistics(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of ``STATS`` per document; all zero for an empty text."""
    n, size = len(at) - 1, np.diff(at)
    owner = np.repeat(np.arange(n), size)
    kind = _KIND[raw]
    share = np.stack([np.bincount(owner[kind == k], minlength=n) for k in range(8)], axis=1) / np.maximum(size, 1)[:, None]
    inner = (kind < 5) | (kind == 7)
    start = inner.copy()
    start[1:] &= ~inner[:-1]
    cut = at[:-1][at[:-1] < len(raw)]
    start[cut] = inner[cut]
    first = np.flatnonzero(start)
    stop = inner.copy()
    stop[:-1] &= ~inner[1:] | start[1:]
    last = np.flatnonzero(stop)
    doc = owner[first]
    length = last - first + 1.0
    n_words = np.bincount(doc, minlength=n)
    safe = np.maximum(n_words, 1)
    mean = np.bincount(doc, length, minlength=n) / safe
    dev = np.sqrt(np.maximum(0, np.bincount(doc, length**2, minlength=n) / safe - mean**2))
    word, word_doc = words(raw, at)
    shingle, shingle_doc = shingles(word, word_doc, 3)
    n_shingles = np.bincount(shingle_doc, minlength=n)
    # Lines: each newline ends one, and so does the end of a text that has none there.
    stops = np.unique(np.concatenate([np.flatnonzero(raw == 10) + 1, at[1:][size > 0]]))
    starts = np.concatenate([[0], stops[:-1]])
    line_doc = np.searchsorted(at, stops - 1, "right") - 1
    word_line = np.searchsorted(stops, first, "right")
    line_hash = np.zeros(len(stops) + 1, np.uint64)
    np.add.at(line_hash, word_line, mixed(word + (first - starts[np.minimum(word_line, len(stops) - 1)]).astype(np.uint64)) if len(stops) else word)
    n_lines = np.bincount(line_doc, minlength=n) if len(stops) else np.zeros(n)
    unlike = _distinct(line_hash[: len(stops)], line_doc, n) if len(stops) else np.zeros(n)
    return np.stack(
        [
            np.log1p(size),
            np.log1p(n_words),
            mean,
            dev,
            share[:, 0],
            share[:, 1],
            share[:, 2],
            share[:, 3],
            share[:, 4],
            share[:, 5],
            share[:, 6],
            _distinct(word, word_doc, n) / safe,
            _distinct(shingle, shingle_doc, n) / np.maximum(n_shingles, 1),
            np.log1p(n_words / np.maximum(n_lines, 1)),
            (n_lines - unlike) / np.maximum(n_lines, 1),
            np.bincount(doc[length <= 3], minlength=n) / safe,
            np.bincount(doc[kind[first] == 2], minlength=n) / safe,
            np.bincount(doc[kind[last] == 4], minlength=n) / safe,
            share[:, 7],
        ],
        axis=1,
    )


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = strings(batch["text"])
        for a, b in steps(at):
            rows = statistics(raw[at[a] : at[b]], at[a : b + 1] - at[a])
            yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), *map(pa.array, rows.T)], ["doc_id", *STATS])


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``STATS`` of every whole text; null is empty. Other columns are not read."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_measure, f"doc_id {dict(docs.dtypes)['doc_id']}, " + ", ".join(f"{s} double" for s in STATS))


@dataclass
class Model:
    mean: np.ndarray
    dev: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, rows: np.ndarray) -> np.ndarray:
        """Random Fourier features of the standardised statistics, the statistics themselves, and a constant."""
        draw = np.random.default_rng(SEED)
        turn = draw.normal(0, np.sqrt(2 * WIDTH), (len(STATS), FEATURES))
        phase = draw.uniform(0, 2 * np.pi, FEATURES)
        x = np.clip((rows - self.mean) / self.dev, -6, 6)
        return np.hstack([np.cos(x @ turn + phase) * np.sqrt(2 / FEATURES), 0.1 * x, np.ones((len(x), 1))])

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return np.clip(self.features(rows) @ self.weights, -0.5, 1.5)

    def score(self, rows: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(rows), self.knots, self.levels)


def _sums(frames: Iterator[pd.DataFrame], model: Model) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    total, n = None, 0
    for frame in frames:
        if len(frame):
            z = model.features(frame[STATS].to_numpy(float))
            z = np.hstack([z, frame[["y"]].to_numpy(float)])
            total = z.T @ z if total is None else total + z.T @ z
    if total is not None:
        yield pd.DataFrame([{"part": TaskContext.get().partitionId() % GROUPS, "sums": total.tobytes()}])


def _add(frame: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x) for x in frame["sums"])
    return pd.DataFrame([{"part": frame["part"].iloc[0], "sums": total.tobytes()}])


def pooled(score: np.ndarray, positive: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression by pooling neighbours that fall: mean score and level of each block, both rising."""
    blocks: list[list[float]] = []
    for s, p, c in sorted(zip(score, positive, count)):
        blocks.append([s * c, p, c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            top = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], top)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def train(rows: DataFrame) -> Model | None:
    """Fit on all of ``rows``: ``STATS`` and ``y`` of 0 or 1. ``None`` without rows."""
    first = rows.agg(F.count(F.lit(1)).alias("n"), *[f(s).alias(f"{s}_{k}") for s in STATS for k, f in (("m", F.avg), ("d", F.stddev_pop))]).first()
    if not first["n"]:
        return None
    mean = np.array([first[f"{s}_m"] for s in STATS])
    dev = np.array([first[f"{s}_d"] for s in STATS])
    model = Model(mean, np.where(dev > 1e-9, dev, 1), np.zeros(0), np.zeros(1), np.zeros(1))
    parts = rows.mapInPandas(lambda f: _sums(f, model), "part int, sums binary")
    total = sum(np.frombuffer(r["sums"]) for r in parts.groupBy("part").applyInPandas(_add, "part int, sums binary").collect())
    total = total.reshape(int(np.sqrt(len(total))), -1)
    gram, right = total[:-1, :-1], total[:-1, -1]
    model.weights = np.linalg.solve(gram + RIDGE * first["n"] / FEATURES * np.eye(len(gram)), right)
    scored = rows.mapInPandas(
        lambda f: (pd.DataFrame({"s": np.round(model.raw(x[STATS].to_numpy(float)) / BIN).astype(int), "y": x["y"].to_numpy(float)}) for x in f),
        "s int, y double",
    )
    bins = scored.groupBy("s").agg(F.sum("y").alias("p"), F.count(F.lit(1)).alias("n")).collect()
    model.knots, model.levels = pooled(np.array([r["s"] * BIN for r in bins]), np.array([r["p"] for r in bins]), np.array([float(r["n"]) for r in bins]))
    return model


def _score(frames: Iterator[pd.DataFrame], model: Model | None) -> Iterator[pd.DataFrame]:
    for frame in frames:
        score = model.score(frame[STATS].to_numpy(float)) if model is not None and len(frame) else np.full(len(frame), 0.5)
        yield pd.DataFrame({"doc_id": frame["doc_id"], "score": score, "predicted": (score >= THRESHOLD).astype(np.int32)})


def _usable(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("_id"), F.col("quality").cast("double").alias("y"))


def _classified(docs: DataFrame, known: DataFrame) -> tuple[DataFrame, bool]:
    """``classify`` with labels ``_id, y``, and whether there were any for these documents."""
    stats = staged(measure(docs), "statistics")
    model = train(stats.join(known, stats["doc_id"] == known["_id"]).select("y", *STATS))
    scored = stats.mapInPandas(lambda f: _score(f, model), f"doc_id {dict(stats.dtypes)['doc_id']}, score double, predicted int")
    return scored.withColumn("held_out", held_out(F.col("doc_id"))), model is not None


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``; learned from labelled rows that are not held out.

    Null texts are empty; an empty text has all statistics 0 and is scored like any other. Labels
    that are null are left out, repeated ones count each. Without usable labels every score is 0.5.
    """
    return _classified(docs, _usable(labels))[0]


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the classifier rejects; without usable labels it rejects none.

    Rows that share an id or have none are judged each by its own text.
    """
    usable = _usable(labels)

    def keep(rows: DataFrame) -> DataFrame:
        known = usable
        if GIVEN in rows.columns:
            known = rows.select("doc_id", GIVEN).join(usable, F.col(GIVEN) == F.col("_id")).select(F.col("doc_id").alias("_id"), "y")
        found, learned = _classified(rows, known)
        return without(rows, found.where(F.col("predicted") == 0)) if learned else rows

    return row_by_row(docs, keep)
