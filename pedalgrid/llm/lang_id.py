"""Language by string kernel: blended-spectrum presence kernel, Nystrom landmarks, ridge regression.

Two texts are alike as far as they share distinct byte n-grams of one to three bytes: the kernel is the
number of shared n-grams over the root of the product of both numbers. A bounded sample of training
texts gives landmarks and a fit; every text is then scored by its kernel values against the landmarks,
computed for batches of texts as one matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalgrid.llm.common import held_out, strings

#: Training texts that the fit may use, of all languages together, and landmarks among them.
SAMPLE = 1_600
LANDMARKS = 160
#: The hash range that training rows are picked from, and rows of a language that are picked beyond twice its share,
#: so that no language comes out short by chance.
COARSE = FINE = 1_000_000
SPARE = 40
RIDGE = 1e-3
SHARPNESS = 8.0
BATCH = 256
UNKNOWN = "und"
_CODES = 256 + (1 << 16) + (1 << 24)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_state: dict = {}


def _grams(raw: np.ndarray) -> np.ndarray:
    """Codes of all n-grams of one to three bytes, repeats included."""
    one = _LOWER[raw].astype(np.uint32)
    two = (one[:-1] << 8) | one[1:]
    three = (two[:-1] << 8) | one[2:]
    return np.concatenate([one, two + np.uint32(256), three + np.uint32(256 + (1 << 16))])


def _distinct(codes: np.ndarray) -> np.ndarray:
    """The distinct codes: the last writer of each place in a table wins."""
    if "last" not in _state:
        _state["last"] = np.zeros(_CODES, np.int32)
    turn, last = np.arange(len(codes), dtype=np.int32), _state["last"]
    last[codes] = turn
    return codes[last[codes] == turn]


@dataclass
class Model:
    langs: list[str]
    grams: np.ndarray  # codes that any landmark has
    incidence: np.ndarray  # grams by landmarks, each column over the root of its landmark's size
    weights: np.ndarray  # landmarks by languages: Nystrom map and ridge weights in one
    key: int

    def lookup(self) -> np.ndarray:
        """Place of each code among ``grams``, 0 for none."""
        if _state.get("key") != self.key:
            table = np.zeros(_CODES, np.int32)
            table[self.grams] = np.arange(1, len(self.grams) + 1)
            _state.update(key=self.key, lookup=table)
        return _state["lookup"]

    def kernel(self, texts: list[np.ndarray]) -> np.ndarray:
        """Kernel values of each text with each landmark."""
        table, present = self.lookup(), np.zeros((len(texts), len(self.grams) + 1), np.float32)
        size = np.ones(len(texts), np.float32)
        for row, raw in enumerate(texts):
            codes = _distinct(_grams(raw))
            present[row, table[codes]] = 1
            size[row] = max(1, len(codes))
        return (present[:, 1:] @ self.incidence) / np.sqrt(size)[:, None]

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        return self.kernel(texts) @ self.weights


def fit(sets: list[np.ndarray], langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """One-versus-rest ridge regression on Nystrom features of texts given as sets of codes.

    ``landmarks`` are taken in turn from the languages, so that a frequent one does not take them all.
    """
    names = sorted(set(langs))
    queues = [[k for k, x in enumerate(langs) if x == name] for name in names]
    order = [q[i] for i in range(max(map(len, queues))) for q in queues if i < len(q)][:landmarks]
    grams = np.unique(np.concatenate([sets[k] for k in order]))

    def rows(which):
        out = np.zeros((len(which), len(grams)), np.float32)
        for row, k in enumerate(which):
            at = np.minimum(np.searchsorted(grams, sets[k]), len(grams) - 1)
            out[row, at[grams[at] == sets[k]]] = 1
            out[row] /= np.sqrt(max(1, len(sets[k])))
        return out

    incidence = rows(order).T
    among = (incidence.T @ incidence).astype(float)
    value, vector = np.linalg.eigh(among)
    keep = value > 1e-6 * value.max()
    root = vector[:, keep] / np.sqrt(value[keep])
    features = np.concatenate([rows(range(a, min(a + 256, len(sets)))) @ incidence for a in range(0, len(sets), 256)]).astype(float) @ root
    target = np.where(np.array(langs)[:, None] == np.array(names)[None, :], 1.0, 0.0)
    # Every language weighs the same, however many texts it has.
    weight = (1 / target.sum(axis=0))[np.argmax(target, axis=1)][:, None] * len(sets) / len(names)
    gram = features.T @ (features * weight)
    solved = np.linalg.solve(gram + ridge * len(sets) * np.eye(len(gram)), features.T @ (target * weight))
    return Model(names, grams.astype(np.int64), incidence, (root @ solved).astype(np.float32), hash(incidence.tobytes()))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = strings(batch["text"])
        sets = [np.sort(_distinct(_grams(raw[a:b]))).astype("<u4").tobytes() for a, b in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays([batch["lang"], batch["rank"], pa.array(sets, pa.binary())], ["lang", "rank", "codes"])


def train(docs: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS) -> Model | None:
    """Fit on at most ``sample`` texts of ``docs(text, lang, rank)``, as many of each language.

    ``rank`` is any evenly spread long; the lowest are taken. Only the n-gram sets of the sample
    reach the driver. ``None`` if no row has both a language and a letter.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    share = max(1, sample // len(counts))
    places = COARSE * FINE
    limit = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(places, places * (2 * share + SPARE) // n + 1))])
    place = F.pmod("rank", F.lit(COARSE)) * FINE + F.pmod(F.expr(f"rank div {COARSE}"), F.lit(FINE))
    picked = usable.where(place < limit[F.col("lang")])
    found = picked.select("lang", "rank", "text").mapInArrow(_sets, "lang string, rank long, codes binary").collect()
    used: dict[str, int] = {}
    sets, langs = [], []
    for r in sorted(found, key=lambda r: (r["rank"] % COARSE, r["rank"])):
        used[r["lang"]] = used.get(r["lang"], 0) + 1
        if used[r["lang"]] <= share:
            sets.append(np.frombuffer(r["codes"], "<u4").astype(np.int64))
            langs.append(r["lang"])
    return fit(sets, langs, landmarks) if sets else None


def _predict(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    model = shared.value
    for batch in batches:
        for first in range(0, batch.num_rows, BATCH):
            some = batch.slice(first, BATCH)
            raw, at = strings(some["text"])
            has = [bool(t) and any(map(str.isalpha, t)) for t in some["text"].to_pylist()]
            langs, score = np.full(len(has), UNKNOWN, object), np.zeros(len(has))
            rows = np.flatnonzero(has) if model is not None else np.zeros(0, int)
            if len(rows):
                values = np.exp(SHARPNESS * (found := model.scores([raw[at[k] : at[k + 1]] for k in rows]).astype(float)))
                langs[rows] = np.array(model.langs, object)[found.argmax(axis=1)]
                score[rows] = values.max(axis=1) / values.sum(axis=1)
            yield pa.RecordBatch.from_arrays([some["doc_id"], pa.array(langs, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs``; a text that is null or has no letter is ``und`` with 0.

    Repeated rows are scored each; other columns, language and source among them, are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most LANDMARKS texts' n-grams
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda b: _predict(b, shared), f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double")


def classify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; learned from the documents that are not held out."""
    known = docs.where(~held_out(F.col("doc_id"))).select("text", "lang", F.xxhash64("doc_id", "text").alias("rank"))
    return predict(docs, train(known)).withColumn("held_out", held_out(F.col("doc_id")))
