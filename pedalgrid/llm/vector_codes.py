"""Vector code compression: product codes of whole-number vectors, the nearest entry found by equal-average search.

A vector is cut into parts, and each part is named by the nearest entry of its position's codebook. The
codebooks start from the vectors with the smallest ids and are fitted in rounds: every task adds up the
parts that it assigns to each entry, Spark adds up the tasks, and the driver gets one row per entry and
component, however many vectors there are. Codebooks are broadcast: ``ENTRIES`` vectors in all.

The search of a part goes through the entries in the order of their component sums, outward from the
part's own sum. By Cauchy's inequality a squared distance is at least the squared gap of the sums over the
number of components, so a part is done when that bound strictly exceeds its best distance; an equal bound may
still hide an entry with a lower index. All parts of a batch take their next step together.

Components are whole numbers and every sum is exact: 64-bit while nothing can overflow, else Python's integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalgrid.session import staged

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Vectors of one in-memory step.
BATCH = 4096
#: Sums travel as digits of this many bits, so that they may have any size and still add up as longs.
LIMB_BITS = 32
_LONG = 2**63 - 1


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """``floor(SCALE * x)`` of finite numbers: 64-bit where all fit well within it, else Python's integers."""
    scaled = np.floor(values.astype(np.float64) * SCALE)
    if not scaled.size or np.abs(scaled).max() < 2.0**62:
        return scaled.astype(np.int64)
    if not np.isfinite(scaled).all():  # doubles near the end of their range
        exact = [int(x) * SCALE if abs(x) >= 2.0**53 else int(np.floor(x * SCALE)) for x in values.ravel().tolist()]
    else:
        exact = [int(x) for x in scaled.ravel().tolist()]
    return np.array(exact, object).reshape(values.shape)


def cuts(dim: int, parts: int = PARTS) -> list[tuple[int, int]]:
    """Borders of consecutive parts of equal length; if that does not come out even, the first ones get one more."""
    sizes = [dim // parts + (k < dim % parts) for k in range(parts)]
    ends = np.cumsum(sizes).tolist()
    return [(end - size, end) for end, size in zip(ends, sizes)]


def _roomy(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as they are if squares of their differences and sums fit 64 bits, else as Python's integers."""
    top = max([int(abs(x).max()) for x in arrays if x.size], default=0)
    width = max(x.shape[-1] for x in arrays)
    if 2 * top * max(1, width) < 2**31:
        return [x.astype(np.int64) for x in arrays]
    return [x.astype(object) for x in arrays]


def nearest(vectors: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest row of ``book`` for each of ``vectors``; ties go to the lower index."""
    n, entries, width = len(vectors), len(book), vectors.shape[1]
    vectors, book = _roomy(vectors, book)
    kind = vectors.dtype
    total = book.sum(axis=1) if width else np.zeros(entries, np.int64)
    order = np.argsort(total, kind="stable")
    total = total[order]
    own = vectors.sum(axis=1) if width else np.zeros(n, np.int64)
    right = np.searchsorted(total, own, "left")
    left = right - 1
    best, index = np.zeros(n, kind), np.full(n, -1, np.int64)
    active = np.arange(n)
    while len(active):
        low, high = left[active], right[active]
        sums = own[active]
        none = np.full(len(active), -1, kind)
        gap_low = np.where(low >= 0, sums - total[np.maximum(low, 0)], none)
        gap_high = np.where(high < entries, total[np.minimum(high, entries - 1)] - sums, none)
        down = (gap_high < 0) | ((gap_low >= 0) & (gap_low <= gap_high))
        gap = np.where(down, gap_low, gap_high)
        # Nothing left on either side, or the closest sum is too far for any entry behind it.
        go = (gap >= 0) & ((index[active] < 0) | ~(gap * gap > best[active] * max(1, width)))
        active, down = active[go.astype(bool)], down[go.astype(bool)].astype(bool)
        if not len(active):
            break
        entry = order[np.where(down, left[active], right[active])]
        left[active] -= down
        right[active] += ~down
        gaps = vectors[active] - book[entry]
        distance = (gaps * gaps).sum(axis=1) if width else np.zeros(len(active), kind)
        had, known = best[active], index[active]
        better = (known < 0) | (distance < had) | ((distance == had) & (entry < known))
        better = better.astype(bool)
        best[active[better]] = distance[better]
        index[active[better]] = entry[better]
    return index, best


@dataclass
class Codebooks:
    """One array ``entries by components`` for each part."""

    dim: int
    books: list[np.ndarray]

    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(str(int(x)) for book in self.books for x in book.ravel()).encode()).hexdigest()

    def assign(self, vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        return [nearest(vectors[:, a:b], book) for (a, b), book in zip(cuts(self.dim, len(self.books)), self.books)]


def _vectors(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column that hold ``dim`` finite numbers, and these as a matrix."""
    size = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    right = np.flatnonzero(size == dim)
    flat = column.take(pa.array(right)).flatten()
    values = pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False).reshape(len(right), dim)
    good = np.isfinite(values).all(axis=1)
    return right[good], values[good]


def _steps(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for first in range(0, batch.num_rows, BATCH):
            some = batch.slice(first, BATCH)
            rows, values = _vectors(some["embedding"], dim)
            if len(rows):
                yield some, rows, whole_numbers(values)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """Digits of a whole number: all but the last are not negative, so each place adds up by itself."""
    place = 0
    while not -(2**LIMB_BITS) <= value < 2**LIMB_BITS:
        yield place, value & (2**LIMB_BITS - 1)
        value >>= LIMB_BITS
        place += 1
    yield place, value


def _add_up(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """What a task's vectors add to each entry: sums by component, and their number as component -1."""
    books: Codebooks = shared.value
    sums = [np.zeros((len(b), b.shape[1] + 1), object) for b in books.books]
    for _, _, vectors in _steps(batches, books.dim):
        for (a, b), (index, _), total in zip(cuts(books.dim, len(books.books)), books.assign(vectors), sums):
            part = vectors[:, a:b]
            for entry in np.unique(index):
                own = part[index == entry]
                total[entry, 0] += len(own)
                # A step's sum of 64-bit numbers below 2^62 may pass 64 bits; halves of 32 bits cannot.
                if own.dtype == object:
                    total[entry, 1:] += own.sum(axis=0)
                else:
                    total[entry, 1:] += (own >> 32).sum(axis=0).astype(object) * 2**32 + (own & 0xFFFFFFFF).sum(axis=0).astype(object)
    rows = [
        (part, entry, place - 1, limb, digit)
        for part, total in enumerate(sums)
        for entry in np.flatnonzero(total[:, 0] > 0).tolist()
        for place, value in enumerate(total[entry].tolist())
        for limb, digit in _limbs(int(value))
    ]
    names = ["part", "entry", "place", "limb", "digit"]
    kinds = [pa.int32()] * 4 + [pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)


def _plain(vectors: DataFrame) -> DataFrame:
    return vectors.select("vec_id", "embedding", "label")


def _first_vectors(vectors: DataFrame, entries: int) -> tuple[int, np.ndarray]:
    """Length of the usable vectors, and the first of them by id, as whole numbers."""
    finite = vectors.where(F.forall("embedding", lambda x: F.abs(x) < F.lit(float("inf"))))
    # The rest of the order only matters where an id repeats.
    order = (F.col("vec_id").asc_nulls_last(), F.col("embedding"))
    found = finite.select("vec_id", "embedding").orderBy(*order).limit(entries).collect()
    if not found:
        return 0, np.zeros((0, 0), np.int64)
    dim = len(found[0]["embedding"])
    if any(len(r["embedding"]) != dim for r in found):
        found = finite.where(F.size("embedding") == dim).select("vec_id", "embedding").orderBy(*order).limit(entries).collect()
    return dim, whole_numbers(np.array([r["embedding"] for r in found], np.float64).reshape(len(found), dim))


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks after ``rounds`` rounds over all usable rows of ``vectors(vec_id, embedding)``; an unused entry stays.

    A round is one pass: partial sums per task, added up by Spark, and at most ``entries`` times the
    dimension rows to the driver.
    """
    vectors = vectors.select("vec_id", "embedding")
    dim, first = _first_vectors(vectors, entries)
    books = Codebooks(dim, [first[:, a:b] for a, b in cuts(dim, parts)])
    for _ in range(rounds if len(first) else 0):
        shared = vectors.sparkSession.sparkContext.broadcast(books)
        sums = vectors.select("embedding").mapInArrow(lambda b, s=shared: _add_up(b, s), "part int, entry int, place int, limb int, digit long")
        totals: dict[tuple[int, int, int], int] = {}
        for r in sums.groupBy("part", "entry", "place", "limb").agg(F.sum("digit").alias("digit")).collect():
            key = (r["part"], r["entry"], r["place"])
            totals[key] = totals.get(key, 0) + (r["digit"] << (LIMB_BITS * r["limb"]))
        new = []
        for part, book in enumerate(books.books):
            book = book.astype(object)
            for entry in range(len(book)):
                if count := totals.get((part, entry, -1)):
                    book[entry] = [totals[part, entry, k] // count for k in range(book.shape[1])]
            small = all(abs(x) < 2**62 for x in book.ravel())
            new.append(book.astype(np.int64) if small else book)
        books = Codebooks(dim, new)
    return books


def _code(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    books: Codebooks = shared.value
    for some, rows, vectors in _steps(batches, books.dim):
        found = books.assign(vectors)
        index = np.stack([i for i, _ in found], axis=1).astype(np.uint8)
        error = sum(d.astype(object) for _, d in found)
        code = [row.tobytes().hex() for row in index]
        at = pa.array(rows)
        yield pa.RecordBatch.from_arrays(
            [some["vec_id"].take(at), some["label"].take(at), pa.array(code), pa.array([min(int(e), _LONG) for e in error], pa.int64())],
            ["vec_id", "label", "code", "error"],
        )


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id, label, code, error`` of every usable row: the entries' indexes in hexadecimal and the summed squared distances."""
    kinds = dict(vectors.dtypes)
    if not books.books or not len(books.books[0]):
        return vectors.sparkSession.createDataFrame([], f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    layout = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    return _plain(vectors).mapInArrow(lambda b: _code(b, shared), layout)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every usable row of ``vectors(vec_id, embedding, label)``.

    Rows whose vector is null or has null or infinite components or NaN are dropped, and so are vectors whose
    length is not that of the usable vector with the smallest id. Null ids come last where ids are
    compared; rows that repeat an id are each a row, in the order of their vectors. With fewer rows than ``entries``
    the codebooks have as many entries as there are rows; an empty table gives no rows. A length that the
    parts do not divide gives the first parts one component more. Errors beyond the largest long are that
    long. Null labels are one label. At most 256 entries. Other columns are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("compress: 1 to 256 entries")
    books = fit(vectors, parts, entries, rounds)
    coded = staged(encode(vectors, books), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONG).cast("decimal(38,0)")).cast("long")
    by_label = staged(coded.groupBy("label").agg(total.alias("label_error")), "label_errors").withColumnRenamed("label", "_label")
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
