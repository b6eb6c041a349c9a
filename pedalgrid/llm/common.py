"""What the operators share: reading tables, dropping rows by id, and hashes over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalgrid.session import staged

#: White space as the contracts spell it: space and the controls from tab to carriage return.
BLANKS = r"[\x20\x09-\x0D]+"
#: Text bytes that one in-memory step works on; larger batches are cut at document borders.
STEP_BYTES = 1 << 19

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the quarter of the documents that no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` less the rows whose id is in ``dropped``; rows without an id stay."""
    gone = dropped.select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


#: Name of the given id while rows have ids of their own.
GIVEN = "_given_doc_id"


def row_by_row(docs: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``keep(docs)``, which drops rows by ``doc_id``, where ids may be missing or stand for several rows.

    If each row has an id of its own nothing is done to them. Else ``keep`` sees rows numbered in the order of id
    and text, null ids last, with the given id as ``GIVEN``, so that what it drops is a row and not an id.
    """
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if ids.where((F.col("n") > 1) | F.col("doc_id").isNull()).isEmpty():
        return keep(docs)
    order = [F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_first()]
    own = docs.withColumn(GIVEN, F.col("doc_id")).orderBy(*order).withColumn("doc_id", F.monotonically_increasing_id())
    kept = keep(staged(own, "numbered"))
    return kept.select(*[F.col(GIVEN).alias(c) if c == "doc_id" else F.col(f"`{c}`") for c in docs.columns])


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts, from which the number of groups or shards is derived."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values one after the other, and each value's borders in them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if not (pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)):
        column = column.cast(pa.large_string() if pa.types.is_string(column.type) else pa.large_binary())
    _, borders, data = column.buffers()
    at = np.frombuffer(borders, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def steps(borders: np.ndarray, size: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of whole documents of about ``size`` bytes; a longer document is a run of its own."""
    first, n = 0, len(borders) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(borders, borders[first] + size, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd multiplier and of its inverse modulo 2^64, up to ``n``."""
    if len(_powers.get("up", ())) <= n:
        size = max(n + 1, STEP_BYTES + (1 << 18))
        for name, base in (("up", _MULTIPLIER), ("down", pow(_MULTIPLIER, -1, 1 << 64))):
            steps_ = np.full(size, base, np.uint64)
            steps_[0] = 1
            _powers[name] = np.cumprod(steps_, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def inverse_powers(n: int) -> np.ndarray:
    """Powers of the inverse multiplier: a difference of prefix sums times the one at its start does not depend on its place."""
    return _power(n)[1]


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """Sums of the bytes' random words times the powers of their places, so that spans hash by subtraction."""
    up, _ = _power(len(raw))
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_TABLE[raw] * up[: len(raw)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans; equal spans get equal hashes wherever they stand."""
    _, down = _power(len(sums))
    return mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


#: Bytes between words when marks count as blanks: all of ASCII but letters and digits.
_MARK = np.zeros(256, bool)
_MARK[:128] = True
_MARK[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False


def words(raw: np.ndarray, borders: np.ndarray, marks: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of each run of bytes without a blank; A-Z count as a-z.

    With ``marks``, ASCII marks and controls part words as blanks do.
    """
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    raw = _LOWER[raw]
    inner = ~(_MARK if marks else _BLANK)[raw]
    first = inner.copy()
    first[1:] &= ~inner[:-1]
    cut = borders[:-1][borders[:-1] < n]
    first[cut] = inner[cut]
    start = np.flatnonzero(first)
    last = inner.copy()
    last[:-1] &= ~inner[1:] | first[1:]
    end = np.flatnonzero(last) + 1
    doc = np.searchsorted(borders, start, "right") - 1
    return span_hashes(prefix_sums(raw), start, end), doc


def shingles(word: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of each run of ``size`` words; a shorter document is one run of all its words."""
    n = len(word)
    if not n:
        return word, doc
    counts = np.bincount(doc)
    whole = np.flatnonzero((counts > 0) & (counts < size))
    place = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
    out, own = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if n >= size:
        full = (doc[size - 1 :] == doc[: n - size + 1])
        total = np.zeros(n - size + 1, np.uint64)
        for k in range(size):
            total = mixed(total * np.uint64(_MULTIPLIER) + word[k : n - size + 1 + k])
        out, own = total[full], doc[: n - size + 1][full]
    if len(whole):
        short = np.isin(doc, whole)
        w, d, k = word[short], doc[short], place[short]
        code = np.zeros(len(counts), np.uint64)
        for step in range(size - 1):
            here = k == step
            code[d[here]] = mixed(code[d[here]] * np.uint64(_MULTIPLIER) + w[here])
        out = np.concatenate([out, mixed(code[whole] + counts[whole].astype(np.uint64))])
        own = np.concatenate([own, whole])
    return out, own
