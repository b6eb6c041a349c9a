"""Near duplicates by SimHash fingerprints: all fingerprints compared exactly, tile by tile.

1. A document's fingerprint is the bitwise majority over the 64-bit hashes of its word shingles.
2. Equal fingerprints are one. Distinct ones are sorted into tiles by the bit counts of their four 16-bit
   quarters; a tile with too many is dealt out over several by hash.
3. Two fingerprints that differ in at most ``radius`` bits have quarter counts that differ by at most
   ``radius`` in sum. A tile therefore meets only the tiles whose counts are that close; all other pairs of tiles are
   skipped unread. Spark joins each tile with its neighbours, and numpy compares the two by exclusive-or
   and bit counts, some rows at a time.
4. Of the links within a pair of tiles only a spanning forest goes on, so a group of near copies never
   becomes its pairs. Components of what is left are the classes.

Tiles and the sorted-out pairs grow with the documents; a fingerprint travels to at most 161 neighbouring
places. The comparisons themselves grow with the square of the distinct fingerprints, at about one in
fifty of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalgrid.llm.common import steps, strings
from pedalgrid.llm.links import components
from pedalgrid.session import staged

SHINGLE = 4
SEED = 42
RADIUS = 4
#: Distinct fingerprints of a tile, about.
TILE = 1024
#: Comparisons of one in-memory step.
CELLS = 1 << 18
#: A longer text is hashed in overlapping parts of about this many bytes.
LONG_BYTES = 4 << 20
QUARTERS = 4
_BASE = 32  # more than the largest bit count of a quarter and than twice the radius

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _words(raw: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last byte (exclusive) of each word; a word ends with its document."""
    inner = ~_BLANK[raw]
    first = inner.copy()
    first[1:] &= ~inner[:-1]
    cut = borders[:-1][borders[:-1] < len(raw)]
    first[cut] = inner[cut]
    last = inner.copy()
    last[:-1] &= ~inner[1:] | first[1:]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def shingle_hashes(raw: np.ndarray, borders: np.ndarray, size: int = SHINGLE, whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 and document of each run of ``size`` lower-cased words joined by single spaces, repeats included.

    With ``whole``, a document of fewer words is one run of all its words.
    """
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if not len(raw):
        return none
    start, end = _words(raw, borders)
    n = len(start)
    if not n:
        return none
    doc = np.searchsorted(borders, start, "right") - 1
    # The words one after the other, each with one space behind it.
    length = end - start
    at = np.cumsum(length + 1) - length - 1
    line = np.full(int(at[-1] + length[-1] + 1), 0x20, np.uint8)
    shift = np.repeat(at - start, length)
    own = np.arange(int(length.sum())) + np.repeat(start - (np.cumsum(length) - length), length)
    line[own + shift] = _LOWER[raw[own]]
    a, b, which = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if n >= size:
        full = np.flatnonzero(doc[size - 1 :] == doc[: n - size + 1])
        a, b, which = at[full], (at + length)[full + size - 1], doc[full]
    if whole:
        opens = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        closes = np.append(opens[1:], n) - 1
        short = closes - opens + 1 < size
        a, b = np.concatenate([a, at[opens[short]]]), np.concatenate([b, (at + length)[closes[short]]])
        which = np.concatenate([which, doc[opens[short]]])
    text = line.tobytes()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(text[x:y], SEED) for x, y in zip(a.tolist(), b.tolist())), np.uint64, len(a))
    return hashes, which


def _parts(raw: np.ndarray, size: int, words: int) -> Iterator[tuple[np.ndarray, bool]]:
    """A long text in parts that overlap in ``words - 1`` words, so that each run of ``words`` lies in exactly one."""
    first, wide, n = 0, size, len(raw)
    while True:
        last = min(first + wide, n)
        while last < n and not _BLANK[raw[last : last + size]].any():
            last = min(last + size, n)
        if last < n:
            last += int(np.argmax(_BLANK[raw[last : last + size]]))
        part = raw[first:last]
        start, _ = _words(part, np.array([0, len(part)]))
        if last < n and len(start) < words:
            wide *= 2
            continue
        yield part, first == 0 and last == n
        if last == n:
            return
        first, wide = first + int(start[len(start) - words + 1]), size


def majority(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``n`` documents how many of its hashes have each of the 64 bits, and how many hashes there are."""
    ones, total = np.zeros((n, 64), np.int64), np.bincount(doc, minlength=n)
    order = np.argsort(doc, kind="stable")
    hashes, doc = hashes[order], doc[order]
    for a in range(0, len(hashes), 1 << 16):
        some, own = hashes[a : a + (1 << 16)], doc[a : a + (1 << 16)]
        bits = np.unpackbits(some.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        ones[own[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    return ones, total


def _as_long(ones: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Fingerprints as signed longs: a bit is set if more than half of the hashes have it."""
    bits = (2 * ones > total[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<i8").reshape(-1)


def _fingerprint(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = strings(batch["text"])
        found = np.zeros(batch.num_rows, np.int64)
        for a, b in steps(at, min(1 << 20, LONG_BYTES)):
            some = raw[at[a] : at[b]]
            if len(some) <= LONG_BYTES:
                hashes, doc = shingle_hashes(some, at[a : b + 1] - at[a], size)
                found[a:b] = _as_long(*majority(hashes, doc, b - a))
                continue
            ones, total = np.zeros((1, 64), np.int64), np.zeros(1, np.int64)
            for part, whole in _parts(some, LONG_BYTES, size):
                hashes, doc = shingle_hashes(part, np.array([0, len(part)]), size, whole)
                more, count = majority(hashes, doc, 1)
                ones, total = ones + more, total + count
            if not total[0]:  # few words, but with long blanks or words between the borders of parts
                hashes, doc = shingle_hashes(some, np.array([0, len(some)]), size)
                ones, total = majority(hashes, doc, 1)
            found[a:b] = _as_long(ones, total)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found)], ["doc_id", "code"])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, code`` of every row: the fingerprint as a signed long, 0 for texts without words."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda b: _fingerprint(b, size), "doc_id long, code long")


def _place(code: str) -> Column:
    """The bit counts of the four quarters as digits of one number."""
    quarters = [F.bit_count(F.shiftrightunsigned(code, 16 * k).bitwiseAND(F.lit(0xFFFF))) for k in range(QUARTERS)]
    place = quarters[0]
    for q in quarters[1:]:
        place = place * _BASE + q
    return place.cast("int")


def neighbour_steps(radius: int) -> list[tuple[int, ...]]:
    """Differences of quarter counts within the radius, one of each pair of opposite ones."""
    near = range(-radius, radius + 1)
    zero = (0,) * QUARTERS
    return [d for d in product(near, repeat=QUARTERS) if d >= zero and sum(map(abs, d)) <= radius]


def near_places(places: DataFrame, radius: int) -> DataFrame:
    """``place, other``: places that occur and whose counts differ by at most ``radius`` in sum, each pair from one side only.

    There are at most 17^4 places, whatever the number of documents.
    """
    weights = [_BASE ** (QUARTERS - 1 - k) for k in range(QUARTERS)]
    # Each step is one number: its digits, raised so that none is negative.
    codes = F.array(*[F.lit(sum((d + radius) * w for d, w in zip(step, weights))) for step in neighbour_steps(radius)])
    sent = places.select("place", F.explode(codes).alias("step"))
    fits = F.lit(True)
    for w in weights:
        moved = (F.floor(F.col("place") / w) % _BASE) + (F.floor(F.col("step") / w) % _BASE) - radius
        fits = fits & moved.between(0, 64 // QUARTERS)
    other = (F.col("place") + F.col("step") - radius * sum(weights)).cast("int")
    return sent.where(fits).select("place", other.alias("other")).join(places.withColumnRenamed("place", "other"), "other", "left_semi").select("place", "other")


def tiles(codes: DataFrame, size: int = TILE) -> DataFrame:
    """``place, tile, codes``: distinct fingerprints ``code`` by place, about ``size`` in a tile at most."""
    placed = codes.select("code", _place("code").alias("place"))
    # One row per place, of which there are at most 17^4.
    counts = placed.groupBy("place").agg(F.ceil(F.count(F.lit(1)) / size).alias("pieces"))
    dealt = placed.join(counts, "place").withColumn("tile", F.pmod(F.xxhash64("code"), "pieces").cast("int"))
    return dealt.groupBy("place", "tile").agg(F.collect_list("code").alias("codes"))


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node that each of ``n`` nodes reaches by the links ``a, b``."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(before, label):
            return label


def close_pairs(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of all pairs of ``a`` and ``b`` that differ in at most ``radius`` bits."""
    rows = max(1, CELLS // max(1, len(b)))
    held_a, held_b, held = [], [], 0
    nodes = np.concatenate([a, b])

    def reduced():
        label = forest(np.concatenate(held_a), np.concatenate(held_b), len(nodes))
        moved = np.flatnonzero(label != np.arange(len(nodes)))
        return moved, label[moved]

    for first in range(0, len(a), rows):
        near = np.bitwise_count(a[first : first + rows, None] ^ b[None, :]) <= radius
        if same:
            near &= np.arange(first, first + len(near))[:, None] < np.arange(len(b))[None, :]
        if near.any():
            i, j = np.nonzero(near)
            held_a.append(i + first)
            held_b.append(j if same else j + len(a))
            held += len(i)
            if held > CELLS:
                x, y = reduced()
                held_a, held_b, held = [x], [y], len(x)
    if not held:
        return a[:0], a[:0]
    x, y = reduced()
    return nodes[x], nodes[y]


def _compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        same = batch["same"].to_pylist()
        ends = []
        for name in ("codes", "others"):
            column = batch[name]
            at = column.offsets.to_numpy()
            # Offsets count from the start of the values, also in a slice.
            ends.append((column.values.to_numpy(zero_copy_only=False).view(np.uint64), at))
        (left, l), (right, r) = ends
        found = [close_pairs(left[l[k] : l[k + 1]], right[r[k] : r[k + 1]], radius, same[k]) for k in range(batch.num_rows)]
        a, b = (np.concatenate([f[s] for f in found]) if found else np.zeros(0, np.uint64) for s in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], ["a", "b"])


def links(codes: DataFrame, radius: int = RADIUS, size: int = TILE) -> DataFrame:
    """Links ``a, b`` that join all fingerprints ``code`` which differ in at most ``radius`` bits, or that others join."""
    cut = staged(tiles(codes, size), "tiles")
    near = staged(near_places(cut.select("place").distinct(), radius), "near_places")
    sent = cut.join(near, "place")
    met = cut.select(F.col("place").alias("other"), F.col("tile").alias("other_tile"), F.col("codes").alias("others"))
    once = (F.col("place") != F.col("other")) | (F.col("tile") <= F.col("other_tile"))
    same = (F.col("place") == F.col("other")) & (F.col("tile") == F.col("other_tile"))
    pairs = sent.join(met, "other").where(once).select("codes", "others", same.alias("same"))
    if not 0 <= radius < _BASE // 2:
        raise ValueError(f"links: radius {radius}")
    return pairs.mapInArrow(lambda b: _compare(b, radius), "a long, b long")


def cluster(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Words are separated by space and the controls from tab to carriage return, A-Z count as a-z. Null
    texts and texts without words have the fingerprint zero and link like any other. ``component_id`` is the
    smallest id that links reach, null if no row of the component has an id; rows without an id take part by
    their text. Repeated rows are a row each. An empty table gives no rows. Other columns are not read.
    """
    every = staged(fingerprints(docs, size), "fingerprints")
    distinct = staged(every.groupBy("code").agg(F.min("doc_id").alias("first")), "distinct")
    found = staged(components(staged(links(distinct.select("code"), radius, tile), "near")), "components")
    named = distinct.join(found, F.col("code") == F.col("id"), "left").select("code", "first", "component")
    linked = named.where(F.col("component").isNotNull())
    least = staged(linked.groupBy("component").agg(F.min("first").alias("least")), "least")
    classes = linked.join(least, "component").select("code", F.col("least").alias("component_id"))
    alone = named.where(F.col("component").isNull()).select("code", F.col("first").alias("component_id"))
    whole = staged(classes.unionByName(alone), "classes")
    fingerprint = F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint")
    return every.join(whole, "code").select("doc_id", fingerprint, "component_id")
