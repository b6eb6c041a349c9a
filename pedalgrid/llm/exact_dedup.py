"""Exact duplicates by a minimal perfect hash over the digests of earlier documents.

The distinct digests of the history are dealt into shards by hash. Each shard is one row: the bit
levels of a minimal perfect hash, and behind it slots with the full digest, the winner's id and the
number of copies. A later digest is looked up in the slot that the hash names and counts as known
only if all its bytes are those of the slot. Digests that are new are grouped among themselves.

Digests are grouped before anything is looked up, so a group of copies of any size is one row per
task on its way, and no shard holds more than about ``SHARD_KEYS`` digests.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalgrid.llm.common import BLANKS, mixed, row_by_row, without
from pedalgrid.session import staged

SHARD_KEYS = 100_000
LEAST_SHARDS = 64
#: Bits of a level for each key that is still to be placed.
ROOM = 2
INDEX = "shard int, levels array<binary>, digests binary, winners binary, sizes binary"


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the SHA-256 of the text with each run of blanks as one space; null is empty."""
    normal = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), BLANKS, " ")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(normal, 256)).alias("digest"))


def _rows(values: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint8).reshape(-1, 32)


def _place(digest: np.ndarray, level: int, bits: int) -> np.ndarray:
    """Places of 32-byte digests in a level. All bytes count anew in each level, so no two digests meet in all of them."""
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    words = np.ascontiguousarray(digest).view("<u8").reshape(-1, 4)
    total = np.full(len(words), seed, np.uint64)
    for k in range(4):
        total = mixed(total + words[:, k]) ^ seed
    return (mixed(total) % np.uint64(bits)).astype(np.int64)


#: Levels after which only equal digests can be left.
MOST_LEVELS = 256


def build_levels(digest: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Bit levels of a minimal perfect hash of distinct digests, and each one's slot; equal digests fail by name.

    A digest that shares its place goes a level down.
    """
    levels, slots, base = [], np.full(len(digest), -1, np.int64), 0
    left = np.arange(len(digest))
    while len(left):
        if len(levels) == MOST_LEVELS:
            raise ValueError("build_levels: equal digests")
        bits = max(64, ROOM * len(left))
        at = _place(digest[left], len(levels), bits)
        alone = np.bincount(at, minlength=bits) == 1
        rank = np.cumsum(alone) - 1
        own = alone[at]
        slots[left[own]] = base + rank[at[own]]
        base += int(alone.sum())
        levels.append(np.packbits(alone).tobytes() + bits.to_bytes(8, "little"))
        left = left[~own]
    return levels, slots


def find_slots(levels: list[bytes], digest: np.ndarray) -> np.ndarray:
    """The slot of each digest, -1 where no level has its bit."""
    slots, base = np.full(len(digest), -1, np.int64), 0
    left = np.arange(len(digest))
    for k, packed in enumerate(levels):
        bits = int.from_bytes(packed[-8:], "little")
        level = np.unpackbits(np.frombuffer(packed[:-8], np.uint8), count=bits).astype(bool)
        at = _place(digest[left], k, bits)
        hit = level[at]
        slots[left[hit]] = base + (np.cumsum(level) - 1)[at[hit]]
        base += int(level.sum())
        left = left[~hit]
    return slots


def _build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    digest = _rows(group["digest"])
    levels, slots = build_levels(digest)
    order = np.argsort(slots)
    winner = group["winner"].to_numpy(np.int64)[order]
    size = group["size"].to_numpy(np.int64)[order]
    return pd.DataFrame([{"shard": key[0], "levels": levels, "digests": digest[order].tobytes(), "winners": winner.tobytes(), "sizes": size.tobytes()}])


def _probe(new: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    winner, size = new["first"].to_numpy(np.int64).copy(), new["size"].to_numpy(np.int64).copy()
    known = np.zeros(len(new), bool)
    for row in index.itertuples():
        if not len(new):
            break
        digest = _rows(new["digest"])
        slots = find_slots(list(row.levels), digest)
        kept = np.frombuffer(row.digests, np.uint8).reshape(-1, 32)
        known = slots >= 0
        known[known] = (kept[slots[known]] == digest[known]).all(axis=1)
        winner[known] = np.frombuffer(row.winners, np.int64)[slots[known]]
        size[known] += np.frombuffer(row.sizes, np.int64)[slots[known]]
    return pd.DataFrame({"digest": new["digest"], "keep_id": winner, "group_size": size, "known": known})


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """One row per shard from ``digest, winner, size`` with distinct digests."""
    return history.withColumn("shard", _shard(shards)).groupBy("shard").applyInPandas(_build, INDEX)


def look_up(new: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """``digest, keep_id, group_size, known`` for each of the distinct digests ``digest, first, size``."""
    dealt = new.withColumn("shard", _shard(shards)).groupBy("shard")
    return dealt.cogroup(index.groupBy("shard")).applyInPandas(
        lambda a, b: _probe(a, b), "digest binary, keep_id long, group_size long, known boolean"
    )


def shard_count(known: DataFrame, later: DataFrame) -> int:
    """Shards for two tables of distinct digests, neither with more than about ``SHARD_KEYS`` in one."""
    return max(LEAST_SHARDS, math.ceil(max(known.count(), later.count()) / SHARD_KEYS))


def _shard(shards: int):
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")


#: Stands for a missing id inside the index; ids are long.
_NO_ID = -(2**63)


def _grouped(rows: DataFrame, first: str) -> DataFrame:
    return rows.groupBy("digest").agg(F.coalesce(F.min("doc_id"), F.lit(_NO_ID)).alias(first), F.count(F.lit(1)).alias("size"))


def decide(docs: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """One row per document of ``history`` and ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the smallest id of the history stays, and without one the smallest id of ``docs``.
    Null texts are empty texts. A null id loses to any other; if all ids of a group are null,
    ``keep_id`` is null and all are kept. Rows that repeat an id share its verdict. Empty tables give
    no rows. Other columns are not read.
    """
    new = staged(digests(docs), "digests")
    old = staged(digests(history), "digests") if history is not None else None
    if old is None:
        winners = _grouped(new, "keep_id").withColumnRenamed("size", "group_size")
        everything = new
    else:
        known = staged(_grouped(old, "winner"), "known")
        later = staged(_grouped(new, "first"), "later")
        shards = shard_count(known, later)
        found = look_up(later, build_index(known, shards), shards).drop("known")
        # A known digest comes twice: with its size so far, and with the size after the lookup.
        both = found.unionByName(known.withColumnsRenamed({"winner": "keep_id", "size": "group_size"}))
        winners = both.groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"))
        everything = old.unionByName(new)
    winners = staged(winners, "winners").withColumn("keep_id", F.nullif("keep_id", F.lit(_NO_ID)))
    return everything.join(winners, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("keep_id").eqNullSafe(F.col("doc_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def halves(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The table as a history and a later load: ids up to about their median, and the rest."""
    median = docs.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    middle = F.lit(median if median is not None else 0)
    early = F.coalesce(F.col("doc_id") <= middle, F.lit(False))
    return docs.where(early), docs.where(~early)


def unique(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one with the smallest id.

    Rows that repeat an id are told apart by their texts, and of wholly equal rows one stays; a null id loses to
    any other. An empty table stays empty. Other columns stay as they are.
    """

    def keep(rows: DataFrame) -> DataFrame:
        early, late = halves(rows)
        return without(rows, decide(late, early).where(~F.col("kept")))

    return row_by_row(docs, keep)
