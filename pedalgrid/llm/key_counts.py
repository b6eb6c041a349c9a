"""Counts of 64-bit keys over all documents, brought back to the documents: to and fro in two exchanges.

Documents are dealt into groups by hash. A group counts its keys, cuts the sorted keys into ranges and
sends each range as one packed row; a range adds the counts of all groups and sends each group its
totals in the order of the group's keys. Copies of a key meet in their group first, so a key that a
third of all documents have is one entry per group on its way, and no task holds more than one group
of documents or one range of keys.

The exchange of documents by group is the same in both directions, so Spark writes it once.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalgrid.llm.common import steps, strings, text_bytes

#: Bytes of text in a group. With 16 GB executors 256 MB keep the number of packed rows low at 100 TB.
GROUP_BYTES = 10 << 20
LEAST_GROUPS = 64
#: Bytes of text that a task holds back to send the documents of a group together and compressed.
BUNDLE_BYTES = 48 << 20

#: Keys, and how often each counts, of all documents of some texts ``(raw, borders)``.
Keys = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]

_squeeze = zstandard.ZstdCompressor(level=1)
_expand = zstandard.ZstdDecompressor()


def pack(values: np.ndarray) -> bytes:
    """Integers by planes of equal bytes, compressed."""
    wide = np.ascontiguousarray(values)
    head = wide.dtype.str.encode().ljust(4)
    return head + _squeeze.compress(wide.view(np.uint8).reshape(len(wide), wide.itemsize).T.tobytes() if len(wide) else b"")


def unpack(data: bytes) -> np.ndarray:
    kind = np.dtype(data[:4].decode().strip())
    raw = np.frombuffer(_expand.decompress(data[4:]), np.uint8)
    return np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).reshape(-1).view(kind)


def pack_sorted(values: np.ndarray) -> bytes:
    """Rising integers as differences."""
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def smallest(values: np.ndarray) -> np.ndarray:
    """Counts in the narrowest unsigned type that holds them."""
    top = int(values.max()) if len(values) else 0
    return values.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def group_count(docs: DataFrame) -> int:
    return max(LEAST_GROUPS, math.ceil(text_bytes(docs) / GROUP_BYTES))


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of one group in one compressed row, as far as a task has read."""
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    held: list[pa.RecordBatch] = []

    def flush():
        table = pa.Table.from_batches(held).combine_chunks()
        parts = table["part"].to_numpy()
        order = np.argsort(parts, kind="stable")
        names, first = np.unique(parts[order], return_index=True)
        rows = []
        for a, b in zip(first, np.append(first[1:], len(order))):
            sink = pa.BufferOutputStream()
            some = table.select(["doc_id", "text"]).take(pa.array(order[a:b]))
            with pa.ipc.new_stream(sink, some.schema, options=options) as out:
                out.write_table(some)
            rows.append(sink.getvalue().to_pybytes())
        held.clear()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(rows, pa.binary())], ["part", "documents"])

    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size > BUNDLE_BYTES:
            yield from flush()
            size = 0
    if held:
        yield from flush()


def dealt(docs: DataFrame, groups: int) -> DataFrame:
    """``part, documents``: the documents of each group in compressed bundles; other columns go."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int")
    return rows.withColumn("part", part).mapInArrow(_bundles, "part int, documents binary").repartition("part")


def unbundled(bundles: pa.Table) -> pa.Table:
    """``doc_id, text, part`` of a group's bundles, a document a row."""
    tables = [pa.ipc.open_stream(b.as_buffer()).read_all() for b in bundles["documents"]]
    part = bundles["part"][0].as_py() if bundles.num_rows else 0
    empty = pa.table({"doc_id": pa.array([], pa.int64()), "text": pa.array([], pa.string())})
    whole = pa.concat_tables([t.cast(empty.schema) for t in tables] or [empty]).combine_chunks()
    return whole.append_column("part", pa.array(np.full(whole.num_rows, part), pa.int32()))


def in_steps(texts: pa.Table, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, borders and row numbers of a table's texts, a bounded number of bytes at a time, by id."""
    row = 0
    for batch in texts.select(["text"]).to_batches():
        raw, at = strings(batch["text"])
        for a, b in steps(at, size):
            yield raw[at[a] : at[b]], at[a : b + 1] - at[a], np.arange(row + a, row + b)
        row += batch.num_rows


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their summed counts."""
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else np.zeros(0, np.int64)


def ranges_of(keys: np.ndarray, bits: int) -> np.ndarray:
    """Borders of the ranges that the leading bits name."""
    tops = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)
    return np.append(np.searchsorted(keys, tops), len(keys))


def _send(texts: pa.Table, count: Callable[[pa.Table], tuple[np.ndarray, np.ndarray, int]], bits: int) -> pa.Table:
    keys, counts, weight = count(texts)
    at = ranges_of(keys, bits)
    part = texts["part"][0].as_py() if texts.num_rows else 0
    n = len(at) - 1
    return pa.table(
        {
            "bucket": pa.array(np.arange(n), pa.int32()),
            "part": pa.array(np.full(n, part), pa.int32()),
            "keys": pa.array([pack_sorted(keys[a:b]) for a, b in zip(at[:-1], at[1:])], pa.binary()),
            "counts": pa.array([pack(smallest(counts[a:b])) for a, b in zip(at[:-1], at[1:])], pa.binary()),
            "weight": pa.array(np.full(n, weight), pa.int64()),
        }
    )


def _total(rows: pa.Table) -> pa.Table:
    keys = [unpack_sorted(x) for x in rows["keys"].to_pylist()]
    counts = [unpack(x).astype(np.int64) for x in rows["counts"].to_pylist()]
    sizes = np.cumsum([len(k) for k in keys])[:-1]
    every, each = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    in_order = every[order]
    new = np.ones(len(every), bool)
    new[1:] = in_order[1:] != in_order[:-1]
    sums = np.add.reduceat(each[order], np.flatnonzero(new)) if len(every) else each
    total = np.empty(len(every), np.int64)
    total[order] = sums[np.cumsum(new) - 1]
    weight = sum(rows["weight"].to_pylist())
    return pa.table(
        {
            "part": rows["part"],
            "bucket": rows["bucket"],
            "totals": pa.array([pack(smallest(t)) for t in np.split(total, sizes)], pa.binary()),
            "weight": pa.array(np.full(rows.num_rows, weight), pa.int64()),
        }
    )


def with_totals(
    texts: DataFrame,
    groups: int,
    count: Callable[[pa.Table], tuple[np.ndarray, np.ndarray, int]],
    finish: Callable[[pa.Table, np.ndarray, int], pa.Table],
    layout: str,
) -> DataFrame:
    """``finish(texts of a group, totals of its keys in order, summed weight of all groups)`` for every group.

    ``count`` gives a group's distinct keys in order, their counts and one further number that is added
    over all groups. Both are called with the same table of documents, ``doc_id, text, part``; ``texts`` is ``dealt``.
    """
    bits = max(0, math.ceil(math.log2(groups)))
    sent = texts.groupBy("part").applyInArrow(
        lambda t: _send(unbundled(t), count, bits), "bucket int, part int, keys binary, counts binary, weight long"
    )
    answers = sent.groupBy("bucket").applyInArrow(_total, "part int, bucket int, totals binary, weight long")

    def back(own: pa.Table, reply: pa.Table) -> pa.Table:
        order = np.argsort(reply["bucket"].to_numpy())
        packed = reply["totals"].to_pylist()
        totals = np.concatenate([unpack(packed[k]).astype(np.int64) for k in order]) if len(order) else np.zeros(0, np.int64)
        # One bucket's weight is the sum over all groups; it is the same in each.
        weight = reply["weight"][0].as_py() if reply.num_rows else 0
        return finish(unbundled(own), totals, weight)

    return texts.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(back, layout)
