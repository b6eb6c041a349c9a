"""Near duplicates by word n-grams: a blocked sparse matrix product of the document by n-gram incidence.

The rows of the incidence matrix are documents, its columns n-grams; the product with its transpose has
the overlap of each two documents. It is computed in blocks, and only where an overlap can be large
enough:

1. ``key_counts`` tells each document in how many documents each of its n-grams stands. N-grams of one
   document alone overlap with nothing, so a document with too many of them links with nothing and goes.
2. Documents with equal sets are one row of the matrix.
3. Columns are put in order of their counts, rarest first. Two documents over the bound share one of the
   first ``n - ceil(share * n) + 1`` columns of either, so only these make candidates.
4. A document's own n-grams and the column's place in it bound the size of a set that it can link with there. Documents
   that no set of their column suits go from it. Of two that link, one at least reaches its own size: such lead.
   In each column some leaders are picked, and each other document that can link with them by size and by the
   column's place in either is paired with them. Blocks of leaders by documents are multiplied, overlaps
   accumulate, and pairs below the bound go. Links give labels to what they connect: documents of one label
   are not paired again, the others go into the next round, with more leaders. A group of copies is done
   after a few leaders.
5. What is left after ``ROUNDS`` rounds are columns of documents that mostly do not link. Such a column is split by the
   next column that two documents must share as well: of the first ``n - ceil(share * n) + k`` columns they have
   ``k`` in common, and less far in a column whose sets are all about as large. Splitting goes on, column by column, until groups are small; those are paired in full, but for documents of one label. A column is
   only split where that makes fewer entries than it has pairs of unlike labels, so what one document costs is bounded by
   the columns it has itself, however many documents share them.
6. All links join to components.

The columns of a document hold 64-bit hashes of its n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalgrid.llm import key_counts
from pedalgrid.llm.common import mixed, row_by_row, shingles, steps, strings, without, words
from pedalgrid.llm.links import components, contracted
from pedalgrid.session import staged

STEP = 1 << 19
#: Each round has so many times the leaders of the one before, and so many rounds come before columns are split.
MORE = 8
ROUNDS = 2
#: Documents of a column that are paired in full rather than split.
SMALL = 8
#: Documents that one block of the product multiplies a leader with.
BLOCK = 256


def _sets(raw: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of each document, in order of document and hash."""
    code, doc = shingles(*words(raw, at), size)
    order = np.lexsort((code, doc))
    code, doc = code[order], doc[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
    return code[new], doc[new]


def _count(texts: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    parts = []
    for raw, at, _ in key_counts.in_steps(texts, STEP):
        code, _ = _sets(raw, at, size)
        parts.append(key_counts.merged([(code, np.ones(len(code), np.int64))]))
        if len(parts) == 8:
            parts = [key_counts.merged(parts)]
    return *key_counts.merged(parts), 0


def _rows(texts: pa.Table, totals: np.ndarray, size: int, percent: int) -> pa.Table:
    """Set size, number of n-grams of its own, and the others, rarest first; none if it can link with nothing."""
    keys = _count(texts, size)[0]
    n = np.zeros(texts.num_rows, np.int64)
    alone = np.zeros(texts.num_rows, np.int64)
    blobs: list[bytes | None] = [None] * texts.num_rows
    for raw, at, rows in key_counts.in_steps(texts, STEP):
        code, doc = _sets(raw, at, size)
        seen = totals[np.searchsorted(keys, code)]
        n[rows] = np.bincount(doc, minlength=len(rows))
        alone[rows] = np.bincount(doc[seen == 1], minlength=len(rows))
        order = np.lexsort((code, seen, doc))
        ends = np.cumsum(n[rows])
        for k, row in enumerate(rows):
            if n[row] and 100 * (n[row] - alone[row]) >= percent * n[row]:
                blobs[row] = code[order[ends[k] - n[row] + alone[row] : ends[k]]].tobytes()
    return pa.table({"doc_id": texts["doc_id"], "n": n, "alone": alone, "columns": pa.array(blobs, pa.binary())})


def incidence(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id, n, alone, columns`` of every document."""
    groups = key_counts.group_count(docs)
    return key_counts.with_totals(
        key_counts.dealt(docs, groups),
        groups,
        lambda t: _count(t, size),
        lambda t, totals, _: _rows(t, totals, size, percent),
        "doc_id long, n long, alone long, columns binary",
    )


def _bound(n: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of a set of ``n`` n-grams with one that it links with."""
    return -(-percent * n // 100)


_ENTRY = "column long, doc_id long, n long, alone long, place long, depth long"


def _entries(parts: list[tuple[np.ndarray, int, int, int, np.ndarray, int]]) -> pa.RecordBatch:
    arrays: list[list[np.ndarray]] = [[], [], [], [], [], []]
    for column, doc, n, alone, place, depth in parts:
        for values, x in zip(arrays, (column, *(np.full(len(column), v, np.int64) for v in (doc, n, alone)), place, np.full(len(column), depth, np.int64))):
            values.append(x)
    names = [part.split(" ")[0] for part in _ENTRY.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in arrays], names)


def _by_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices with a bounded size of columns, however long the documents of a batch are."""
    for batch in batches:
        borders = strings(batch["columns"])[1] if batch.num_rows else np.zeros(1, np.int64)
        for first, last in steps(borders, 8 * STEP):
            yield batch.slice(first, last - first)


def _first_columns(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """One entry per column that a document may share first; ``place`` counts its own n-grams, which come before."""
    for batch in _by_bytes(batches):
        parts = []
        for doc, n, alone, blob in zip(*(batch[c].to_pylist() for c in ("doc_id", "n", "alone", "columns"))):
            column = np.frombuffer(blob, np.int64)[: max(0, n - _bound(n, percent) + 1 - alone)]
            parts.append((column, doc, n, alone, alone + np.arange(len(column)), 1))
        yield _entries(parts)


def _next_columns(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Each entry split by the columns that two of its documents may share next."""
    for batch in _by_bytes(batches):
        parts: list[tuple] = []
        size = 0
        for key, doc, n, alone, place, depth, least, blob in zip(*(batch[c].to_pylist() for c in ("column", "doc_id", "n", "alone", "place", "depth", "least", "columns"))):
            # With a set of at least ``least`` it must share so many, and the rest of its columns has to hold them.
            last = min(n - int(_bound(n, percent)) + depth + 1, n + depth + 1 + -percent * (n + least) // (100 + percent))
            more = np.frombuffer(blob, np.int64)[place + 1 - alone : max(0, last - alone)]
            column = mixed(mixed(np.full(len(more), key).view(np.uint64)) + more.view(np.uint64)).view(np.int64)
            parts.append((column, doc, n, alone, place + 1 + np.arange(len(more)), depth + 1))
            size += len(more)
            if size > STEP:
                yield _entries(parts)
                parts, size = [], 0
        yield _entries(parts)


def block_overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Product of two blocks of incidence rows: the overlap of each of ``a`` with each of ``b``."""
    column_a, row_a = np.concatenate(a), np.repeat(np.arange(len(a)), [len(x) for x in a])
    column_b, row_b = np.concatenate(b), np.repeat(np.arange(len(b)), [len(x) for x in b])
    order = np.argsort(column_a)
    column_a, row_a = column_a[order], row_a[order]
    low = np.searchsorted(column_a, column_b, "left")
    count = np.searchsorted(column_a, column_b, "right") - low
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
    cell = row_a[at] * len(b) + np.repeat(row_b, count)
    return np.bincount(cell, minlength=len(a) * len(b)).reshape(len(a), len(b))


def _multiply(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in _by_bytes(batches):
        for first in range(0, batch.num_rows, BLOCK):
            some = batch.slice(first, BLOCK)
            leader, doc = some["leader"].to_numpy(), some["doc_id"].to_numpy()
            own = [np.frombuffer(x, np.int64) for x in some["columns"].to_pylist()]
            theirs = some["leader_columns"].to_pylist()
            size, other = some["n"].to_numpy(), some["leader_n"].to_numpy()
            linked = np.zeros(len(doc), bool)
            for one in np.unique(leader):
                mine = np.flatnonzero(leader == one)
                shared = block_overlaps([np.frombuffer(theirs[mine[0]], np.int64)], [own[k] for k in mine])[0]
                linked[mine] = 100 * shared >= percent * (size[mine] + other[mine] - shared)
            names = ["leader", "doc_id", "leader_label", "label"]
            yield some.select(names).filter(pa.array(linked)).rename_columns(["a", "b", "label_a", "label_b"])


def _possible(percent: int):
    """Bounds before any overlap is counted: if a column is the last of ``depth`` that two sets share first, the rest of what
    they share stands behind it in both, and n-grams of their own are not shared."""
    rest = F.least(F.col("n") - F.col("place"), F.col("leader_n") - F.col("leader_place")) - 1
    most = F.least(F.col("depth") + rest, F.col("n") - F.col("alone"), F.col("leader_n") - F.col("leader_alone"))
    return (100 * most >= percent * (F.col("n") + F.col("leader_n") - most)) & (F.col("doc_id") != F.col("leader"))


def _reach(percent: int) -> Column:
    """Size of the largest set that an entry's document can link with in its column; see ``_possible``."""
    most = F.least(F.col("n") - F.col("alone"), F.col("depth") + F.col("n") - F.col("place") - 1)
    return F.floor(most * (100 + percent) / percent) - F.col("n")


def _leads(percent: int) -> Column:
    """Whether an entry's document can link with one of its own size. Of two that link this holds for the smaller one,
    so that two entries of which it does not hold need not meet."""
    return _reach(percent) >= F.col("n")


def _shared(entries: DataFrame, several: Column, percent: int) -> DataFrame:
    """Entries of the columns of which ``several`` holds and that have a leader, with the ``least`` size of a column's sets;
    the others make no candidates, nor do entries whose reach ends before the least, or that none reaches."""
    entries = entries.drop("least")
    sizes = F.min("n").alias("least"), F.max(_reach(percent)).alias("_reach"), F.max(_leads(percent)).alias("_leads")
    open_ = entries.groupBy("column").agg(several.alias("_open"), *sizes).where("_open AND _leads").select("column", "least", "_reach")
    joined = entries.join(staged(open_, "open"), "column")
    return joined.where((_reach(percent) >= F.col("least")) & (F.col("n") <= F.col("_reach"))).drop("_reach")


def _as_leaders(picked: DataFrame) -> DataFrame:
    return picked.select("column", F.col("doc_id").alias("leader"), *[F.col(c).alias(f"leader_{c}") for c in ("n", "alone", "place", "label")])


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs that are possible the links, ``a, b, label_a, label_b``."""
    pairs = staged(pairs.select("leader", "doc_id", "leader_label", "label").distinct(), "pairs")
    own = pairs.join(sets, "doc_id")
    theirs = sets.select(F.col("doc_id").alias("leader"), F.col("n").alias("leader_n"), F.col("columns").alias("leader_columns"))
    product = own.join(theirs, "leader").mapInArrow(lambda b: _multiply(b, percent), "a long, b long, label_a long, label_b long")
    return staged(product, "new_links")


def _relabelled(entries: DataFrame, new: DataFrame, percent: int) -> DataFrame:
    """Most of what is linked has one label from now on; columns of one label are done."""
    now = staged(contracted(new.select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))), "labels")
    rest = entries.join(now.select(F.col("id").alias("label"), "parent"), "label", "left")
    rest = staged(rest.withColumn("label", F.coalesce("parent", "label")).drop("parent"), "rest")
    return staged(_shared(rest, F.min("label") != F.max("label"), percent), "entries")


def _met(entries: DataFrame, percent: int, sets: DataFrame, leaders: int) -> tuple[DataFrame, DataFrame]:
    """New links of one round with so many leaders per column, and the entries that are still open."""
    # Of each part of a column's documents the one with the fewest n-grams of its own leads.
    salt = F.pmod(F.xxhash64("doc_id", F.lit(leaders)), F.lit(leaders))
    picked = entries.where(_leads(percent)).groupBy("column", salt.alias("_s")).agg(F.min(F.struct("alone", "doc_id", "n", "place", "label")).alias("l"))
    picked = staged(_as_leaders(picked.select("column", "l.*")), "leaders")
    pairs = entries.join(picked, "column").where(_possible(percent) & (F.col("label") != F.col("leader_label")))
    new = _linked(pairs, sets, percent)
    # Leaders have met all documents of their columns.
    rest = entries.join(picked.select("column", F.col("leader").alias("doc_id")), ["column", "doc_id"], "left_anti")
    return new, _relabelled(rest, new, percent)


def _width(percent: int) -> Column:
    """About how many entries a document makes if the columns that it may share first are all split: as a rule the
    documents of a column meet in its neighbours too."""
    shared = F.ceil((F.col("n") + F.col("least")) * percent / (100 + percent))
    width = F.greatest(F.col("n") - shared + F.col("depth") - F.col("alone"), F.lit(1))
    return width * width


def links(rows: DataFrame, percent: int) -> list[DataFrame]:
    """Tables of links ``a, b`` that join all documents whose sets overlap enough. ``rows``: distinct sets of ``incidence``.

    Every two such documents are linked, or joined by other links.
    """
    sets = rows.select("doc_id", "n", "columns")
    entries = rows.mapInArrow(lambda b: _first_columns(b, percent), _ENTRY)
    entries = staged(_shared(entries, F.count(F.lit(1)) > 1, percent).withColumn("label", F.col("doc_id")), "entries")
    found = []
    while not entries.isEmpty():
        leaders = 1
        for _ in range(ROUNDS):
            new, entries = _met(entries, percent, sets, leaders)
            found.append(new.select("a", "b"))
            leaders *= MORE
            if entries.isEmpty():
                return found
        # Most documents of a column often have one label. The others are paired with each other and with these, unless
        # splitting the column makes fewer entries.
        parts = entries.groupBy("column", "label").agg(F.count(F.lit(1)).alias("k"), F.sum(_width(percent)).alias("w"))
        parts = parts.groupBy("column").agg(F.max(F.struct("k", "label")).alias("top"), F.sum("k").alias("k"), F.sum("w").alias("w"))
        other = F.col("k") - F.col("top.k")
        split = (other * (other - 1) / 2 + other * F.col("top.k") > F.col("w")) & (F.col("k") > SMALL)
        cost = parts.select("column", F.col("top.label").alias("main"), split.alias("split"))
        cost = staged(cost, "costs")
        few = staged(entries.join(cost.where(~F.col("split")).drop("split"), "column"), "few")
        many = staged(entries.join(cost.where("split"), "column", "left_semi"), "many")
        once = (F.col("label") == F.col("main")) | (F.col("leader") < F.col("doc_id"))
        pairs = few.join(_as_leaders(few.where("label <> main")), "column").where(_possible(percent) & (F.col("label") != F.col("leader_label")) & once)
        new = _linked(pairs, sets, percent)
        found.append(new.select("a", "b"))
        if many.isEmpty():
            return found
        many = _relabelled(many, new, percent)
        wider = many.join(sets.select("doc_id", "columns"), "doc_id").mapInArrow(lambda b: _next_columns(b, percent), _ENTRY)
        # Labels are those of the documents; an entry's columns have changed.
        labels = staged(many.groupBy("doc_id").agg(F.min("label").alias("label")), "document_labels")
        wider = staged(_shared(wider, F.count(F.lit(1)) > 1, percent), "split")
        entries = staged(wider.join(labels, "doc_id"), "entries")
        entries = staged(_shared(entries, F.min("label") != F.max("label"), percent), "entries")
    return found


def cluster(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Two documents link when the overlap of their sets of ``size``-word n-grams is at least ``percent``
    of their union; a component's id is the smallest id in it. A document of fewer words has one n-gram
    of all its words. Null texts and texts without words have no n-gram and link with nothing; rows
    without an id link with nothing and have a null component. Rows that repeat an id are one document
    if their texts are equal, and share one component if not. Other columns are not read.
    """
    rows = staged(incidence(docs, size, percent), "incidence")
    live = rows.where(F.col("columns").isNotNull() & F.col("doc_id").isNotNull()).withColumn("digest", F.sha2("columns", 256))
    # Equal sets have no n-gram of their own: one document stands for all.
    whole = live.where("alone = 0")
    firsts = staged(whole.groupBy("digest").agg(F.min("doc_id").alias("first")), "firsts")
    members = staged(whole.select("doc_id", "digest").join(firsts, "digest").select("doc_id", "first"), "members")
    # An id that stands for several different sets is kept out of the products twice over: one row per id.
    kept = live.join(members.where("doc_id <> first").select("doc_id"), "doc_id", "left_anti").dropDuplicates(["doc_id"])
    distinct = staged(kept.select("doc_id", "n", "alone", "columns"), "distinct_sets")
    tables = links(distinct, percent)
    every = members.where("doc_id <> first").select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
    for one in tables:
        every = every.unionByName(one)
    found = components(every)
    joined = rows.select("doc_id", F.col("n").alias("n_shingles")).join(found, F.col("doc_id") == F.col("id"), "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def representatives(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest id; rows that share an id or have none count each."""

    def keep(rows: DataFrame) -> DataFrame:
        return without(rows, cluster(rows, size, percent).where(F.col("component_id") != F.col("doc_id")))

    return row_by_row(docs, keep)
