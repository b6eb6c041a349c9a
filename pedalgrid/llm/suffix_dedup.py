"""Repeated substrings across documents, by a distributed merge sort of suffixes that knows common prefixes.

A byte goes if a string of ``SPAN`` bytes over it also starts in a document with a smaller id.

Not every suffix is sorted. Each window of ``SPAN`` bytes names one of its ``SEED``-byte strings, the
one with the least hash, and the places that any window names are the anchors: the same window names
the same place of itself wherever it stands, so two documents that share a window share an anchor in it.
Anchors whose seed stands in one document only are left out (``key_counts``).

For the rest, the text from the anchor on and, behind it, the text before the anchor backwards make one
row. Groups of documents sort their distinct rows into runs, cut them by ranges and send them
front-coded: the length of the prefix shared with the row before, and the bytes after it. A range merges
its runs with loser trees in which every row carries the length of its common prefix with the last row
that left the tree; rows are compared from there on only. Many trees work on slices of the range side by
side. The prefix lengths that come out tell which rows share how many bytes after the anchor; among
those, rows with the same bytes before it share a window, and the smallest id of each goes back.

Rows that are equal in a group travel as one, with their smallest id, so a passage that a third of all
documents hold is one row per group. At the passage's edges every document gives another row with the
same first bytes. Ranges are cut anywhere in the whole row, so these are dealt out too; windows that a
border may part (those of rows that share all of the window's bytes after the anchor with the border)
are also sent by themselves, dealt by hash, and their smallest id comes back the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalgrid.llm import key_counts
from pedalgrid.llm.common import inverse_powers, mixed, prefix_sums, strings
from pedalgrid.llm.key_counts import pack, unpack

SPAN = 50
SEED = 20
#: Places a window can name, and so the bytes before an anchor that a row needs.
PLACES = SPAN - SEED + 1
BEFORE = PLACES - 1
WIDTH = SPAN + BEFORE
WORDS = WIDTH // 8
SLICE = 1 << 16
#: Stands for what lies beyond a document's border; no byte of UTF-8, and above all others.
BEYOND = 255
NEVER = np.iinfo(np.int64).max
#: Documents from which the borders of ranges are taken, and anchors of each.
SAMPLE = 400
PER_DOCUMENT = 64
#: Rows that one loser tree merges, about.
LANE_ROWS = 96


def anchors(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places that windows name, in order, and the hash of the seed at each. Windows lie in one document."""
    places, keys, n = [], [], len(raw)
    for first in range(0, max(0, n - SPAN + 1), SLICE):
        part = raw[first : first + SLICE + SPAN - 1]
        starts = len(part) - SPAN + 1
        sums, down = prefix_sums(part), inverse_powers(len(part))
        seed = sums[SEED:] - sums[:-SEED]
        seed *= down[: len(seed)]
        # Least hash, leftmost of equals: the hash above, the place below.
        value = seed ^ (seed >> np.uint64(32))
        value *= np.uint64(0x9E3779B97F4A7C15)
        value &= np.uint64(0xFFFFFFFF00000000)
        value |= np.arange(len(seed), dtype=np.uint64)
        width = 1
        while width < PLACES:
            step = min(width, PLACES - width)
            value = np.minimum(value[: len(value) - step], value[step:])
            width += step
        crossing = np.zeros(starts + 1, np.int32)
        near = slice(max(0, np.searchsorted(at, first, "right") - 1), np.searchsorted(at, first + starts + SPAN, "left") + 1)
        begin, end = at[:-1][near], at[1:][near]
        np.add.at(crossing, np.clip(np.maximum(end - SPAN + 1, begin) - first, 0, starts), 1)
        np.add.at(crossing, np.clip(end - first, 0, starts), -1)
        named = (value & np.uint64(0xFFFFFFFF))[np.cumsum(crossing[:-1]) == 0].astype(np.int64)
        if len(named):
            named = named[np.concatenate([[True], named[1:] != named[:-1]])]
            places.append(first + named)
            keys.append(mixed(seed[named]))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place, once = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(keys)[once]


def _read(texts: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, borders, anchors, the seeds' keys, and each anchor's document."""
    raw, at = strings(texts["text"])
    place, key = anchors(raw, at)
    return raw, at, place, key, np.searchsorted(at, place, "right") - 1


def _count(texts: pa.Table) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct seeds of a group, and in how many of its documents each stands."""
    _, _, _, key, doc = _read(texts)
    _, first = np.unique(mixed(key + doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), return_index=True)
    keys, counts = np.unique(key[first], return_counts=True)
    return keys, counts, 0


def rows_at(raw: np.ndarray, at: np.ndarray, place: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """A row of ``WIDTH`` bytes for each anchor: the text from it on, then the text before it backwards.

    Bytes are one up, so that none is zero; ``BEYOND`` fills up at borders.
    """
    out = np.empty((len(place), WIDTH), np.uint8)
    padded = np.concatenate([np.zeros(BEFORE, np.uint8), raw, np.zeros(SPAN, np.uint8)]) + np.uint8(1)
    out[:, :SPAN] = np.lib.stride_tricks.sliding_window_view(padded, SPAN)[place + BEFORE]
    out[:, SPAN:] = np.lib.stride_tricks.sliding_window_view(padded, BEFORE)[place][:, ::-1]
    after, before = at[doc + 1] - place, place - at[doc]
    for room, part in ((after, slice(0, SPAN)), (before, slice(SPAN, WIDTH))):
        size = part.stop - part.start
        near = np.flatnonzero(room < size)
        block = out[near, part]
        block[np.arange(size) >= room[near, None]] = BEYOND
        out[near, part] = block
    return out


def as_words(rows: np.ndarray) -> np.ndarray:
    """Rows as big-endian words, so that comparing words compares bytes."""
    return np.ascontiguousarray(rows).view(">u8").astype(np.uint64).reshape(len(rows), WORDS)


def distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct rows, and the number of each row among them."""
    word = as_words(rows)
    order = np.lexsort((word[:, 1], word[:, 0]))
    # Only rows that agree in two words with a neighbour are sorted by the others.
    same = (word[order[1:], 0] == word[order[:-1], 0]) & (word[order[1:], 1] == word[order[:-1], 1])
    some = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same])) if len(rows) else order
    if len(some):
        group = np.cumsum(~np.concatenate([[False], same]))[some]
        rest = word[order[some]]
        order[some] = order[some][np.lexsort((*rest.T[:1:-1], group))]
    word = word[order]
    new = np.ones(len(rows), bool)
    new[1:] = (word[1:] != word[:-1]).any(axis=1)
    number = np.empty(len(rows), np.int64)
    number[order] = np.cumsum(new) - 1
    return rows[order[new]], number


def front_code(rows: np.ndarray) -> tuple[bytes, bytes]:
    """Lengths of the prefix that each row shares with the one before, and what follows it."""
    shared = np.zeros(len(rows), np.uint8)
    if len(rows) > 1:
        shared[1:] = (rows[1:] != rows[:-1]).argmax(axis=1)
    return pack(shared), pack(rows[np.arange(WIDTH) >= shared[:, None]])


def front_decode(shared: bytes, rest: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The rows, and the lengths of the prefixes as they were coded."""
    prefix, data = unpack(shared), unpack(rest)
    own = np.arange(WIDTH) >= prefix[:, None]
    rows = np.zeros(own.shape, np.uint8)
    rows[own] = data
    # A byte in the shared prefix is that of the last row that has it of its own.
    number = np.arange(len(rows))
    for k in range(WIDTH):
        rows[:, k] = rows[np.maximum.accumulate(np.where(own[:, k], number, 0)), k]
    return rows, prefix


# --- merging ------------------------------------------------------------------------------------


def _common(word: np.ndarray, a: np.ndarray, b: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common prefix of rows ``a`` and ``b`` in bytes, read from byte ``known`` on, and whether ``a`` is smaller."""
    size, smaller = np.full(len(a), WIDTH, np.int64), np.ones(len(a), bool)
    left, at = np.arange(len(a)), known >> 3
    while len(left):
        left = left[at[left] < WORDS]
        x, y = word[a[left], at[left]], word[b[left], at[left]]
        unlike = x != y
        hit = left[unlike]
        bits = (x ^ y)[unlike]
        # The first byte that differs: how many of the leading bytes of the difference are zero.
        zero = np.zeros(len(hit), np.int64)
        for k in range(1, 8):
            zero += bits < np.uint64(1) << np.uint64(8 * (8 - k))
        size[hit] = 8 * at[hit] + zero
        smaller[hit] = x[unlike] < y[unlike]
        left = left[~unlike]
        at[left] += 1
    return size, smaller


def merge(word: np.ndarray, coded: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge sorted runs with one loser tree per lane; all trees take their next row in the same step.

    ``begin`` and ``end`` (lanes by runs) are slices of ``word``, ``coded`` is each row's common prefix with the
    row before it in its run, as front coding brought it: only the first row of a run in a lane is read from its first byte. Returns the row numbers in order, lane
    after lane, and each row's common prefix with the row before it (0 for the first of a lane).

    A node keeps the loser of a match with the length of its common prefix with the match's winner. A
    row that comes up has the length of its prefix with the last winner, so of two rows the one with
    the longer prefix is smaller, and only rows with equal lengths are read, from there on.
    """
    lanes, runs = begin.shape
    leaves = 1 << max(0, int(runs - 1).bit_length())
    total = (end - begin).sum(axis=1)
    out_at = np.concatenate([[0], np.cumsum(total)])[:-1]
    out, out_lcp = np.zeros(int(total.sum()), np.int64), np.zeros(int(total.sum()), np.int64)
    last = len(word)  # a row number that stands for an empty run: it loses every match
    head = np.full((lanes, leaves), last, np.int64)
    stop = np.zeros((lanes, leaves), np.int64)
    head[:, :runs] = np.where(begin < end, begin, last)
    stop[:, :runs] = end

    def match(row_a, lcp_a, row_b, lcp_b):
        """Whether ``a`` wins, and the loser's new prefix length."""
        wins = lcp_a > lcp_b
        lcp = np.minimum(lcp_a, lcp_b)
        wins = np.where(row_a == last, False, np.where(row_b == last, True, wins))
        even = np.flatnonzero((lcp_a == lcp_b) & (row_a != last) & (row_b != last))
        if len(even):
            size, smaller = _common(word, row_a[even], row_b[even], lcp_a[even])
            lcp[even] = size
            wins[even] = smaller
        return wins, lcp

    # Play all first matches, from the leaves up; prefixes with "nothing yet" are 0.
    loser, loser_lcp = np.zeros((lanes, leaves), np.int64), np.zeros((lanes, leaves), np.int64)
    player = np.tile(np.arange(leaves), (lanes, 1))
    lane = np.arange(lanes)
    size = leaves
    while size > 1:
        half = size // 2
        a, b = player[:, 0::2].ravel(), player[:, 1::2].ravel()
        of = np.repeat(lane, half)
        zero = np.zeros(len(of), np.int64)
        wins, lcp = match(head[of, a], zero, head[of, b], zero)
        loser[:, half:size] = np.where(wins, b, a).reshape(lanes, half)
        loser_lcp[:, half:size] = lcp.reshape(lanes, half)
        player = np.where(wins, a, b).reshape(lanes, half)
        size = half
    winner, winner_lcp = player[:, 0].copy(), np.zeros(lanes, np.int64)
    own_lcp = np.append(coded, 0).astype(np.int64)

    live = np.flatnonzero(total > 0)
    step = 0
    while len(live):
        run = winner[live]
        row = head[live, run]
        out[out_at[live] + step] = row
        out_lcp[out_at[live] + step] = winner_lcp[live]
        step += 1
        live = live[total[live] > step]
        if not len(live):
            break
        # The run's next row takes part from its leaf to the root.
        run = winner[live]
        after = head[live, run] + 1
        more = after < stop[live, run]
        row = np.where(more, after, last)
        head[live, run] = row
        lcp = np.where(more, own_lcp[np.minimum(after, last)], 0)
        node = (leaves + run) >> 1
        while node[0] > 0:
            other = loser[live, node]
            other_lcp = loser_lcp[live, node]
            other_row = head[live, other]
            stays, less = match(row, lcp, other_row, other_lcp)
            loser[live, node] = np.where(stays, other, run)
            loser_lcp[live, node] = less
            run = np.where(stays, run, other)
            row = np.where(stays, row, other_row)
            lcp = np.where(stays, lcp, other_lcp)
            node >>= 1
        winner[live], winner_lcp[live] = run, lcp
    return out, out_lcp


def merge_runs(runs: list[np.ndarray], prefixes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of all runs, one after the other, and common prefixes of neighbours in that order.

    ``prefixes``: for each run what each row shares with the row before it, from ``front_decode``.
    """
    rows = np.concatenate(runs)
    word = as_words(rows)
    if len(rows) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = [np.ascontiguousarray(r).view(f"S{WIDTH}").ravel() for r in runs]
    lanes = max(1, len(rows) // LANE_ROWS)
    picked = np.sort(np.concatenate([t[LANE_ROWS // 8 :: LANE_ROWS // 4] for t in text]))
    cuts = np.unique(picked[np.linspace(0, len(picked), lanes + 1)[1:-1].astype(int)]) if len(picked) and lanes > 1 else picked[:0]
    base = np.concatenate([[0], np.cumsum([len(r) for r in runs])])
    borders = np.stack([np.concatenate([[0], np.searchsorted(t, cuts), [len(t)]]) + b for t, b in zip(text, base)], axis=1)
    order, lcp = merge(word, np.concatenate(prefixes), borders[:-1], borders[1:])
    # Across the borders of lanes nothing is known.
    edge = np.cumsum((borders[1:] - borders[:-1]).sum(axis=1))[:-1]
    edge = np.unique(edge[(edge > 0) & (edge < len(order))])
    if len(edge):
        lcp[edge] = _common(word, order[edge - 1], order[edge], np.zeros(len(edge), np.int64))[0]
    return order, lcp


def least_ids(rows: np.ndarray, lcp: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Smallest id over all rows that share the window at each offset before the anchor: ``PLACES`` by rows.

    ``rows`` are sorted and distinct, ``lcp`` is each one's common prefix with the row before it.
    ``NEVER`` where the window leaves the row's document.
    """
    n = len(rows)
    out = np.full((PLACES, n), NEVER, np.int64)
    if not n:
        return out
    after = (rows[:, :SPAN] != BEYOND).sum(axis=1)
    before = (rows[:, SPAN:] != BEYOND).sum(axis=1)
    # A row whose seed no other row has answers for itself.
    same_seed = lcp >= SEED
    shared = same_seed.copy()
    shared[:-1] |= same_seed[1:]
    hashed = np.zeros(n, np.uint64)
    for offset in range(PLACES):
        if offset:
            hashed = mixed(hashed + rows[:, SPAN + offset - 1].astype(np.uint64) + np.uint64(offset << 8))
        fits = (after >= SPAN - offset) & (before >= offset)
        alone = fits & ~shared
        out[offset, alone] = doc[alone]
        some = np.flatnonzero(fits & shared)
        if not len(some):
            continue
        segment = np.cumsum(lcp < SPAN - offset).astype(np.uint64)[some]
        key = mixed(segment * np.uint64(0x9E3779B97F4A7C15) + hashed[some])
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        least = np.minimum.reduceat(doc[some][order], first)
        out[offset, some[order]] = np.repeat(least, np.diff(np.append(first, len(key))))
    return out


def offsets_of(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last offset before the anchor at which a window fits into the row's document."""
    after = (rows[:, :SPAN] != BEYOND).sum(axis=1)
    before = (rows[:, SPAN:] != BEYOND).sum(axis=1)
    return np.maximum(0, SPAN - after), np.minimum(BEFORE, before)


def summed_up(rows: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id of each row over all offsets, and which rows have others at some offset that fits."""
    low, high = offsets_of(rows)
    lowest = found.min(axis=0) if found.shape[1] else np.zeros(0, np.int64)
    same = (found == lowest).sum(axis=0)
    fits = np.where(lowest == NEVER, PLACES, np.maximum(0, high - low + 1))
    return lowest, same != fits


# --- windows across borders ---------------------------------------------------------------------------


def as_text(rows: np.ndarray) -> np.ndarray:
    """Rows as byte strings; no byte is zero."""
    return np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel()


def reach(rows: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Bytes, ``SPAN`` at most, that each row shares with a border of its range; with rows beyond it shares no more."""
    out = np.zeros(len(rows), np.int64)
    bucket = np.searchsorted(borders, as_text(rows), "right") if len(rows) else out
    wide = borders.view(np.uint8).reshape(len(borders), WIDTH)[:, :SPAN]
    for some, border in ((np.flatnonzero(bucket > 0), -1), (np.flatnonzero(bucket < len(borders)), 0)):
        for part in np.array_split(some, len(some) // SLICE + 1):
            unlike = rows[part, :SPAN] != wide[bucket[part] + border]
            out[part] = np.maximum(out[part], np.where(unlike.any(axis=1), unlike.argmax(axis=1), SPAN))
    return out


def parted(rows: np.ndarray, borders: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each offset before the anchor: the rows with a window that a border may part, which of the
    distinct windows each has, and these windows, in order of their deal."""
    far = np.flatnonzero(reach(rows, borders) >= SPAN - BEFORE)
    near = rows[far]
    after, (low, high) = reach(near, borders), offsets_of(near)
    for offset in range(PLACES):
        some = np.flatnonzero((after >= SPAN - offset) & (low <= offset) & (offset <= high))
        if not len(some):
            continue
        part = near[some]
        window = np.concatenate([part[:, SPAN : SPAN + offset][:, ::-1], part[:, : SPAN - offset]], axis=1)
        text, number = np.unique(as_text(window), return_inverse=True)
        order = np.argsort(deal(text, len(borders) + 1), kind="stable")
        turn = np.empty(len(order), np.int64)
        turn[order] = np.arange(len(order))
        yield offset, far[some], turn[number], text[order]


def deal(text: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each window."""
    raw = text.view(np.uint8).reshape(len(text), SPAN)
    word = np.pad(raw, ((0, 0), (0, -SPAN % 8))).view("<u8")
    out = np.zeros(len(text), np.uint64)
    for column in word.T:
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + column)
    return (out % np.uint64(buckets)).astype(np.int64)


def least_of(number: np.ndarray, ids: np.ndarray, kinds: int) -> np.ndarray:
    out = np.full(kinds, NEVER, np.int64)
    np.minimum.at(out, number, ids)
    return out


def _across(sent: pa.Table) -> pa.Table:
    """The smallest id of each window of a bucket, for every group that sent it."""
    texts = [unpack(x).view(f"S{SPAN}") for x in sent["rest"].to_pylist()]
    ids = np.concatenate([unpack(x) for x in sent["ids"].to_pylist()])
    kinds, number = np.unique(np.concatenate(texts), return_inverse=True)
    least = least_of(number, ids, len(kinds))[number]
    answers = [pack(x) for x in np.split(least, np.cumsum([len(t) for t in texts])[:-1])]
    none = pa.array([b""] * sent.num_rows, pa.binary())
    return pa.table({"part": sent["part"], "bucket": sent["bucket"], "least": pa.array(answers, pa.binary()), "several": none, "tables": none, "flags": none})


# --- the three visits to the documents ---------------------------------------------------------------


def _ids(texts: pa.Table) -> np.ndarray:
    return texts["doc_id"].fill_null(NEVER).to_numpy() if texts["doc_id"].null_count else texts["doc_id"].to_numpy()


def _send(texts: pa.Table, totals: np.ndarray, borders: np.ndarray) -> pa.Table:
    """The group's run in ranges, and behind these buckets of windows that borders may part, offset by offset.

    The first range also carries which seeds are shared, to have it back.
    """
    raw, at, place, key, doc = _read(texts)
    shared = totals > 1
    keys = np.unique(key)
    mine = shared[np.searchsorted(keys, key)] if len(key) else np.zeros(0, bool)
    place, doc = place[mine], doc[mine]
    rows, number = distinct_rows(rows_at(raw, at, place, doc))
    least = np.full(len(rows), NEVER, np.int64)
    np.minimum.at(least, number, _ids(texts)[doc])
    cut = np.concatenate([[0], np.searchsorted(as_text(rows), borders), [len(rows)]])
    part = texts["part"][0].as_py()
    out: dict[str, list] = {c: [] for c in ("bucket", "part", "prefix", "rest", "ids", "flags")}
    for k, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
        if a < b or k == 0:
            prefix, rest = front_code(rows[a:b])
            flags = pack(np.packbits(shared)) if k == 0 else b""
            for c, v in zip(out, (k, part, prefix, rest, pack(least[a:b]), flags)):
                out[c].append(v)
    ranges = len(borders) + 1
    for offset, some, window, text in parted(rows, borders):
        ids, to = least_of(window, least[some], len(text)), deal(text, ranges)
        names, first = np.unique(to, return_index=True)
        for k, a, b in zip(names, first, np.append(first[1:], len(to))):
            for c, v in zip(out, (ranges * (1 + offset) + k, part, b"", pack(text[a:b].view(np.uint8)), pack(ids[a:b]), b"")):
                out[c].append(v)
    binary = {c: pa.array(out[c], pa.binary()) for c in ("prefix", "rest", "ids", "flags")}
    return pa.table({"bucket": pa.array(out["bucket"], pa.int32()), "part": pa.array(out["part"], pa.int32())} | binary)


def _merge(sent: pa.Table, ranges: int) -> pa.Table:
    if sent["bucket"][0].as_py() >= ranges:
        return _across(sent)
    runs, prefixes = zip(*[front_decode(a, b) for a, b in zip(sent["prefix"].to_pylist(), sent["rest"].to_pylist())])
    ids = np.concatenate([unpack(x) for x in sent["ids"].to_pylist()])
    order, lcp = merge_runs(runs, prefixes)
    new = lcp < WIDTH
    if len(new):
        new[0] = True
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    least = np.minimum.reduceat(ids[order], first) if len(first) else ids
    rows = np.concatenate(runs)[order[first]]
    found = least_ids(rows, lcp[first], least)
    lowest, unlike_ids = summed_up(rows, found)
    at = np.concatenate([[0], np.cumsum([len(r) for r in runs])])
    answers, several, tables = [], [], []
    for a, b in zip(at[:-1], at[1:]):
        mine = kind[a:b]
        unlike = unlike_ids[mine]
        answers.append(pack(lowest[mine]))
        several.append(pack(np.packbits(unlike)))
        tables.append(pack(found[:, mine[unlike]].ravel()))
    return pa.table(
        {
            "part": sent["part"],
            "bucket": sent["bucket"],
            "least": pa.array(answers, pa.binary()),
            "several": pa.array(several, pa.binary()),
            "tables": pa.array(tables, pa.binary()),
            "flags": sent["flags"],
        }
    )


def _mark(texts: pa.Table, answers: pa.Table, borders: np.ndarray) -> pa.Table:
    """Bytes that go, and what is left."""
    raw, at, place, key, doc = _read(texts)
    ranges, buckets = len(borders) + 1, answers["bucket"].to_numpy()
    order = np.argsort(buckets)
    across = {o: order[buckets[order] // ranges == 1 + o] for o in range(PLACES)}
    order = order[buckets[order] < ranges]
    flags = answers["flags"].to_pylist()
    keys = np.unique(key)
    shared = np.unpackbits(unpack(flags[order[0]]), count=len(keys)).astype(bool) if len(order) else np.zeros(len(keys), bool)
    mine = shared[np.searchsorted(keys, key)] if len(key) else np.zeros(0, bool)
    place, doc = place[mine], doc[mine]
    own = _ids(texts)[doc]
    rows, number = distinct_rows(rows_at(raw, at, place, doc))
    least = [unpack(x) for x in answers["least"].take(pa.array(order)).to_pylist()]
    several = [np.unpackbits(unpack(x), count=len(n)).astype(bool) for x, n in zip(answers["several"].take(pa.array(order)).to_pylist(), least)]
    tables = [unpack(x).reshape(PLACES, -1) for x in answers["tables"].take(pa.array(order)).to_pylist()]
    nothing = [np.zeros(0, np.int64)], [np.zeros(0, bool)], [np.zeros((PLACES, 0), np.int64)]
    lowest, several, table = (np.concatenate(x or none, axis=-1) for x, none in zip((least, several, tables), nothing))
    change = np.zeros(len(raw) + 1, np.int32)
    low, high = offsets_of(rows)
    # One id at all offsets: the windows are one stretch around the anchor.
    plain = (lowest[number] < own) & ~several[number] & (low[number] <= high[number])
    np.add.at(change, place[plain] - high[number[plain]], 1)
    np.add.at(change, place[plain] - low[number[plain]] + SPAN, -1)
    part = np.flatnonzero(several[number])
    column = (np.cumsum(several) - 1)[number[part]]
    for offset in range(PLACES):
        start = place[part[table[offset][column] < own[part]]] - offset
        np.add.at(change, start, 1)
        np.add.at(change, start + SPAN, -1)
    by_row = np.argsort(number, kind="stable")
    begin = np.searchsorted(number[by_row], np.arange(len(rows) + 1))
    for offset, some, window, text in parted(rows, borders):
        found = np.concatenate([unpack(x) for x in answers["least"].take(pa.array(across[offset])).to_pylist()])[window]
        sizes = begin[some + 1] - begin[some]
        each = by_row[np.repeat(begin[some] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
        start = place[each[np.repeat(found, sizes) < own[each]]] - offset
        np.add.at(change, start, 1)
        np.add.at(change, start + SPAN, -1)
    gone = np.cumsum(change[:-1]) > 0
    first = gone.copy()
    first[1:] &= ~gone[:-1]
    cut = at[:-1][at[:-1] < len(raw)]
    first[cut] = gone[cut]
    sums, spans = np.concatenate([[0], np.cumsum(gone)]), np.concatenate([[0], np.cumsum(first)])
    removed = sums[at[1:]] - sums[at[:-1]]
    kept = [raw[a:b] if not r else raw[a:b][~gone[a:b]] for a, b, r in zip(at[:-1], at[1:], removed)]
    return pa.table(
        {
            "doc_id": texts["doc_id"],
            "n_bytes": np.diff(at),
            "n_removed": removed,
            "n_spans": spans[at[1:]] - spans[at[:-1]],
            "kept": pa.array([k.tobytes() for k in kept], pa.binary()),
        }
    )


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = strings(batch["text"])
        place, _ = anchors(raw, at)
        doc = np.searchsorted(at, place, "right") - 1
        turn = np.arange(len(place)) - np.searchsorted(doc, doc)
        every = np.bincount(doc, minlength=len(at))[doc] // PER_DOCUMENT + 1
        some = turn % every == 0
        rows = as_text(rows_at(raw, at, place[some], doc[some]))
        yield pa.RecordBatch.from_arrays([pa.array(rows.tolist(), pa.binary())], ["row"])


def range_borders(docs: DataFrame, ranges: int) -> np.ndarray:
    """Borders between ranges of whole rows, from a bounded sample of documents; any borders give the same result."""
    share = min(1.0, 4 * SAMPLE / max(1, docs.count()))
    rows = docs.select(F.col("text").cast("string").alias("text"), F.xxhash64("doc_id").alias("rank"))
    some = rows.where((F.pmod("rank", F.lit(1_000_000)) < int(1_000_000 * share) + 1) & (F.length("text") >= SPAN))
    few = some.orderBy("rank").limit(SAMPLE).select("text")
    found = np.array([bytes(r[0]) for r in few.mapInArrow(_prefixes, "row binary").collect()], f"S{WIDTH}")
    return np.unique(np.sort(found)[np.linspace(0, len(found), ranges + 1)[1:-1].astype(int)]) if len(found) else found



def strip(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes that stay) for every row of ``docs``.

    Texts are UTF-8, null is empty, and texts under ``SPAN`` bytes stay whole. A null id is larger than
    any other; rows with equal ids take nothing from each other. Other columns are not read.
    """
    groups = key_counts.group_count(docs)
    borders = range_borders(docs, groups)
    texts = key_counts.dealt(docs, groups)
    sent = key_counts.with_totals(
        texts,
        groups,
        _count,
        lambda t, totals, _: _send(t, totals, borders),
        "bucket int, part int, prefix binary, rest binary, ids binary, flags binary",
    )
    ranges = len(borders) + 1
    answers = sent.groupBy("bucket").applyInArrow(
        lambda t: _merge(t, ranges), "part int, bucket int, least binary, several binary, tables binary, flags binary"
    )
    marked = texts.groupBy("part").cogroup(answers.groupBy("part"))
    return marked.applyInArrow(lambda t, a: _mark(key_counts.unbundled(t), a, borders), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(stripped: DataFrame) -> DataFrame:
    """``strip`` with the kept bytes as a SHA-256."""
    return stripped.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
