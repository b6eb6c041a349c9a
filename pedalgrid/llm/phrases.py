"""Phrase collocations: phrases of two and three words that stand together more often than their words do.

Texts are cut into pieces at marks and line ends, and pieces into words. Each task builds FM-indexes over the
word ids of what it reads, one per shard of about ``SHARD_BYTES`` of one language: the Burrows-Wheeler
transforms of the shard's words and of the same words backwards. An interval of an index stands for a phrase,
its length is the phrase's count. Extending an interval by a word on the left through one transform also
moves the interval in the other one, so a phrase can be extended on either side:

1. The words of all shards are counted, and words that occur often enough get numbers.
2. Each shard gets the numbers of its words. It extends each word to the left, and each pair that comes of
   that to the right, and reports the counts of all phrases of numbered words. Spark adds them up.
3. Phrases that occur often enough are joined with their words and with the phrases they hold.

A phrase cannot occur more often than its rarest word, so nothing is lost by leaving other words out. Texts do
not move; shards travel once, next to the numbers of their words. A phrase that a third of all documents
have is one row per shard before Spark adds up. Intervals are only needed for three words, so
suffixes are sorted by their first three words.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pedalgrid.llm.key_counts import pack, unpack
from pedalgrid.session import staged

LONGEST = 3
LEAST = 10
SHARE = 50
TOP = 2000
UNKNOWN = "und"
#: Text of one shard, and of all shards that a task has open.
SHARD_BYTES = 8 << 20
OPEN_BYTES = 32 << 20
#: Occurrences whose phrases are extended in one in-memory step.
STEP_ROWS = 1 << 17
#: Numbered words of a bucket, about; groups that the best phrases of a language are first sought in.
BUCKET = 256
SALTS = 64
SCALE = 1_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MARK = np.zeros(256, bool)
_MARK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_OUTER = _MARK.copy()
_OUTER[[0x20, 0x09]] = True
_INDEX = "shard long, lang string, n long, words binary, counts binary, left binary, right binary"


def word_ids(raw: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The text as ids from 1, a 0 behind each piece, and the words in the order of their ids."""
    inner = ~_OUTER[raw]
    first = inner.copy()
    first[1:] &= ~inner[:-1]
    start = np.flatnonzero(first)
    if not len(start):
        return np.zeros(0, np.int32), []
    end = inner.copy()
    end[:-1] &= ~inner[1:]
    length = np.flatnonzero(end) + 1 - start
    borders = np.zeros(len(start) + 1, np.int64)
    np.cumsum(length, out=borders[1:])
    letters = _LOWER[raw[inner]]
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(borders), pa.py_buffer(letters)])
    coded = column.dictionary_encode()
    ids = coded.indices.to_numpy().astype(np.int32) + 1
    piece = np.cumsum(_MARK[raw], dtype=np.int32 if len(raw) < 2**31 else np.int64)[start]
    ends = np.append(np.flatnonzero(piece[1:] != piece[:-1]) + 1, len(ids))
    return np.insert(ids, ends, 0), coded.dictionary.to_pylist()


def transform(line: np.ndarray, depth: int = LONGEST) -> np.ndarray:
    """Burrows-Wheeler transform of ids whose last is 0, suffixes sorted by their first ``depth`` ids."""
    n, top = len(line), int(line.max()) + 1 if len(line) else 1
    ahead = np.concatenate([line, np.zeros(depth, line.dtype)])
    if top**depth < 2**63:
        key = np.zeros(n, np.int64)
        for k in range(depth):
            key = key * top + ahead[k : n + k]
        order = np.argsort(key)
    else:
        order = np.lexsort([ahead[k : n + k] for k in reversed(range(depth))])
    return line[order - 1]


class Extender:
    """One direction of a bidirectional index: from intervals in a transform to those of phrases one word longer."""

    def __init__(self, changed: np.ndarray) -> None:
        self.changed = changed
        order = np.argsort(changed, kind="stable")
        #: Where the row's suffix, with the word before it, stands itself: words before it, and equal ones further up.
        self.step = np.empty(len(changed), np.int32 if len(changed) < 2**31 else np.int64)
        self.step[order] = np.arange(len(changed), dtype=self.step.dtype)

    def extend(self, low: np.ndarray, count: np.ndarray, other: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, ...]:
        """All extensions of intervals ``low .. low + count`` by one ``known`` word.

        Returns which interval was extended, the word, and of the new phrase: its first row, its count,
        and its first row in the other transform, where ``other`` is the first row of the interval that was extended.
        """
        total = int(count.sum())
        began = np.cumsum(count) - count
        which = np.repeat(np.arange(len(low)), count)
        rows = np.arange(total) + np.repeat(low - began, count)
        word = self.changed[rows].astype(np.int64)
        order = np.argsort(which * (int(self.changed.max(initial=0)) + 1) + word, kind="stable")
        which, word = which[order], word[order]
        new = np.ones(total, bool)
        new[1:] = (which[1:] != which[:-1]) | (word[1:] != word[:-1])
        first = np.flatnonzero(new)
        many = np.diff(np.append(first, total))
        which, word = which[first], word[first]
        # Of the rows of an interval, those with smaller words come first in the other transform.
        beside = other[which] + first - began[which]
        kept = known[word]
        return which[kept], word[kept], self.step[rows[order[first[kept]]]], many[kept], beside[kept]


def phrases_of(left: np.ndarray, right: np.ndarray, known: np.ndarray, rows: int = STEP_ROWS) -> Iterator[tuple]:
    """Two-word phrases ``x, y, count`` and three-word phrases ``x, y, z, count`` of known words of one index.

    The intervals of about ``rows`` occurrences are extended at a time, each phrase in one of the steps.
    """
    size = len(known)
    count = np.bincount(left, minlength=size)
    low = np.cumsum(count) - count
    words = np.flatnonzero(known & (count > 0))
    back, forth = Extender(left), Extender(right)
    upto = np.cumsum(count[words])
    first = 0
    while first < len(words):
        before = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, before + rows, "right")))
        some = words[first:last]
        which, x, start, twice, beside = back.extend(low[some], count[some], low[some], known)
        y = some[which]
        again, z, _, thrice, _ = forth.extend(beside, twice, start, known)
        yield (x, y, twice), (x[again], y[again], z, thrice)
        first = last


def _index(shard: int, lang: str, texts: list[np.ndarray]) -> tuple:
    # A line end between two texts keeps their pieces apart.
    ids, words = word_ids(np.concatenate([x for t in texts for x in (t, np.array([10], np.uint8))]))
    counts = np.bincount(ids, minlength=len(words) + 1)[1:]
    backwards = np.append(ids[:-1][::-1], np.zeros(min(1, len(ids)), ids.dtype))
    left, right = transform(ids), transform(backwards)
    return shard, lang, int(counts.sum()), b"\n".join(words), pack(counts), pack(left), pack(right)


def _shards(batches: Iterator[pa.RecordBatch], shard_bytes: int) -> Iterator[pa.RecordBatch]:
    names = [part.split(" ")[0] for part in _INDEX.split(", ")]
    held: dict[str, list[np.ndarray]] = {}
    size: dict[str, int] = {}
    context = TaskContext.get()
    # Numbers by task and order. The table is written, so of a task that runs twice one attempt's rows stay.
    numbers = count((context.partitionId() if context else 0) << 32)

    def flush(lang: str) -> pa.RecordBatch:
        row = _index(next(numbers), lang, held.pop(lang))
        del size[lang]
        kinds = [pa.int64(), pa.string(), pa.int64()] + [pa.binary()] * 4
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
            if not text.is_valid:
                continue
            raw = np.frombuffer(text.as_buffer(), np.uint8)
            for part in _cut(raw, shard_bytes):
                # A copy, so that a few texts of a rare language do not keep their batches.
                held.setdefault(lang, []).append(part.copy())
                size[lang] = size.get(lang, 0) + len(part) + 1
                if size[lang] >= shard_bytes:
                    yield flush(lang)
                elif sum(size.values()) >= OPEN_BYTES:
                    yield flush(max(size, key=size.get))
    for lang in list(held):
        yield flush(lang)


def _cut(raw: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """A text in parts of at most ``size`` bytes, cut behind marks; a piece is never cut, however long."""
    first = 0
    while len(raw) - first > size:
        marks = np.flatnonzero(_MARK[raw[first : first + size]])
        if len(marks):
            last = first + int(marks[-1]) + 1
        else:
            last = first + size
            while last < len(raw) and not _MARK[raw[last : last + size]].any():
                last += size
            last = min(len(raw), last + int(np.argmax(_MARK[raw[last : last + size]])) + 1) if last < len(raw) else len(raw)
        yield raw[first:last]
        first = last
    if first < len(raw):
        yield raw[first:]


def index(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per shard: its words with their counts, and both transforms."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")
    return docs.select(lang, F.col("text").cast("string").alias("text")).mapInArrow(lambda b: _shards(b, shard_bytes), _INDEX)


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, lang, words, counts in zip(*(batch[c].to_pylist() for c in ("shard", "lang", "words", "counts"))):
            many = unpack(counts)
            if len(many):
                place = pa.array(np.arange(1, len(many) + 1), pa.int32())
                same = [pa.array(np.full(len(many), shard), pa.int64()), pa.array(np.full(len(many), lang, object), pa.string())]
                text = pa.array(words.split(b"\n"), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*same, place, text, pa.array(many, pa.int64())], ["shard", "lang", "place", "word", "c"])


def numbered(words: DataFrame) -> tuple[DataFrame, int]:
    """``words(lang, word, f)`` with a number ``id`` from 1 each, and how many bits the numbers have.

    A number is a bucket by hash and the place in the bucket, so no task sorts them all.
    """
    words = staged(words, "words")
    buckets = 1
    while buckets * BUCKET < words.count():
        buckets *= 2
    bucket = F.pmod(F.xxhash64("lang", "word"), F.lit(buckets))
    placed = staged(words.withColumn("_b", bucket).withColumn("_p", F.row_number().over(W.partitionBy("_b").orderBy("lang", "word"))), "places")
    most = placed.agg(F.max("_p")).first()[0] or 0
    low = (most + 1).bit_length()
    bits = low + (buckets - 1).bit_length()
    return placed.select("lang", "word", "f", (F.col("_b") * (1 << low) + F.col("_p")).alias("id")), bits


def _report(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    names = ["pair", "third", "c"]
    for batch in batches:
        for row in range(batch.num_rows):
            left, right = unpack(batch["left"][row].as_py()), unpack(batch["right"][row].as_py())
            marks = batch["marks"][row].values
            number = np.zeros(int(left.max(initial=0)) + 1, np.int64)
            number[marks.field("place").to_numpy()] = marks.field("id").to_numpy()
            for (x, y, twice), (a, b, c, thrice) in phrases_of(left, right, number > 0):
                pair = np.concatenate([(number[x] << bits) + number[y], (number[a] << bits) + number[b]])
                parts = [pair, np.concatenate([np.zeros(len(x), np.int64), number[c]]), np.concatenate([twice, thrice])]
                yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()) for p in parts], names)


def counted(shards: DataFrame, words: DataFrame, vocabulary: DataFrame, bits: int, least: int) -> DataFrame:
    """``pair, third, a``: phrases of numbered words that occur ``least`` times or more; ``third`` is 0 for two words."""
    if 2 * bits > 63:
        raise ValueError(f"phrases: {bits} bits for the number of a word")
    marks = vocabulary.select("shard", "lang", "place", "word").join(words.select("lang", "word", "id"), ["lang", "word"])
    # As many as the shard has words, which its bytes bound.
    marks = marks.groupBy("shard").agg(F.collect_list(F.struct("place", "id")).alias("marks"))
    own = shards.select("shard", "left", "right").join(marks, "shard").select("left", "right", "marks")
    found = own.mapInArrow(lambda b: _report(b, bits), "pair long, third long, c long")
    return found.groupBy("pair", "third").agg(F.sum("c").alias("a")).where(F.col("a") >= least)


def _score(a: Column, l: Column, r: Column) -> Column:
    """``floor(SCALE * a * a / (l * r))`` in whole numbers of up to 38 digits."""
    a, l, r = (x.cast("decimal(16,0)") for x in (a, l, r))
    return F.call_function("div", a * a * F.lit(SCALE).cast("decimal(7,0)"), l * r)


def scored(phrases: DataFrame, words: DataFrame, bits: int, share: int) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the phrases that no longer one holds too often."""
    first = F.shiftright("pair", bits)
    second = F.col("pair").bitwiseAND(F.lit((1 << bits) - 1))
    named = staged(phrases.select("pair", first.alias("x"), second.alias("y"), "third", "a"), "phrases")
    two = named.where("third = 0").select("pair", "x", "y", "a")
    three = named.where("third > 0").withColumnRenamed("third", "z").withColumn("rest", F.shiftleft("y", bits) + F.col("z"))

    def word(name: str, lang: bool = False) -> DataFrame:
        renamed = [F.col("id").alias(name), F.col("word").alias(f"word_{name}"), F.col("f").alias(f"f_{name}")]
        return words.select(*renamed, *(["lang"] if lang else []))

    # The largest count of a phrase that holds a pair as its first or last two words.
    held = three.select("pair", "a").unionByName(three.select(F.col("rest").alias("pair"), "a"))
    longer = staged(held.groupBy("pair").agg(F.max("a").alias("most")), "longer")
    pairs = two.join(longer, "pair", "left").where(F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * share))
    pairs = pairs.join(word("x", lang=True), "x").join(word("y"), "y")
    pairs = pairs.select(
        "lang",
        F.concat_ws(" ", "word_x", "word_y").alias("phrase"),
        "a",
        F.col("f_x").alias("l"),
        F.col("f_y").alias("r"),
        _score(F.col("a"), F.col("f_x"), F.col("f_y")).alias("score"),
    )
    triples = three.join(two.select("pair", F.col("a").alias("f_xy")), "pair").join(two.select(F.col("pair").alias("rest"), F.col("a").alias("f_yz")), "rest")
    triples = triples.join(word("x", lang=True), "x").join(word("y"), "y").join(word("z"), "z")
    early = _score(F.col("a"), F.col("f_x"), F.col("f_yz"))
    late = _score(F.col("a"), F.col("f_xy"), F.col("f_z"))
    cut = F.least(
        F.struct(early.alias("score"), F.lit(1).alias("k"), F.col("f_x").alias("l"), F.col("f_yz").alias("r")),
        F.struct(late.alias("score"), F.lit(2).alias("k"), F.col("f_xy").alias("l"), F.col("f_z").alias("r")),
    )
    triples = triples.select("lang", F.concat_ws(" ", "word_x", "word_y", "word_z").alias("phrase"), "a", cut.alias("cut"))
    return pairs.unionByName(triples.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))


def mine(docs: DataFrame, least: int = LEAST, share: int = SHARE, top: int = TOP, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language by score, count and phrase.

    ``n`` counts all words of the language, ``a`` the phrase, ``l`` and ``r`` its two parts at the cut with the
    lowest score. Null languages are ``und``, null and empty texts and texts without words count nothing;
    repeated rows count each. Phrases do not pass marks, line ends or documents. A piece without marks stays in one task however long
    it is. An empty table, or one without a phrase of ``least`` occurrences, gives no rows. Only text and
    language are read.
    """
    shards = staged(index(docs, shard_bytes), "phrase_index")
    vocabulary = shards.select("shard", "lang", "words", "counts").mapInArrow(_vocabulary, "shard long, lang string, place int, word string, c long")
    frequent = vocabulary.groupBy("lang", "word").agg(F.sum("c").alias("f")).where(F.col("f") >= least)
    words, bits = numbered(frequent)
    words = staged(words, "numbered")
    rated = staged(scored(counted(shards, words, vocabulary, bits, least), words, bits, share), "scored")
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # The best of a language are among the best of its parts; then at most SALTS * top rows meet.
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    some = rated.withColumn("_s", salt).withColumn("_k", F.row_number().over(W.partitionBy("lang", "_s").orderBy(*best))).where(F.col("_k") <= top)
    ranked = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    totals = shards.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
