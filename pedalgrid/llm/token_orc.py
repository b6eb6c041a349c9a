"""Token ids in ORC files: run-length coded integers in stripes, row indexes, Bloom filters on the id.

Documents are dealt by ranges of ``doc_id`` and sorted in each part, so the files follow the order
of ids, every stripe covers a short range of ids, and a lookup by id skips all other stripes.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

STRIPE_BYTES = 16 << 20
INDEX_ROWS = 1_000
#: Words whose ids one Python worker remembers, twice over: an older half goes when a newer one is full.
MEMORY = 600_000
#: Characters of the texts that are looked up together, and words that are merged in one call.
STEP_CHARS = 4 << 20
STEP_WORDS = 200
LAYOUT = "doc_id long, part int, place long, n_tokens long, ids array<int>"

_state: dict = {}


def _alphabet() -> dict[int, str]:
    """Bytes as the byte-level vocabulary spells them: printable ones as themselves, the others from 256 up."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(256 + k) for k, b in enumerate(others)}


_ALPHABET = _alphabet()
#: Stands between words that are merged in one call: this byte is in no UTF-8 text, so no merge has it.
_BETWEEN = b"\xff"


class Encoder:
    """Whole texts to ids, each distinct word given to the library once as long as it is remembered.

    A text is cut where the pre-tokenizer always cuts as well: before a lone blank that stands between
    words, after a line end, and between a letter and the marks behind it. Texts with two blanks in a row
    are cut only before spaces that follow a word.
    """

    #: Blanks side by side can belong to one token.
    _odd = re.compile(r"\s\s")
    _marks = ".,;:!?|*#$%&"
    _marked = re.compile(r"(.*[^\W\d_])([.,;:!?|*#$%&]+)", re.S)
    #: Letters below this are letters in every version of Unicode.
    _latin = "\u0250"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.between = self.tokenizer.token_to_id(_BETWEEN.decode("latin-1"))
        #: A model that takes words it knows without merges needs them one by one.
        self.step = 1 if getattr(self.model, "ignore_merges", False) else STEP_WORDS
        #: A word after a space is remembered without it; any other part after a zero character.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _is_odd(self, text: str) -> bool:
        return not text or "\0" in text or self._odd.search(text) is not None

    def _cut_odd(self, text: str) -> list[str]:
        return ["\0" + p for p in re.split(r"(?<=\S)(?= )", text)] if text else []

    def _ids(self, part: str) -> bytes:
        if self._is_word(part):  # one pre-token: straight to the merges, in the byte alphabet
            return array("I", [t.id for t in self.model.tokenize(part.encode().decode("latin-1").translate(_ALPHABET))]).tobytes()
        if part[:1] == "\n" and len(part) > 1 and not part[1].isspace():
            return self._ids("\n") + self._ids(part[1:])
        if m := self._marked.fullmatch(part):
            head = m[1]
            found = self.known.get(head[1:]) if head[:1] == " " and self._is_word(head) else None
            return (self._ids(head) if found is None else found) + self._mark(m[2])
        return array("I", self.tokenizer.encode(part, add_special_tokens=False).ids).tobytes()

    def _is_word(self, part: str) -> bool:
        core = part[1:] if part[:1] == " " else part
        return core.isalpha() and (core.isascii() or max(core) < self._latin)

    def _mark(self, mark: str) -> bytes:
        found = self.known.get("\0" + mark)
        if found is None:
            found = self.known["\0" + mark] = array("I", self.tokenizer.encode(mark, add_special_tokens=False).ids).tobytes()
        return found

    def _whole(self, key: str) -> bytes:
        return self._ids(key[1:] if key[:1] == "\0" else key if key[:1] == "\n" else " " + key)

    def _merge(self, words: list[str]) -> None:
        """Remember the ids of words that are pre-tokens: several go to the merges as one sequence."""
        for at in range(0, len(words), self.step):
            some = words[at : at + self.step]
            spelled = "\0".join([k[1:] if k[:1] == "\0" else " " + k for k in some]).encode().replace(b"\0", _BETWEEN).decode("latin-1")
            for byte, letter in _ALPHABET.items():
                spelled = spelled.replace(chr(byte), letter)
            ids = np.array([t.id for t in self.model.tokenize(spelled)], "<u4")
            cuts = np.flatnonzero(ids == self.between) if self.between is not None else []
            if len(cuts) != len(some) - 1:
                self.known.update((k, self._whole(k)) for k in some)
                continue
            raw, start = ids.tobytes(), 0
            for key, end in zip(some, [*(4 * c for c in cuts), len(raw)]):
                self.known[key] = raw[start:end]
                start = end + 4

    def _learn(self, keys: list[str]) -> None:
        """Remember the ids of parts; marks and line ends are set aside, so that a word is merged once whatever stands beside it."""
        known, older = self.known, self.older
        words, beside = set(), []
        marks, latin = self._marks, self._latin
        for key in keys:
            found = older.get(key)
            if found is not None:
                known[key] = found
                continue
            led = key[:1] == "\n" and len(key) > 1 and not key[1].isspace()
            core = "\0" + key[1:] if led else key
            stem = core.rstrip(marks)
            word = stem[1:].removeprefix(" ") if stem[:1] == "\0" else stem
            if not (word.isalpha() and (word.isascii() or max(word) < latin)):
                known[key] = self._whole(key)
                continue
            if stem != key:
                beside.append((key, led, stem, core[len(stem) :]))
            if stem not in known:
                found = older.get(stem)
                if found is None:
                    words.add(stem)
                else:
                    known[stem] = found
        self._merge(list(words))
        for key, led, stem, mark in beside:
            ids = known[stem] + self._mark(mark) if mark else known[stem]
            known[key] = self._mark("\n") + ids if led else ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        found, start, size = [], 0, 0
        for end, text in enumerate(texts):
            size += len(text)
            if size >= STEP_CHARS:
                found += self._some(texts[start : end + 1])
                start, size = end + 1, 0
        return found + self._some(texts[start:])

    def _some(self, texts: list[str]) -> list[bytes]:
        odd = {i: self._cut_odd(t) for i, t in enumerate(texts) if self._is_odd(t)}
        rest = pa.array(["\0" + t.replace("\n", " \n") for i, t in enumerate(texts) if i not in odd], pa.large_string())
        parts = pc.split_pattern(rest, " ")
        codes = parts.flatten().dictionary_encode()
        keys = codes.dictionary.to_numpy(zero_copy_only=False).tolist()
        wanted = list(set(keys).union(*odd.values())) if odd else keys
        if len(self.known) + len(wanted) > MEMORY:
            self.known, self.older = {}, self.known
        self._learn([k for k in wanted if k not in self.known])
        get = self.known.__getitem__
        ids = list(map(get, keys))
        # Ids of all parts in a row: each part's range of the distinct parts' ids.
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = np.cumsum(sizes) - sizes
        place = codes.indices.to_numpy()
        each = sizes[place]
        ends = np.cumsum(each)
        at = np.repeat(starts[place] - (ends - each), each)
        at += np.arange(len(at))
        raw = np.frombuffer(b"".join(ids), "<u4")[at].tobytes()
        bounds = (4 * np.concatenate([[0], ends]))[parts.offsets.to_numpy()].tolist()
        even = iter([raw[a:b] for a, b in zip(bounds, bounds[1:])])
        return [b"".join(map(get, odd[i])) if i in odd else next(even) for i in range(len(texts))]


def encoder(path: str) -> Encoder:
    if path not in _state:
        _state[path] = Encoder(path)
    return _state[path]


def _encode(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, place, end = TaskContext.get().partitionId(), 0, np.array([end_id], "<u4").tobytes()
    coder = encoder(path)
    for batch in batches:
        for at in range(0, batch.num_rows, 1_000):
            some = batch.slice(at, 1_000)
            ids = [x + end for x in coder.encode([t or "" for t in some["text"].to_pylist()])]
            n = np.array([len(x) // 4 for x in ids], np.int64)
            values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), values)
            where = np.arange(place, place + len(n))
            place += len(n)
            yield pa.RecordBatch.from_arrays(
                [some["doc_id"], pa.array(np.full(len(n), part, np.int32)), pa.array(where), pa.array(n), lists],
                ["doc_id", "part", "place", "n_tokens", "ids"],
            )
    coder.older = {}  # other operators' tasks run in this worker next


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Encode every text and write ``doc_id, part, place, n_tokens, ids`` as ORC in ascending order of id.

    Null texts are empty and give the end id alone. Null ids come first; rows that repeat an id stay
    next to each other. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    encoded = dealt.mapInArrow(lambda batches: _encode(batches, tokenizer, end_id), LAYOUT)
    writer = encoded.write.option("compression", "zstd").option("orc.stripe.size", STRIPE_BYTES)
    writer = writer.option("orc.create.index", "true").option("orc.row.index.stride", INDEX_ROWS)
    writer.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files as written; filters on ``doc_id`` reach stripes and row groups."""
    return spark.read.schema(LAYOUT).orc(path)


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch["ids"]
        raw = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        ends = lists.offsets.to_numpy()
        sums = [zlib.crc32(raw[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        n = pc.list_value_length(lists).cast(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["part"], batch["place"], n, pa.array(sums, pa.int64())],
            ["doc_id", "part", "place", "n_tokens", "ids_crc32"],
        )


def summary(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of a token table: where each document begins in the stream of all ids."""
    rows = tokens.mapInArrow(_checksums, "doc_id long, part int, place long, n_tokens long, ids_crc32 long")
    # One row per file: the ids in the files before it.
    sizes = tokens.groupBy("part").agg(F.sum("n_tokens").alias("in_part"))
    before = F.coalesce(F.sum("in_part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select(F.col("part").alias("of_part"), before.alias("before"))
    own = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(own), F.lit(0)))
    return placed.join(offsets, placed["part"] == offsets["of_part"]).select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
