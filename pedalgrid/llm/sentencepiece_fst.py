"""SentencePiece encoding and decoding as a weighted transducer.

The model's file is compiled once into three parts: a normaliser (dummy prefix, blanks to the meta
symbol), a lexicon of pieces, and byte arcs for characters that no piece has. Each input is composed
with them into a lattice over its character positions, and the path of least weight in the tropical
semiring (least sum) gives the ids.

In a unigram model an arc weighs the negative score of its piece. In a byte-pair model a piece may
follow another only if merging their joint text gives exactly these two; all other pairs weigh
infinity, and one path is left, the one that the merges would make (``pair_lattice``). A character that is in no piece
with any other, and a blank after another character, part the lattice; what lies between is an input of
its own. The distinct inputs of a step are composed with the lexicon together, each once.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalgrid.llm.common import steps, strings
from pedalgrid.llm.pair_lattice import PairLattice

META = "▁"
#: Pairs that one Python worker remembers, and texts of inputs for unigram models.
MEMORY = 100_000
#: Text bytes whose inputs are composed together, and distinct inputs of one lattice.
STEP_BYTES = 1 << 22
INPUTS = 1 << 15
#: Longer inputs are searched alone, so that many short ones do not wait for the positions of one.
LONG = 200
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2

_SINGLE = (1,)
_state: dict = {}


class Transducer:
    """``pieces``: text, score and type of each id."""

    def __init__(self, pieces: list[tuple[str, float, int]], kind: int, dummy_prefix: bool = True):
        self.kind, self.dummy_prefix = kind, dummy_prefix
        self.lexicon = {p: (k, s) for k, (p, s, t) in enumerate(pieces) if t in (NORMAL, USER)}
        self.coded = {p: array("i", [k]).tobytes() for p, (k, _) in self.lexicon.items()}
        self.bytes = {int(p[1:-1], 16): k for k, (p, _, t) in enumerate(pieces) if t == BYTE}
        self.unknown = next((k for k, (_, _, t) in enumerate(pieces) if t == UNKNOWN), 0)
        lowest = min((s for s in (x[1] for x in self.lexicon.values()) if s > -1e8), default=0.0)
        self.unknown_cost = 10.0 - lowest
        self.surface = [p.encode() if t in (NORMAL, USER) else bytes([int(p[1:-1], 16)]) if t == BYTE else " ⁇ ".encode() if t == UNKNOWN else b"" for p, _, t in pieces]
        inner = any(META in p.lstrip(META) for p in self.lexicon)
        self.cut_blanks = not inner
        self.cut_lines = bool(self.bytes) and not any("\n" in p and len(p) > 1 for p in self.lexicon)
        self.follows: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}

    @classmethod
    def from_file(cls, path: str) -> Transducer:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        normal, trained = model.normalizer_spec, model.trainer_spec
        if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces or trained.treat_whitespace_as_suffix:
            raise ValueError("only the identity normaliser with escaped blanks before words is compiled")
        return cls([(p.piece, p.score, p.type) for p in model.pieces], trained.model_type, normal.add_dummy_prefix)

    # Compiled when first asked for: decoding needs none of them.

    @functools.cached_property
    def pairs(self) -> PairLattice:
        return PairLattice(self.lexicon)

    @functools.cached_property
    def starts(self) -> tuple[dict[str, tuple[int, ...]], ...]:
        """The arcs that can leave a position, by its next four characters, or three, or two: sizes of pieces, longest
        first. Sizes up to four are of pieces that are there, longer ones are to be tried."""
        starts: tuple[dict[str, tuple[int, ...]], ...] = ({}, {}, {})
        longer: dict[str, set[int]] = {}
        for p in self.lexicon:
            longer.setdefault(p[:4], set()).add(len(p))
        for key, sizes in longer.items():
            sizes = {k for k in sizes if k >= 4} | {k for k in (2, 3) if key[:k] in self.lexicon and len(key) >= k} | {1}
            if len(key) > 1:
                starts[4 - len(key)][key] = tuple(sorted(sizes, reverse=True))
        return starts

    @functools.cached_property
    def inner(self) -> set[str]:
        """Neighbours inside any piece: between others no piece reaches across."""
        return {p[k : k + 2] for p in self.lexicon for k in range(len(p) - 1)}

    # --- the lattice of one input ---------------------------------------------------------------

    def merged(self, text: str) -> list[str]:
        """What byte-pair merging makes of a short text: the best-scored neighbours first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, where = -math.inf, -1
            for k in range(len(parts) - 1):
                found = self.lexicon.get(parts[k] + parts[k + 1])
                if found is not None and found[1] > best:
                    best, where = found[1], k
            if where < 0:
                break
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        return parts

    def may_follow(self, left: str, right: str) -> bool:
        """Whether the pair acceptor has a finite arc; with no left piece, whether the piece exists on its own."""
        found = self.follows.get((left, right))
        if found is None:
            if len(self.follows) > MEMORY // 2:
                self.follows.clear()
            found = self.merged(left + right) == ([left, right] if left else [right])
            self.follows[left, right] = found
        return found

    def leaving(self, text: str, at: int) -> tuple[int, ...]:
        """Sizes of the arcs that may leave a position, longest first."""
        four, three, two = self.starts
        key = text[at : at + 4]
        return four.get(key) or three.get(key[:3]) or two.get(key[:2], _SINGLE)

    def _pair_path(self, text: str) -> list[str]:
        """The only path of finite weight through the pair acceptor, longest arcs first. The text up to a
        position has one such path, so a position that leads nowhere is never tried again."""
        n, lexicon, follows = len(text), self.lexicon, self.follows
        four, three, two = self.starts
        at, before, turn, sizes = 0, "", 0, None
        trail: list[tuple[int, str, int, tuple[int, ...]]] = []
        out: list[str] = []
        dead: set[int] = set()
        while at < n:
            if sizes is None:
                key = text[at : at + 4]
                sizes = four.get(key) or three.get(key[:3]) or two.get(key[:2], _SINGLE)
            for turn in range(turn, len(sizes)):
                size = sizes[turn]
                end = at + size
                if end > n or end in dead:
                    continue
                piece = text[at:end]
                if size > 4 and piece not in lexicon:
                    continue
                good = follows.get((before, piece))
                if good if good is not None else self.may_follow(before, piece):
                    trail.append((at, before, turn + 1, sizes))
                    out.append(piece)
                    at, before, turn, sizes = end, piece, 0, None
                    break
            else:
                dead.add(at)
                at, before, turn, sizes = trail.pop()
                out.pop()
        return out

    def _least_path(self, text: str) -> list[str]:
        """The path whose scores add up to the most."""
        n = len(text)
        cost, back = [0.0] + [math.inf] * n, [0] * (n + 1)
        for start in range(n):
            for size in self.leaving(text, start):
                end = start + size
                if end > n:
                    continue
                found = self.lexicon.get(text[start:end])
                if found is None and size > 1:
                    continue
                weight = cost[start] + (-found[1] if found is not None else self.unknown_cost)
                if weight < cost[end]:
                    cost[end], back[end] = weight, start
        out = []
        while n > 0:
            out.append(text[back[n] : n])
            n = back[n]
        return out[::-1]

    def path(self, text: str) -> list[str]:
        """Texts of the arcs of the least path over a normalised input."""
        return self._pair_path(text) if self.kind == BPE else self._least_path(text)

    def output(self, text: str) -> bytes:
        """Ids on the least path; a character without a piece gives its bytes, or one unknown per run of such."""
        coded = self.coded
        try:
            return b"".join([coded[p] for p in self.path(text)])
        except KeyError:
            return self._ids(self.path(text))

    def _ids(self, path: list[str]) -> bytes:
        ids: list[int] = []
        for part in path:
            found = self.lexicon.get(part)
            if found is not None:
                ids.append(found[0])
            elif self.bytes:
                ids += [self.bytes[b] for b in part.encode()]
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
        return array("i", ids).tobytes()

    # --- whole texts ----------------------------------------------------------------------------

    def _cut(self, text: str) -> list[str]:
        """Parts of the normalised text that no piece spans. Words after one blank go without their meta symbol,
        as ``normal`` restores it; lines and odd blanks carry what they need."""
        if self.cut_blanks and self.cut_lines and self.dummy_prefix and text[:1] not in ("", " ") and META not in text and "\0" not in text and "  " not in text and " \n" not in text:
            return text.replace("\n", " \n").split(" ")
        whole = text.replace(" ", META)
        whole = META + whole if self.dummy_prefix and whole else whole
        if not self.cut_blanks:
            return ["\0" + whole] if whole else []
        return ["\0" + p for p in re.findall(f"{META}*[^{META}]+|{META}+", whole)]

    @staticmethod
    def normal(part: str) -> str:
        return part[1:] if part[:1] == "\0" else part if part[:1] == "\n" else META + part

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        cut = [self._cut(t) for t in texts]
        wanted = set().union(*cut)
        if self.kind == BPE:
            known = self._together(list(wanted))
        else:
            if len(self.known) + len(wanted) > MEMORY:
                self.known = {}
            for part in wanted - self.known.keys():
                self.known[part] = self._coded(self.normal(part))
            known = self.known
        return [b"".join(map(known.__getitem__, c)) for c in cut]

    def _together(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of distinct parts of a byte-pair model, by lattices of many parts."""
        known = {}
        for first in range(0, len(parts), INPUTS):
            some = parts[first : first + INPUTS]
            texts = [self.normal(p) for p in some]
            short = [k for k, t in enumerate(texts) if 0 < len(t) <= LONG]
            for part, text in zip(some, texts):
                if not 0 < len(text) <= LONG:
                    known[part] = self._coded(text)
            if not short:
                continue
            inputs = [texts[k] for k in short]
            symbols, borders, ends = self.pairs.paths(inputs, self.may_follow)
            ids = self.pairs.ids[symbols]
            # Characters without a piece are spelled out.
            missing = np.add.reduceat(ids < 0, borders[:-1]) > 0
            data, at = ids.astype("<i4").tobytes(), (4 * borders).tolist()
            origin = 0
            for k, (one, text) in enumerate(zip(short, inputs)):
                known[some[one]] = data[at[k] : at[k + 1]] if not missing[k] else self._spelled(text, [0, *(ends[borders[k] : borders[k + 1]] - origin).tolist()])
                origin += len(text)
        return known

    def _spelled(self, text: str, ends: list[int]) -> bytes:
        return self._ids([text[a:b] for a, b in zip(ends[:-1], ends[1:])])

    def _coded(self, text: str) -> bytes:
        """Ids of a part; last characters that no piece joins to the ones before are inputs of their own."""
        n = len(text)
        while self.bytes and n > 1 and text[n - 2 : n] not in self.inner:
            n -= 1
        if n == len(text):
            return self.output(text)
        head, tail = text[:n], text[n:]
        single = {c: self.output(c) for c in set(tail)}
        return self.output(head) + b"".join(map(single.__getitem__, tail))

    def decode(self, ids: list[int]) -> str:
        """The text of ids: their pieces and bytes, meta symbols as blanks, without the dummy prefix."""
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace").replace(META, " ")
        return text[1:] if self.dummy_prefix and text[:1] == " " else text


def transducer(path: str) -> Transducer:
    if path not in _state:
        _state[path] = Transducer.from_file(path)
    return _state[path]


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = transducer(path)
    for batch in batches:
        for first, last in steps(strings(batch["text"])[1], STEP_BYTES):
            some = batch.slice(first, last - first)
            coded = model.encode([t or "" for t in some["text"].to_pylist()])
            n = np.array([len(x) // 4 for x in coded], np.int64)
            values = pa.array(np.frombuffer(b"".join(coded), "<i4"))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), values)
            yield pa.RecordBatch.from_arrays([some["doc_id"], pa.array(n), lists], ["doc_id", "n_pieces", "ids"])


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_pieces, ids`` for every row and whole text of ``docs``; null and empty texts have no ids.

    Repeated rows are encoded each; other columns are not read.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda b: _encode(b, path), f"doc_id {dict(docs.dtypes)['doc_id']}, n_pieces long, ids array<int>")


def _decode(batches: Iterator[pa.RecordBatch], path: str, keep_text: bool) -> Iterator[pa.RecordBatch]:
    model = transducer(path)
    for batch in batches:
        sizes = pc.fill_null(pc.list_value_length(batch["ids"]), 0).to_numpy(zero_copy_only=False)
        for first, last in steps(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), STEP_BYTES // 4):
            some = batch.slice(first, last - first)
            texts = [model.decode(x or []) for x in some["ids"].to_pylist()]
            out = pa.array(texts, pa.string()) if keep_text else pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([*some.columns, out], [*some.schema.names, "text" if keep_text else "decoded_sha256"])


def decode(coded: DataFrame, path: str, keep_text: bool = True) -> DataFrame:
    """``coded`` with the decoded ``text``, or only its ``decoded_sha256``. Null ids are no ids. A column of that name is replaced."""
    name = "text" if keep_text else "decoded_sha256"
    rows = coded.drop(name)
    layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", {name} string"
    return rows.mapInArrow(lambda b: _decode(b, path, keep_text), layout)


def _there_and_back(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    return _decode(_encode(batches, path), path, False)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_pieces, ids, decoded_sha256``: ``encode``, and the digest of what ``decode`` makes of its ids.

    Both run in one Python process, so a task loads the model once and the ids pass to Spark once.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    layout = f"doc_id {dict(docs.dtypes)['doc_id']}, n_pieces long, ids array<int>, decoded_sha256 string"
    return rows.mapInArrow(lambda b: _there_and_back(b, path), layout)
