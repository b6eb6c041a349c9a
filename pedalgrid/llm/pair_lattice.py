"""Byte-pair lattices of many inputs at once, in arrays.

The lexicon is compiled to a deterministic automaton over characters. All inputs are composed with it side by
side: from every position the automaton is walked until it stops, and each accepting state is an arc of the
lattice. An arc weighs 0 if the pair acceptor lets its piece follow the last piece of the path that it prolongs, and
infinity if not. Every position has exactly one path of finite weight, so the least path is found by one
pass over the positions, for all inputs together, and read off backwards.

The pair acceptor is not stored, it is decided from each piece's own merges. Merging ``left + right`` gives these two
unless at some time a part at the end of ``left`` and one at the start of ``right`` are there, their joint text is a
piece, and its turn comes before either part is merged further. A part is there from the turn in which it
is made to the turn in which it is used up.
"""

from __future__ import annotations

import math

import numpy as np

from pedalgrid.llm.common import mixed

#: Pairs that are decided in one step, and decisions that are remembered; a later pair takes the place of an earlier one.
STEP = 1 << 16
CACHE = 1 << 20
ALWAYS = np.iinfo(np.int64).max


class Table:
    """Whole numbers by whole numbers, looked up many at a time; -1 where there is none."""

    def __init__(self, found: dict[int, int]):
        self.mask = (1 << max(4, (8 * len(found)).bit_length())) - 1
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.values = np.full(self.mask + 1, -1, np.int64)
        keys = np.fromiter(found.keys(), np.int64, len(found))
        values = np.fromiter(found.values(), np.int64, len(found))
        at = self._slot(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # of several for one slot the last one stays
            put = self.keys[at] == keys
            self.values[at[put]] = values[put]
            keys, values, at = keys[~put], values[~put], (at[~put] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys.view(np.uint64)) & np.uint64(self.mask)).astype(np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        out = self.values[at]
        there = self.keys[at]
        left = np.flatnonzero((there != keys) & (there >= 0))
        out[there != keys] = -1
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            there = self.keys[at[left]]
            hit = there == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (there >= 0)]
        return out


class PairLattice:
    """``lexicon``: id and score of each piece."""

    def __init__(self, lexicon: dict[str, tuple[int, float]]):
        turns = {s: k for k, s in enumerate(sorted({s for _, s in lexicon.values()}, reverse=True))}
        turn = {p: turns[s] for p, (_, s) in lexicon.items()}
        taken: dict[int, int] = {}
        for t in turn.values():
            taken[t] = taken.get(t, 0) + 1
        letters = sorted({c for p in lexicon for c in p})
        self.letters = np.zeros(0x110000, np.int32)
        self.letters[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        #: Symbols are the pieces, then the letters that are no piece, then one for all other characters.
        self.names = [*lexicon, *[c for c in letters if c not in lexicon]]
        symbol = {p: k for k, p in enumerate(self.names)}
        self.other = len(symbol)
        self.ids = np.full(self.other + 1, -1, np.int32)
        self.ids[: len(lexicon)] = [k for k, _ in lexicon.values()]
        self.single = np.full(len(letters) + 1, self.other, np.int64)
        self.single[1:] = [symbol[c] for c in letters]
        #: Pieces whose merges do not come in the order of their turns, or share a turn with others, are asked by text.
        self.odd = np.zeros(self.other + 1, bool)
        usable = np.zeros(self.other + 1, bool)
        heads: list[list[tuple[int, int, int]]] = []
        tails: list[list[tuple[int, int, int]]] = []
        for p, k in symbol.items():
            head, tail, whole, plain = self._history(p, turn)
            heads.append([(symbol[x], a, b) for x, a, b in head])
            tails.append([(symbol[x], a, b) for x, a, b in tail])
            usable[k] = whole
            self.odd[k] = not plain or taken.get(turn.get(p, -1), 1) > 1
        self.heads, self.tails = self._spines(heads), self._spines(tails)
        self.joint = Table({symbol[p[:k]] * (self.other + 1) + symbol[p[k:]]: t for p, t in turn.items() for k in range(1, len(p)) if p[:k] in symbol and p[k:] in symbol})
        steps: dict[tuple[int, str], int] = {}
        accepts = [-1]
        for p in lexicon:
            state = 0
            for c in p:
                after = steps.setdefault((state, c), len(accepts))
                if after == len(accepts):
                    accepts.append(-1)
                state = after
            if usable[symbol[p]]:
                accepts[state] = symbol[p]
        self.accepts = np.array(accepts, np.int64)
        self.width = len(letters) + 1
        self.steps = Table({state * self.width + int(self.letters[ord(c)]): after for (state, c), after in steps.items()})
        self.asked = np.full(CACHE, -1, np.int64)
        self.answer = np.zeros(CACHE, bool)

    @staticmethod
    def _history(piece: str, turn: dict[str, int]) -> tuple[list, list, bool, bool]:
        """The parts at the start and at the end of a piece while it is merged by itself, each with the turns in which it
        is made and used up; whether it comes out whole; whether turns only go up."""
        parts = list(piece)
        head, tail = [(parts[0], -1, ALWAYS)], [(parts[-1], -1, ALWAYS)]
        latest, plain = -1, True
        while len(parts) > 1:
            best, where = math.inf, -1
            for k in range(len(parts) - 1):
                found = turn.get(parts[k] + parts[k + 1])
                if found is not None and found < best:
                    best, where = found, k
            if where < 0:
                return head, tail, False, plain
            plain, latest = plain and best >= latest, best
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
            for side, there in ((head, where == 0), (tail, where == len(parts) - 1)):
                if there:
                    side[-1] = (*side[-1][:2], best)
                    side.append((parts[where], best, ALWAYS))
        return head, tail, True, plain

    def _spines(self, sides: list[list[tuple[int, int, int]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each symbol's parts begin, how many it has, and the parts; other characters have none."""
        count = np.array([len(s) for s in sides] + [0], np.int64)
        return np.cumsum(count) - count, count, np.array([x for s in sides for x in s] or np.zeros((0, 3)), np.int64)

    def _decide(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each two symbols stay apart when their joint text is merged."""
        (begin_a, count_a, a), (begin_b, count_b, b) = self.tails, self.heads
        n, m = count_a[left], count_b[right]
        pair = np.repeat(np.arange(len(left)), n * m)
        place = np.arange(len(pair)) - np.repeat(np.cumsum(n * m) - n * m, n * m)
        a, b = a[begin_a[left][pair] + place // m[pair]], b[begin_b[right][pair] + place % m[pair]]
        turn = self.joint[a[:, 0] * (self.other + 1) + b[:, 0]]
        ready = np.maximum(np.maximum(a[:, 1], b[:, 1]), turn)
        # Of equal turns the leftmost goes first: in ``left``, then across, then in ``right``.
        joined = (turn >= 0) & (ready < a[:, 2]) & (ready <= b[:, 2])
        out = np.ones(len(left), bool)
        out[pair[joined]] = False
        return out

    def follows(self, left: np.ndarray, right: np.ndarray, by_text) -> np.ndarray:
        """The pair acceptor: whether each ``right`` may come after its ``left``. ``by_text`` answers for two texts."""
        key = left * (self.other + 1) + right
        slot = (mixed(key.view(np.uint64)) & np.uint64(CACHE - 1)).astype(np.int64)
        out = self.answer[slot]
        new = np.flatnonzero(self.asked[slot] != key)
        for first in range(0, len(new), STEP):
            some = new[first : first + STEP]
            found = self._decide(left[some], right[some])
            odd = (self.odd[left[some]] | self.odd[right[some]]) & (left[some] < self.other) & (right[some] < self.other)
            for k in np.flatnonzero(odd):
                found[k] = by_text(self.names[left[some[k]]], self.names[right[some[k]]])
            out[some] = found
        # Of several for one slot the last one stays, with its answer.
        self.asked[slot[new]] = key[new]
        mine = new[self.asked[slot[new]] == key[new]]
        self.answer[slot[mine]] = out[mine]
        return out

    def paths(self, texts: list[str], by_text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all inputs, none of them empty: the symbols on the least paths, the inputs' borders in them, and where
        each symbol ends in the characters of all inputs."""
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        cells = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        end = np.cumsum(size)
        stop = np.repeat(end, size)
        letter = self.letters[cells].astype(np.int64)
        # Arcs: where they start and end and their symbol. Each character has an arc of its own.
        start = np.arange(len(cells))
        arcs = [(start, start + 1, self.single[letter])]
        live = start[letter > 0]
        state = self.steps[letter[live]]
        for length in range(2, len(cells) + 1):
            there = (state >= 0) & (live + length <= stop[live])
            live, state = live[there], state[there]
            if not len(live):
                break
            state = self.steps[state * self.width + letter[live + length - 1]]
            there = state >= 0
            live, state = live[there], state[there]
            symbol = self.accepts[state]
            hit = symbol >= 0
            arcs.append((live[hit], live[hit] + length, symbol[hit]))
        source, target, symbol = (np.concatenate(x) for x in zip(*arcs))
        begin = stop - np.repeat(size, size)
        depth = target - begin[source]
        order = np.argsort(depth.astype(np.uint16), kind="stable")
        source, target, symbol = source[order], target[order], symbol[order]
        cuts = np.concatenate([[0], np.cumsum(np.bincount(depth))])
        # ``last[t]`` is the last symbol of the only finite path up to the end of character t - 1 in its input.
        last, back = np.full(len(cells) + 1, -1, np.int64), np.zeros(len(cells) + 1, np.int64)
        for a, b in zip(cuts[1:-1], cuts[2:]):
            s, t, x = source[a:b], target[a:b], symbol[a:b]
            first = s == begin[s]
            good = first.copy()
            inner = np.flatnonzero(~first)
            good[inner] = self.follows(last[s[inner]], x[inner], by_text)
            last[t[good]], back[t[good]] = x[good], s[good]
        passed = np.zeros(len(cells) + 1, bool)
        at, home = end, end - size
        while len(at):
            passed[at] = True
            at = back[at]
            inside = at > home
            at, home = at[inside], home[inside]
        ends = np.flatnonzero(passed)
        return last[ends], np.searchsorted(ends, np.concatenate([[0], end]), "right"), ends
