"""Personal data by fixed patterns and a semi-Markov conditional random field over what surrounds them.

The patterns give the base spans. Stretches of text with digits or an at sign are cut into tokens;
a semi-Markov field scores whole segments of them as e-mail, IP, card or phone by features of the span
as a whole, and a dynamic program over segments of bounded length picks borders and kinds together.
Base spans are held fixed in it; the other segments it picks are added. Its weights are learned from
base spans of a bounded sample of the same documents, and from altered copies of them.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate, zip_longest
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Bounds of what the field is fitted on: distinct texts, stretches of each, characters of a stretch, stretches of one
#: shape, and examples in all, dealt out evenly over what kinds of spans they hold.
SAMPLE = 1_500
PER_DOCUMENT = 5
LONGEST_EXAMPLE = 120
PER_SHAPE = 4
EXAMPLES = 600
#: Tokens of a segment, at most; a base span may be longer.
LONGEST = 16
#: Tokens whose segments are scored at once; only scores and back pointers of a stretch are kept.
STEP_TOKENS = 256
#: A segment is added only if it beats leaving its tokens alone by this much.
MARGIN = 2.0
ROUNDS = 60

# The patterns of the contract.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
# The first two tried at every place of a long run would read it again each time; their parts are matched once instead.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_MAIL_RUN = re.compile(r"[A-Za-z0-9._%+@-]+")
_DIGIT_RUN = re.compile(r"[+(0-9][+0-9().\x20-]*")
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|.", re.S)

Span = tuple[int, int, int]  # start, kind, end: sorts as the contract wants


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = int(c) * (1 + place % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _valid(kind: int, text: str) -> bool:
    if kind == 1:
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in text.split("."))
    if kind == 2:
        return 12 <= len(d := _digits(text)) <= 19 and luhn(d)
    return kind == 0 or 9 <= len(_digits(text)) <= 15


def stretches(text: str) -> list[tuple[int, int]]:
    """Where any kind can stand: whole runs of the characters of e-mails with an at sign, and of numbers."""
    found = []
    at = text.find("@")
    while at >= 0:
        first = at
        while first > 0 and _MAIL_RUN.fullmatch(text[first - 1]):
            first -= 1
        last = _MAIL_RUN.match(text, first).end()
        found.append((first, last))
        at = text.find("@", last)
    found += [m.span() for m in _DIGIT_RUN.finditer(text) if m.end() - m.start() >= 7]
    return sorted(found)


def _emails(part: str) -> Iterator[tuple[int, int]]:
    """Matches of ``EMAIL``: an at sign, the run of local characters before it, and the domain behind it."""
    first = 0
    at = part.find("@")
    while at >= 0:
        # The local part cannot hold an at sign, so it starts behind the last one, or behind the last match.
        local = at - len(_LOCAL.match(part[first:at][::-1])[0])
        domain = _DOMAIN.match(part, at)
        if local < at and domain:
            yield local, domain.end()
            first = domain.end()
        else:
            first = at + 1
        at = part.find("@", first)


def _quads(part: str) -> Iterator[tuple[int, int]]:
    """Matches of ``IP``: of numbers joined by dots, four at a time."""
    for run in _DOTTED.finditer(part):
        borders = [run.start() - 1, *(m.start() for m in re.finditer(r"\.", run[0])), len(run[0])] if "." in run[0] else []
        ends = [run.start() + x for x in borders[1:]]
        starts = [run.start(), *(x + 1 for x in ends[:-1])]
        for k in range(0, len(ends) - 3, 4):
            yield starts[k], ends[k + 3]


def _matches(kind: int, part: str) -> Iterator[tuple[int, int]]:
    if kind < 2:
        return _emails(part) if kind == 0 else _quads(part)
    return (m.span() for m in (CARD if kind == 2 else PHONE).finditer(part))


def base_spans(text: str) -> list[Span]:
    """Matches of the four patterns, leftmost and without overlap per kind, less those that fail their check."""
    spans = set()
    for a, b in stretches(text):
        part = text[a:b]
        kinds = (0,) if "@" in part else (1, 2, 3)
        spans |= {(a + first, k, a + last) for k in kinds for first, last in _matches(k, part) if _valid(k, part[first:last])}
    return sorted(spans)


FEATURES = 34


def features(part: str, first: int, last: int, bare: int | None = None) -> np.ndarray:
    """Of the whole span ``part[first:last]`` in its stretch; ``bare`` is the stretch's length without blanks and dots at its end."""
    bare = len(part.rstrip(" .")) if bare is None else bare
    span = part[first:last]
    digits, f = _digits(span), np.zeros(FEATURES)
    n = len(digits)
    local, _, domain = span.partition("@")
    groups = re.split(r"\.", span)
    quads = len(groups) == 4 and all(g.isascii() and g.isdigit() for g in groups)
    f[0] = 1
    f[1 + (n > 0) + (n > 6) + (n > 8) + (n > 9) + (n > 11) + (n > 12) + (n > 15) + (n > 19)] = 1
    f[10] = span.count("@") == 1 and bool(local) and "." in domain and not domain.startswith(".") and not domain.endswith(".")
    f[11] = "@" in span and not f[10]
    f[12] = quads and all(len(g) <= 3 and int(g) <= 255 for g in groups)
    f[13] = quads and not f[12]
    f[14] = span.startswith("+")
    f[15] = n > 11 and luhn(digits)
    f[16] = n > 11 and not luhn(digits)
    f[17] = bool(re.fullmatch(r"[0-9]+", span))
    f[18] = bool(re.fullmatch(r"\+?[0-9]{0,3}[ .-]?\([0-9]{2,4}\)[ .-]?[0-9]{3}[ .-][0-9]{4}", span))
    f[19] = bool(re.fullmatch(r"[0-9]{4}([ -][0-9]{4}){2,3}", span))
    f[20] = not span[:1].isalnum() and span[:1] not in "+("
    f[21] = not span[-1:].isalnum()
    f[22] = first > 0 and part[first - 1].isalnum() and span[:1].isalnum()
    f[23] = last < len(part) and part[last].isalnum() and span[-1:].isalnum()
    f[24] = first == 0 or part[first - 1] == " "
    f[25] = last == bare or part[last : last + 1] == " "
    f[26] = " " in span
    f[27] = span.count(".") == 1 and n > 0 and "@" not in span
    f[28] = len(span) > 40
    f[29] = span.count("(") != span.count(")")
    f[30] = f[15] and f[24] and f[25]
    f[31] = f[18] and f[24] and f[25]
    f[32] = f[14] and 8 < n < 16
    f[33] = f[14] and not f[32]
    return f


class Lattice:
    """All segments of a stretch: single tokens outside, or up to ``LONGEST`` tokens of a kind."""

    def __init__(self, part: str, gold: list[Span] = ()):
        self.ends = [0, *(m.end() for m in _TOKEN.finditer(part))]
        where = {e: k for k, e in enumerate(self.ends)}
        n = len(self.ends) - 1
        fixed = [(where[a], kind, where[b]) for a, kind, b in gold if a in where and b in where]
        spans = {(i, j) for j in range(1, n + 1) for i in range(max(0, j - LONGEST), j)} | {(i, j) for i, _, j in fixed}
        self.spans = sorted(spans, key=lambda s: (s[1], s[0]))
        self.rows = np.array([features(part, self.ends[i], self.ends[j]) for i, j in self.spans]).reshape(-1, FEATURES)
        self.n, self.fixed = n, fixed

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return self.rows @ weights


def best(lattice: Lattice, scores: np.ndarray, held: list[tuple[int, int]] = ()) -> list[tuple[int, int, int, float]]:
    """The segments ``first, kind, last, score`` of the best path; none of them meets the token ranges ``held``."""
    total = np.full(lattice.n + 1, -np.inf)
    total[0], back = 0, [None] * (lattice.n + 1)
    for (i, j), row in zip(lattice.spans, scores):
        if j == i + 1 and total[i] > total[j]:
            total[j], back[j] = total[i], (i, -1, 0.0)
        if any(a < j and i < b for a, b in held):
            continue
        k = int(row.argmax())
        if total[i] + row[k] > total[j]:
            total[j], back[j] = total[i] + row[k], (i, k, float(row[k]))
    path, at = [], lattice.n
    while at > 0:
        i, k, score = back[at]
        if k >= 0:
            path.append((i, k, at, score))
        at = i
    return path[::-1]


def best_in_steps(part: str, weights: np.ndarray, inside: list[Span] = ()) -> Iterator[tuple[int, int, int, float]]:
    """What ``best`` gives for the whole lattice, last segment first and with places in ``part`` for tokens.

    Segments are scored some tokens at a time, so a stretch of any length takes a few numbers for each
    token. No segment meets the spans ``inside``.
    """
    ends = array("q", [0])
    ends.extend(m.end() for m in _TOKEN.finditer(part))
    n, bare = len(ends) - 1, len(part.rstrip(" ."))
    places, held = np.frombuffer(ends, np.int64), np.zeros(n, bool)
    for x, _, y in inside:
        held[np.searchsorted(places, x, "right") - 1 : np.searchsorted(places, y)] = True
    # The last held token before each border.
    bars = np.concatenate([[-1], np.maximum.accumulate(np.where(held, np.arange(n), -1))])
    total, back = array("d", [0.0]) + array("d", [-np.inf]) * n, array("q", [0]) * (n + 1)
    kinds, won = array("b", [-1]) * (n + 1), array("d", [0.0]) * (n + 1)
    for begin in range(1, n + 1, STEP_TOKENS):
        spans = [(i, j) for j in range(begin, min(begin + STEP_TOKENS, n + 1)) for i in range(max(0, j - LONGEST), j)]
        scores = np.array([features(part, ends[i], ends[j], bare) for i, j in spans]) @ weights
        for (i, j), k, score in zip(spans, scores.argmax(axis=1).tolist(), scores.max(axis=1).tolist()):
            if j == i + 1 and total[i] > total[j]:
                total[j], back[j], kinds[j], won[j] = total[i], i, -1, 0.0
            if bars[j] < i and total[i] + score > total[j]:
                total[j], back[j], kinds[j], won[j] = total[i] + score, i, k, score
    at = n
    while at > 0:
        if kinds[at] >= 0:
            yield ends[back[at]], kinds[at], ends[at], won[at]
        at = back[at]


def _expected(lattice: Lattice, scores: np.ndarray) -> np.ndarray:
    """Probability of each segment and kind under the field, by sums over all paths from both sides."""
    n = lattice.n
    left, right = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    left[0] = right[n] = 0
    mass = np.logaddexp.reduce(scores, axis=1)
    arcs = [(i, j, np.logaddexp(m, 0) if j == i + 1 else m) for (i, j), m in zip(lattice.spans, mass)]
    for i, j, m in arcs:
        left[j] = np.logaddexp(left[j], left[i] + m)
    for i, j, m in sorted(arcs, key=lambda a: -a[0]):
        right[i] = np.logaddexp(right[i], right[j] + m)
    ends = np.array([left[i] + right[j] for i, j, _ in arcs])
    return np.exp(scores + ends[:, None] - left[n])


def fit(examples: list[tuple[str, list[Span]]], rounds: int = ROUNDS) -> np.ndarray:
    """Weights (features by kinds) that make the given segmentations likely; AdaGrad on the whole set."""
    weights = np.zeros((FEATURES, len(KINDS)))
    lattices = []
    for part, gold in examples:
        lattice = Lattice(part, gold)
        want = np.zeros((len(lattice.spans), len(KINDS)))
        at = {s: k for k, s in enumerate(lattice.spans)}
        for i, kind, j in lattice.fixed:
            want[at[i, j], kind] = 1
        lattices.append((lattice, want))
    seen = np.full(weights.shape, 1e-6)
    for _ in range(rounds if lattices else 0):
        slope = -0.02 * weights
        for lattice, want in lattices:
            slope += lattice.rows.T @ (want - _expected(lattice, lattice.scores(weights)))
        seen += slope**2
        weights += 0.7 * slope / np.sqrt(seen)
    return weights


def _altered(part: str, gold: list[Span]) -> list[tuple[str, list[Span]]]:
    """The example and copies of it: a phone without its country code, numbers with one digit changed."""
    out = [(part, gold)]
    for a, kind, b in gold[:1]:
        span = part[a:b]
        if kind == 3 and (m := re.match(r"\+[0-9]+ (?=\()", span)):
            out.append((part[:a] + span[m.end() :] + part[b:], [(a, 3, b - m.end())]))
        if kind == 2:
            wrong = span[:-1] + str((int(span[-1]) + 1) % 10)
            out.append((part[:a] + wrong + part[b:], []))
        if kind == 1:
            out.append((part[:a] + span.replace(".", ".9", 1).replace(".9", ".999", 1) + part[b:], []))
            out.append((part[:a] + span[: span.rindex(".")] + part[b:], []))
    return out


def _plain(spans: list[Span]) -> list[Span]:
    """Spans without overlap, earlier and longer ones first, as one segmentation can hold them."""
    out: list[Span] = []
    for s in sorted(spans, key=lambda s: (s[0], -s[2])):
        if not out or s[0] >= out[-1][2]:
            out.append(s)
    return out


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts, spans = [], []
        for text in batch["text"].to_pylist():
            base = base_spans(text)
            for a, b in [s for s in stretches(text) if s[1] - s[0] <= LONGEST_EXAMPLE][:PER_DOCUMENT]:
                parts.append(text[a:b])
                spans.append([x for s in _plain(base) if a <= s[0] and s[2] <= b for x in (s[0] - a, s[1], s[2] - a)])
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.string()), pa.array(spans, pa.list_(pa.int32()))], ["part", "spans"])


def train(docs: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights from at most ``sample`` distinct texts with a digit or an at sign, the lowest by hash; all 0 without any.

    Copies are one text. ``PER_DOCUMENT``, ``LONGEST_EXAMPLE``, ``PER_SHAPE`` and ``EXAMPLES`` bound what is taken of them.
    """
    usable = docs.select("text").where(F.col("text").rlike(r"@|[0-9][0-9().\x20-]{5}")).withColumn("rank", F.xxhash64("text"))
    # Twice the share of texts that is needed, so that tasks send a bounded number of texts between them.
    known = usable.agg(F.approx_count_distinct("rank")).first()[0]
    share = min(1.0, 2 * sample / max(1, known))
    few = usable.where(F.pmod("rank", F.lit(1_000_000)) < int(1_000_000 * share) + 1).dropDuplicates(["rank"])
    picked = few.orderBy("rank").limit(sample).select("text")
    found = sorted((r["part"], tuple(r["spans"])) for r in picked.mapInArrow(_examples, "part string, spans array<int>").collect())
    # Stretches of the same shape teach the same: keep a few of each.
    shapes: dict[str, int] = {}
    examples: dict[tuple[int, ...], list] = {}
    for part, flat in sorted(found, key=lambda x: (crc32(x[0].encode()), x)):
        shape = re.sub("[0-9]", "0", re.sub("[A-Za-z]+", "a", part)) + str(flat[1::3])
        shapes[shape] = shapes.get(shape, 0) + 1
        if shapes[shape] <= PER_SHAPE:
            for example in _altered(part, list(zip(flat[::3], flat[1::3], flat[2::3]))):
                examples.setdefault(tuple(sorted({s[1] for s in example[1]})), []).append(example)
    # In turn from each combination of kinds, so that none is crowded out by one that is frequent.
    turns = [e for row in zip_longest(*(examples[k] for k in sorted(examples))) for e in row if e is not None]
    return fit(turns[:EXAMPLES])


def spans_of(text: str, weights: np.ndarray) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans with those that the field adds."""
    base = base_spans(text)
    starts, furthest = [x[0] for x in base], list(accumulate((x[2] for x in base), max))
    added: list[Span] = []
    for a, b in stretches(text):
        near = base[bisect_left(starts, a) : bisect_left(starts, b)]
        inside = [(s[0] - a, s[1], s[2] - a) for s in near if s[2] <= b]
        found = []
        for first, kind, last, score in best_in_steps(text[a:b], weights, inside):
            first, last = a + first, a + last
            under, over = bisect_left(starts, last), bisect_left(added, (last,))
            if score >= MARGIN and not (under and furthest[under - 1] > first) and not (over and added[over - 1][2] > first):
                found.append((first, kind, last))
        added = sorted(added + found) if found and added and found[-1] < added[-1] else added + found[::-1]
    return base, sorted(base + added)


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _find(batches: Iterator[pa.RecordBatch], weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, base_text, all_text = [], [], []
        for text in batch["text"].to_pylist():
            base, everything = spans_of(text or "", weights)
            counts.append([sum(s[1] == k for s in base) for k in range(len(KINDS))])
            base_text.append(_joined(base))
            all_text.append(_joined(everything))
        numbers = np.array(counts, np.int64).reshape(-1, len(KINDS))
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], *map(pa.array, numbers.T), pa.array(base_text, pa.string()), pa.array(all_text, pa.string())],
            ["doc_id", *[f"n_{k}" for k in KINDS], "base", "spans"],
        )


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base, spans`` for every row of ``docs``.

    Counts and ``base`` are of the patterns alone, ``spans`` holds the added ones too; each span is
    ``kind:start:end`` in code points. Null texts are empty and have none. Repeated rows are read
    each; other columns are not read.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    weights = train(rows)
    layout = f"doc_id {dict(docs.dtypes)['doc_id']}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base string, spans string"
    return rows.mapInArrow(lambda b: _find(b, weights), layout)


def digest(found: DataFrame) -> DataFrame:
    """``find`` with the base spans as a SHA-256."""
    return found.withColumn("base_sha256", F.sha2("base", 256)).drop("base")
