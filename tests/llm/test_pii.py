"""Base spans against the patterns over whole texts, the field against all segmentations."""

import hashlib
import itertools
import random
import time
import tracemalloc

import numpy as np
import pytest

from pedalgrid.llm import pii

HARD = [
    "mail a.b+c@x-y.example.com, or A@b.c@d.e and @x.y z@ q@w",
    "ip 1.2.3.4 10.0.0.256 1.2.3.4.5.6.7.8 0001.2.3.4 999.1.1.1",
    "card 4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 5500005555555559 0000 0000 0000 1",
    "call +1 (434) 555-2368 or +49 30 123456 or +1 2 or ++12 345 678 901, (434) 555-2368",
    "é日😀 +1 (434) 555-2368 é a@b.cd 日 1.2.3.4",
    "1.2.3.4 5.6.7.8 4111111111111111 +1 (434) 555-2368 4111111111111111",
]


def brute(text):
    patterns = ((0, pii.EMAIL), (1, pii.IP), (2, pii.CARD), (3, pii.PHONE))
    return sorted((m.start(), k, m.end()) for k, p in patterns for m in p.finditer(text) if pii._valid(k, m[0]))


@pytest.fixture(scope="module")
def weights():
    draw = random.Random(1)
    examples = []
    for _ in range(60):
        phone = f"+1 ({draw.randint(200, 999)}) 555-{draw.randint(1000, 9999)}"
        ip = ".".join(str(draw.randint(1, 255)) for _ in range(4))
        for text in (phone, ip, "4111111111111111", f"n{draw.randint(1, 99)}@mail.example.com", f"{draw.randint(10**6, 10**8)}", "2021-03-04 12"):
            examples += pii._altered(text, brute(text))
    return pii.fit(examples[:300], rounds=40)


def test_base_spans_are_those_of_whole_texts():
    draw = random.Random(2)
    alphabet = "ab.@+-_%1234567890   ().,é"
    texts = HARD + ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 120))) for _ in range(4000)]
    for text in texts:
        assert pii.base_spans(text) == brute(text), text


@pytest.mark.parametrize("text", ["7" * 1_000_000, "a" * 1_000_000 + "@", "a" * 500_000 + "@b " + "." * 400_000, "1." * 500_000, "@" * 100_000, "+1" + " " * 500_000 + "x" + "+" * 100_000])
def test_long_runs_are_matched_once(text):
    began = time.perf_counter()
    spans = pii.base_spans(text)
    assert time.perf_counter() - began < 5
    assert len(spans) == (125_000 if text.startswith("1.") else 0)


def test_best_path_is_the_best_segmentation():
    draw = np.random.default_rng(3)
    lattice = pii.Lattice("+1 (4) 5.6")
    scores = draw.normal(0, 2, (len(lattice.spans), len(pii.KINDS)))
    value = {s: row.max() for s, row in zip(lattice.spans, scores)}
    n = lattice.n
    most = -np.inf
    for cut in itertools.product([0, 1], repeat=n - 1):
        borders = [0, *(k + 1 for k in range(n - 1) if cut[k]), n]
        total = 0.0
        for a, b in zip(borders[:-1], borders[1:]):
            total += max(value.get((a, b), -np.inf), 0.0 if b == a + 1 else -np.inf)
        most = max(most, total)
    assert sum(p[3] for p in pii.best(lattice, scores)) == pytest.approx(most)


def test_probabilities_sum_over_segmentations():
    draw = np.random.default_rng(4)
    lattice = pii.Lattice("1.2 3")
    scores = draw.normal(0, 1, (len(lattice.spans), len(pii.KINDS)))
    mass = {s: np.exp(row) for s, row in zip(lattice.spans, scores)}
    total, by = 0.0, {s: np.zeros(len(pii.KINDS)) for s in lattice.spans}
    n = lattice.n
    for cut in itertools.product([0, 1], repeat=n - 1):
        borders = [0, *(k + 1 for k in range(n - 1) if cut[k]), n]
        spans = list(zip(borders[:-1], borders[1:]))
        for kinds in itertools.product(range(-1, len(pii.KINDS)), repeat=len(spans)):
            if any(k < 0 and b > a + 1 for (a, b), k in zip(spans, kinds)):
                continue
            weight = np.prod([1.0 if k < 0 else mass[s][k] for s, k in zip(spans, kinds)])
            total += weight
            for s, k in zip(spans, kinds):
                if k >= 0:
                    by[s][k] += weight
    found = pii._expected(lattice, scores)
    for s, row in zip(lattice.spans, found):
        assert np.allclose(row, by[s] / total)


def test_added_spans_keep_base_spans_and_find_phones_without_plus(weights):
    for text in HARD:
        base, every = pii.spans_of(text, weights)
        assert base == brute(text) and set(base) <= set(every)
    text = "call (434) 555-2368 now"
    assert pii.spans_of(text, weights) == ([], [(5, 3, 19)])
    for clean in ("in 2021-03-04 12:30", "10.0.0.256", "pi 3.14159265358979", "4111111111111112", "no data here"):
        assert pii.spans_of(clean, weights)[1] == []


def test_steps_give_the_best_path_of_the_whole_lattice(weights, monkeypatch):
    monkeypatch.setattr(pii, "STEP_TOKENS", 7)
    draw = random.Random(5)
    for text in HARD + ["".join(draw.choice("ab.@+-1234567890   ().") for _ in range(draw.randint(0, 150))) for _ in range(60)]:
        base = pii.base_spans(text)
        for a, b in pii.stretches(text):
            inside = [(s[0] - a, s[1], s[2] - a) for s in base if a <= s[0] and s[2] <= b]
            lattice = pii.Lattice(text[a:b], inside)
            held = [(np.searchsorted(lattice.ends, x, "right") - 1, np.searchsorted(lattice.ends, y)) for x, _, y in inside]
            path = [(lattice.ends[i], k, lattice.ends[j]) for i, k, j, _ in pii.best(lattice, lattice.scores(weights), held)]
            assert [x[:3] for x in pii.best_in_steps(text[a:b], weights, inside)][::-1] == path


def test_a_long_stretch_takes_little_memory(weights):
    draw = random.Random(6)
    text = " ".join(str(draw.randint(10, 99)) for _ in range(4000)) + " (434) 555-2368"
    tracemalloc.start()
    base, every = pii.spans_of(text, weights)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert base == brute(text) and set(base) <= set(every)
    assert peak < 10_000_000


def test_table(documents):
    texts = HARD + [None, "", "x" * 100_000 + " a@b.cd", HARD[0]]
    docs = documents(texts)
    rows = {r["doc_id"]: r for r in pii.digest(pii.find(docs)).collect()}
    assert len(rows) == len(texts)
    for k, text in enumerate(texts):
        base = brute(text or "")
        joined = ",".join(f"{pii.KINDS[kind]}:{a}:{b}" for a, kind, b in base)
        assert rows[k]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [rows[k][f"n_{name}"] for name in pii.KINDS] == [sum(s[1] == q for s in base) for q in range(4)]
        assert set(joined.split(",")) - {""} <= set(rows[k]["spans"].split(","))
    assert pii.find(docs.where("doc_id < 0")).count() == 0
    assert {r["spans"] for r in pii.find(documents(["plain", None])).collect()} == {""}
