"""Fingerprints and components against a plain reading of the contract."""

import random
import re

import numpy as np
import xxhash

from pedalgrid.llm import simhash as sh


def plain_code(text, size=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    runs = [" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    votes = [0] * 64
    for run in runs:
        h = xxhash.xxh64(run.encode(), seed=42).intdigest()
        for bit in range(64):
            votes[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * votes[bit] > len(runs))


def plain_components(codes, ids, radius=4):
    parent = list(range(len(codes)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [least.get(find(k)) for k in range(len(codes))]


def check(df, texts, ids, radius=4):
    codes = [plain_code(t) for t in texts]
    want = sorted((str(i), f"{c:016x}", str(g)) for i, c, g in zip(ids, codes, plain_components(codes, ids, radius)))
    got = sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in df.collect())
    assert got == want


def near_copies(draw, words, n, changes):
    out = []
    for _ in range(n):
        mine = list(words)
        for _ in range(changes):
            mine[draw.randrange(len(mine))] = draw.choice("abcdefgh") * 3
        out.append(" ".join(mine))
    return out


def test_equals_plain_reading(spark, documents, prose):
    draw = random.Random(4)
    base = [f"w{draw.randrange(5000)}" for _ in range(400)]
    texts = prose + near_copies(draw, base, 60, 2) + ["one two three", "One\ttwo   THREE", "a b c d", "A B C D ", "\x0b\x0c", "\x1fno blank"]
    check(sh.cluster(documents(texts)), texts, list(range(len(texts))))


def test_small_tiles_lose_no_link(spark, documents):
    """Many tiles per place: links between pieces of one place and of neighbouring places stay."""
    draw = random.Random(7)
    texts = [" ".join(f"v{draw.randrange(900)}" for _ in range(6)) for _ in range(150)]
    base = [f"w{draw.randrange(5000)}" for _ in range(300)]
    texts += near_copies(draw, base, 150, 3)
    for radius in (4, 6):
        check(sh.cluster(documents(texts), radius=radius, tile=3), texts, list(range(len(texts))), radius)


def test_ids(spark, documents):
    texts = ["a b c d e", "a b c d e", None, "", "x y", "x y", "lone words here", "a b c d e"]
    ids = [7, None, None, 3, None, None, None, 7]
    check(sh.cluster(documents(texts, ids)), texts, ids)


def test_empty_table(spark, documents):
    assert sh.cluster(documents([])).collect() == []
    assert sh.cluster(documents([])).columns == ["doc_id", "fingerprint", "component_id"]


def test_long_texts_are_hashed_in_parts(monkeypatch):
    draw = random.Random(2)
    texts = [
        " ".join(f"w{draw.randrange(99)}" for _ in range(3000)),
        "x" * 3000 + " b c",
        "x" * 3000 + " b c d e",
        " " * 5000 + "one two",
        "a " * 2000 + " " * 3000 + "z",
        "\t".join(["y" * 700] * 20),
        " " * 4000,
        ("q" * 2500 + " ") * 3,
    ]
    monkeypatch.setattr(sh, "LONG_BYTES", 256)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    codes = next(sh._fingerprint(iter([batch]), 4))["code"].to_numpy().view(np.uint64)
    assert [int(c) for c in codes] == [plain_code(t) for t in texts]


def test_tiles_that_are_skipped_hold_no_link():
    draw = random.Random(1)
    steps = set(sh.neighbour_steps(4))
    for _ in range(2000):
        a = draw.getrandbits(64)
        b = a
        for bit in draw.sample(range(64), draw.randint(0, 4)):
            b ^= 1 << bit
        d = tuple((b >> 16 * k & 0xFFFF).bit_count() - (a >> 16 * k & 0xFFFF).bit_count() for k in range(4))
        assert d in steps or tuple(-x for x in d) in steps
    assert len(steps) == 161


def test_group_gives_a_forest():
    codes = np.arange(600, dtype=np.uint64)
    a, b = sh.close_pairs(codes, codes, 10, True)
    assert len(a) == 599
    a, b = sh.close_pairs(codes, codes + np.uint64(600), 10, False)
    assert len(a) <= 1199
