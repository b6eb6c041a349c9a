"""The pair acceptor and the paths of many inputs against merging each text by itself."""

import random

import numpy as np
import pytest

from pedalgrid.llm import pair_lattice, sentencepiece_fst as f


def lexicon_of(seed, letters="abc", size=40):
    """Pieces made as byte-pair training makes them: each joins two that are there, with a lower score than all before."""
    draw = random.Random(seed)
    pieces = list(letters)
    while len(pieces) < size:
        new = draw.choice(pieces) + draw.choice(pieces)
        if new not in pieces and len(new) < 9:
            pieces.append(new)
    return [("<unk>", 0.0, f.UNKNOWN), *[(p, -float(k), f.NORMAL) for k, p in enumerate(pieces)]]


@pytest.mark.parametrize("seed", range(12))
def test_pairs_equal_merging(seed):
    model = f.Transducer(lexicon_of(seed), f.BPE)
    lattice = model.pairs
    whole = [k for k, p in enumerate(lattice.names) if model.merged(p) == [p]]
    left, right = (np.array(x) for x in zip(*[(a, b) for a in whole for b in whole]))
    found = lattice.follows(left, right, model.may_follow)
    for a, b, apart in zip(left, right, found):
        x, y = lattice.names[a], lattice.names[b]
        assert apart == (model.merged(x + y) == [x, y]), (x, y)
    assert (lattice.follows(left, right, model.may_follow) == found).all()  # as remembered


@pytest.mark.parametrize("seed", range(12))
def test_paths_equal_merging(seed, monkeypatch):
    monkeypatch.setattr(pair_lattice, "STEP", 50)
    monkeypatch.setattr(pair_lattice, "CACHE", 64)
    model = f.Transducer(lexicon_of(seed), f.BPE)
    draw = random.Random(seed)
    texts = ["".join(draw.choice("aaabbbcccx") for _ in range(draw.randint(1, 40))) for _ in range(300)]
    symbols, borders, ends = model.pairs.paths(texts, model.may_follow)
    origin = 0
    for k, text in enumerate(texts):
        cut = [0, *(ends[borders[k] : borders[k + 1]] - origin)]
        path = [text[a:b] for a, b in zip(cut[:-1], cut[1:])]
        assert path == model.merged(text)
        assert [model.pairs.names[s] if s < model.pairs.other else "x" for s in symbols[borders[k] : borders[k + 1]]] == path
        origin += len(text)


def test_table_finds_all_and_nothing_else():
    draw = np.random.default_rng(2)
    keys = np.unique(draw.integers(0, 1 << 40, 5000))
    table = pair_lattice.Table(dict(zip(keys[::2].tolist(), range(len(keys[::2])))))
    assert (table[keys[::2]] == np.arange(len(keys[::2]))).all() and (table[keys[1::2]] == -1).all()
    assert (pair_lattice.Table({})[keys] == -1).all()


def test_inputs_around_the_longest_that_are_taken_together():
    from sentencepiece import SentencePieceProcessor
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    library, model, draw = SentencePieceProcessor(model_file=path), f.Transducer.from_file(path), random.Random(1)
    texts = ["".join(draw.choice("etaoinsrhé7字") for _ in range(k)) for k in (*range(f.LONG - 5, f.LONG + 5), 1, 2, 3000)]
    assert [np.frombuffer(x, "<i4").tolist() for x in model.encode(texts)] == library.encode(texts)
