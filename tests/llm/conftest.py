"""Documents that every operator must take: nulls, empty and long texts, ties, repeated rows, clashing names."""

import random

import pytest

LAYOUT = "doc_id long, text string, lang string, source string, n_chars long, digest string, part int, bucket string, n long, keep_id long"


def rows_of(texts, first=0):
    return [(first + k, t, "en", "s", 0, "x", 1, "y", 2, 3) for k, t in enumerate(texts)]


@pytest.fixture(scope="session")
def documents(spark):
    """A maker of tables with columns whose names the operators use inside."""

    def make(texts, ids=None):
        rows = [((ids[k] if ids is not None else r[0]), *r[1:]) for k, r in enumerate(rows_of(texts))]
        return spark.createDataFrame(rows, LAYOUT)

    return make


@pytest.fixture(scope="session")
def prose():
    """Texts over a small vocabulary, with exact and near copies, shared passages and hard cases."""
    draw = random.Random(9)
    vocabulary = ["the", "of", "And", "étre", "über", "x1"] + ["".join(draw.choice("abcdefg") for _ in range(draw.randint(2, 9))) for _ in range(300)]
    plain = [" ".join(draw.choice(vocabulary) for _ in range(draw.choice([1, 2, 3, 12, 60, 200]))) for _ in range(60)]
    passage = " ".join(draw.choice(vocabulary) for _ in range(40))
    texts = list(plain)
    texts += [plain[k] for k in (3, 3, 3, 10, 11)]
    for k in range(6, 20):
        words = plain[k].split(" ")
        words[draw.randrange(len(words))] = f"new{k}"
        texts.append(" ".join(words))
    texts += [f"{plain[k]} {passage} {plain[k + 1]}" for k in range(20, 30)]
    texts += [None, "", " ", "\n\n", "a", "A", "a b", "tab\tsep\x0bline\r\nend", " ".join(["same"] * 500), "z" * 5000, "日本語 😀 " * 30, " ".join(draw.choice(vocabulary) for _ in range(30_000))]
    return texts
