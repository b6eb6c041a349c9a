"""Ids against the library on whole texts, and the files read back."""

import random
import zlib

import numpy as np
import pytest

from pedalgrid.llm import token_orc as t

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")

HARD = ["", "  a b", "a\n\nb", "x\n", "x\n\n", "a \n b", "\tq\t w", "it's 'tis don't we'll. y'", "a.\n'b", "\x1c a\x1cb \x85 z　y  x", "é. à, ñ!", "\0a b", "<|endoftext|> x<|endoftext|>", "'s. 's's", "a.b,c;d***", "1.2. 3,4 +1"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_ids_are_the_librarys(library, prose, monkeypatch):
    draw = random.Random(2)
    texts = HARD + [x or "" for x in prose] + ["".join(draw.choice("abe th,.'s\n  .1é日\t\x1c|*") for _ in range(draw.randint(1, 60))) for _ in range(3000)]
    want = [library.encode(x, add_special_tokens=False).ids for x in texts]
    coder = t.Encoder(PATH)
    assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == want
    monkeypatch.setattr(t, "MEMORY", 50)
    coder = t.Encoder(PATH)
    assert [np.frombuffer(coder.encode([x])[0], "<u4").tolist() for x in texts] == want


def test_files_read_back(spark, documents, library, prose, tmp_path):
    ids = list(range(len(prose)))
    random.Random(1).shuffle(ids)
    docs = documents(prose, ids=ids).repartition(5)
    path = str(tmp_path / "tokens")
    t.write_tokens(docs, path, PATH)
    tokens = t.read_tokens(spark, path)
    start = 0
    found = {r["doc_id"]: r for r in t.summary(tokens).collect()}
    for k, text in sorted(zip(ids, prose)):
        want = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        assert (found[k]["start"], found[k]["n_tokens"], found[k]["ids_crc32"]) == (start, len(want), zlib.crc32(want.tobytes()))
        start += len(want)
    rows = tokens.select("part", "place", "doc_id").collect()
    assert [r["doc_id"] for r in sorted(rows)] == sorted(ids)
    one = tokens.where("doc_id = 7")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)]" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1


def test_files_have_bloom_filters(spark, documents, tmp_path):
    from pyarrow import orc

    path = tmp_path / "tokens"
    t.write_tokens(documents(["a b"] * 50), str(path), PATH)
    files = list(path.glob("*.orc"))
    assert files and all(orc.ORCFile(f).nstripes >= 1 for f in files)
    plain = tmp_path / "plain"
    spark.read.orc(str(path)).write.option("compression", "zstd").orc(str(plain))
    assert sum(f.stat().st_size for f in files) > sum(f.stat().st_size for f in plain.glob("*.orc"))


def test_null_and_repeated_ids_and_empty_tables(spark, documents, tmp_path):
    docs = documents(["b", "a", None, "c"], ids=[2, None, 2, 1])
    t.write_tokens(docs, str(tmp_path / "a"), PATH)
    rows = t.summary(t.read_tokens(spark, str(tmp_path / "a"))).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 2]
    assert sorted(r["start"] + r["n_tokens"] for r in rows)[-1] == sum(r["n_tokens"] for r in rows) == 7
    t.write_tokens(docs.where("doc_id > 9"), str(tmp_path / "b"), PATH)
    assert t.summary(t.read_tokens(spark, str(tmp_path / "b"))).count() == 0


def test_words_are_merged_together_and_once(library):
    class Counted:
        def __init__(self, model):
            self.model, self.calls = model, []

        def tokenize(self, text):
            self.calls.append(text)
            return self.model.tokenize(text)

    draw = random.Random(5)
    words = sorted({"".join(draw.choice("abcdeéñÿĠß") for _ in range(9)) for _ in range(1000)})
    texts = [f"{w} {w} {w}. {w}, {w}*\n{w}\n{w}." for w in words]
    coder = t.Encoder(PATH)
    coder.model = Counted(coder.model)
    want = [library.encode(x, add_special_tokens=False).ids for x in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == want
    # With a blank before it and without: no word more often, whatever marks stand behind it.
    assert sum(x.count("ÿ") + 1 for x in coder.model.calls) <= 2 * len(words)
    assert len(coder.model.calls) <= 2 * len(words) / t.STEP_WORDS + 1


@pytest.mark.parametrize("change", ["chars", "between", "single"])
def test_ids_in_small_steps(library, prose, monkeypatch, change):
    texts = HARD + [x or "" for x in prose] + ["ÿ ÿÿ Ġa Ġ. \nÿ, a²", "ab  cd\tef.", "éa. éa éa,\néa"]
    if change == "chars":
        monkeypatch.setattr(t, "STEP_CHARS", 7)
    coder = t.Encoder(PATH)
    if change == "between":
        coder.between = None
    if change == "single":
        coder.step = 1
    assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == [library.encode(x, add_special_tokens=False).ids for x in texts]
    assert coder.encode([]) == [] and coder.encode([""]) == [b""]
