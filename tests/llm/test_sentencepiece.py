"""The transducer against the library's ids, against all paths of a small lexicon, and in round trips."""

import random

import numpy as np
import pytest

from pedalgrid.llm import sentencepiece_fst as f

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")

HARD = ["", " ", "  a  b ", " x", "a\n b", "a \nb", "tab\tx", "▁y z▁▁", "日本語 😀 tést", "\n\n", "a\n", "é́​", "<s> </s> <0x41>", "don't 12345 https://x.y/z?q=1", "\0 a\0", "a\0\nb"]


def texts():
    draw = random.Random(1)
    return HARD + ["".join(draw.choice("abe the \n  .1é日▁") for _ in range(draw.randint(1, 80))) for _ in range(1500)]


def ids(data):
    return np.frombuffer(data, "<i4").tolist()


def test_ids_and_texts_are_the_librarys(prose):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    model = f.Transducer.from_file(MODEL)
    every = texts() + [t or "" for t in prose]
    for text, found in zip(every, model.encode(every)):
        assert ids(found) == library.encode(text), text
        assert model.decode(ids(found)) == library.decode(ids(found)) == text.replace(f.META, " ")


def test_long_runs_without_blanks_are_the_librarys():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    draw = random.Random(5)
    digits = "".join(draw.choice("0123456789") for _ in range(100_000))
    thai = "".join(chr(draw.randint(0x0E01, 0x0E2E)) for _ in range(100_000))
    for text in (digits, "7" * 100_000, "😀" * 100_000, thai, "。" * 100_000, "word" + digits, "word " + thai + " word"):
        model = f.Transducer.from_file(MODEL)
        found = model.encode([text])[0]
        assert ids(found) == library.encode(text), text[:20]
        assert model.decode(ids(found)) == text


def test_a_small_memory_gives_the_same(monkeypatch):
    every = texts()
    whole = f.Transducer.from_file(MODEL).encode(every)
    monkeypatch.setattr(f, "MEMORY", 40)
    model = f.Transducer.from_file(MODEL)
    assert [model.encode([t])[0] for t in every] == whole


def test_least_path_is_the_best_of_all_paths():
    draw = random.Random(3)
    pieces = [("<unk>", 0.0, f.UNKNOWN)] + [(p, -draw.uniform(1, 9), f.NORMAL) for p in ("▁", "a", "b", "▁a", "ab", "ba", "aba", "bab", "▁ab", "abab")]
    model = f.Transducer(pieces, f.UNIGRAM)
    score = {p: s for p, s, _ in pieces[1:]} | {"c": -model.unknown_cost}

    def paths(text):
        if not text:
            yield []
        for k in range(1, len(text) + 1):
            if text[:k] in score:
                for rest in paths(text[k:]):
                    yield [text[:k], *rest]

    for _ in range(200):
        text = "▁" + "".join(draw.choice("abc") for _ in range(draw.randint(0, 8)))
        best = max(paths(text), key=lambda p: sum(score[x] for x in p))
        assert sum(score[x] for x in model.path(text)) == pytest.approx(sum(score[x] for x in best))
    assert ids(model.encode(["acca"])[0]).count(0) == 1  # a run of unknown characters is one unknown


def test_other_normalisers_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as file:
        model.ParseFromString(file.read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "other.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        f.Transducer.from_file(str(tmp_path / "other.model"))


def test_tables_round_trip(documents, prose):
    docs = documents(prose)
    coded = f.encode(docs, MODEL)
    back = {r["doc_id"]: r for r in f.decode(coded, MODEL).collect()}
    assert len(back) == len(prose)
    for k, text in enumerate(prose):
        assert back[k]["text"] == (text or "") and back[k]["n_pieces"] == len(back[k]["ids"])
    assert f.decode(f.encode(docs.where("doc_id < 0"), MODEL), MODEL).count() == 0
    clash = coded.withColumnRenamed("n_pieces", "decoded_sha256")
    assert f.decode(clash, MODEL, keep_text=False).columns == ["doc_id", "ids", "decoded_sha256"]


def test_one_pass_equals_two(documents, prose):
    docs = documents(prose)
    two = f.decode(f.encode(docs, MODEL), MODEL, keep_text=False)
    one = f.round_trip(docs, MODEL)
    assert one.columns == two.columns == ["doc_id", "n_pieces", "ids", "decoded_sha256"]
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    assert f.round_trip(docs.where("doc_id < 0"), MODEL).count() == 0
