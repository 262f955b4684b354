from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as proto

from tillroll.llm import pieces

DATA = open(pieces.MODEL, "rb").read()
TEXTS = [
    None,
    "",
    " ",
    "\n\n",
    "hello world",
    "  a  b   c ",
    "日本語テキスト😀 x\0y",
    "aaaaaaaaaaaaaaaaaaaaaaa " * 3,
    "<s> </s> <0x0A> <unk>",
    "x" * 300 + " " + "é" * 200,
    " " * 40 + "z",
    "The quick brown fox, 1234567890!\tTabbed\r\n",
    "word " * 3000,
]


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(4)
    parts = ["tion", "er", "the", "ing", "é", "ß", "中", "1", "\n", "  ", "Q#", "ä", "X", "!!"]
    return TEXTS + ["".join(draw.choices(parts + [" "] * 5, k=draw.randint(1, 200))) for _ in range(300)]


def ids_of(data, texts):
    ids, counts = pieces.Encoder(pieces.Model(data)).encode(texts)
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


def test_bpe_equals_the_library(texts):
    library = sentencepiece.SentencePieceProcessor(model_proto=DATA)
    assert ids_of(DATA, texts) == [library.encode(text or "") for text in texts]


def test_unigram_paths_score_as_high_as_the_library(texts):
    model = proto.ModelProto()
    model.ParseFromString(DATA)
    model.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    draw = random.Random(6)
    for piece in model.pieces:
        if piece.type == piece.NORMAL:
            piece.score = -draw.random() * 10 * len(piece.piece) ** 0.5
    data = model.SerializeToString()
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    got, want = ids_of(data, texts), [library.encode(text or "") for text in texts]
    scores = [piece.score for piece in model.pieces]
    for a, b in zip(got, want, strict=True):
        assert a == b or sum(scores[i] for i in a) == pytest.approx(sum(scores[i] for i in b), rel=1e-5)
    assert sum(a == b for a, b in zip(got, want, strict=True)) >= 0.97 * len(texts)


def test_long_words_take_the_same_way(texts, monkeypatch):
    want = ids_of(DATA, texts)
    monkeypatch.setattr(pieces, "LONG", 4)
    assert ids_of(DATA, texts) == want


def test_words_are_forgotten_when_there_are_too_many(texts, monkeypatch):
    want = ids_of(DATA, texts)
    monkeypatch.setattr(pieces, "KEPT_WORDS", 10)
    encoder = pieces.Encoder(pieces.Model(DATA))
    assert [encoder.encode([text])[0].tolist() for text in texts] == want


def test_a_batch_is_not_learned_whole(texts, monkeypatch):
    """Words learned ahead, and those that advance together, are bounded, not all new ones of a batch; ids stay the same."""
    rows = texts + [f"{word}{i} longer{i}words" for i, word in enumerate(["one", "two", "three"] * 400)]
    want = ids_of(DATA, rows)
    learned, together = [], []
    learn, lattice = pieces.Encoder._learn, pieces._lattice
    monkeypatch.setattr(pieces, "LEARN_BYTES", 2_000, raising=False)
    monkeypatch.setattr(pieces, "LATTICE_CHARS", 500, raising=False)
    monkeypatch.setattr(pieces, "BATCH_CHARS", 1_000)
    monkeypatch.setattr(pieces, "KEPT_WORDS", 300)
    monkeypatch.setattr(pieces.Encoder, "_learn", lambda self, words: (learned.append(len(words)), learn(self, words))[1])
    monkeypatch.setattr(pieces, "_lattice", lambda model, codes: (together.append(codes.size), lattice(model, codes))[1])
    monkeypatch.setattr(pieces, "_encoders", {})

    class Rows:
        schema = type("Schema", (), {"__getitem__": lambda self, name: type("Field", (), {"dataType": T.LongType()})})()

        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    monkeypatch.setattr(pieces, "F", type("F", (), {"col": lambda name: type("Col", (), {"alias": lambda self, name: self})()}))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(rows, pa.string())], ["doc_id", "text"])
    out = pa.Table.from_batches(pieces.round_trip(Rows(), DATA)(iter([batch])))
    assert out["doc_id"].to_pylist() == list(range(len(rows))) and out["ids"].to_pylist() == want
    assert max(learned) < 1_000 < sum(learned) and max(together) <= 500


def test_round_trip(docs, odd_rows):
    df = docs(odd_rows + [(50, "a▁b")], clash=True)
    got = pieces.round_trip(df, DATA).collect()
    assert len(got) == len(odd_rows) + 1
    assert {r.doc_id for r in got if not r.round_trip} == {50}
    assert all(r.n_tokens == len(r.ids) for r in got)
    assert pieces.round_trip(docs([]), DATA).collect() == []
    decoded = {r.doc_id: r.text for r in pieces.decode(pieces.encode(df, DATA), DATA).collect()}
    assert decoded[9] == "日本語 ünï 😀 42 !!" and decoded[1] == "" and decoded[50] == "a b"


def test_models_that_are_not_supported():
    model = proto.ModelProto()
    model.ParseFromString(DATA)
    model.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError, match="normaliser"):
        pieces.Model(model.SerializeToString())


def test_words_that_begin_with_nul():
    texts = ["a \0b", "\0b", "a b \0\0 \0", " \0a  \0b", "b"]
    library = sentencepiece.SentencePieceProcessor(model_proto=DATA)
    assert ids_of(DATA, texts) == [library.encode(text) for text in texts]
    model = pieces.Model(DATA)
    assert pieces.decode_batch(model, *pieces.Encoder(model).encode(texts)) == texts
