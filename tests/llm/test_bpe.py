from __future__ import annotations

import random
import sys

import pytest
from tokenizers import Tokenizer

from tillroll.llm import bpe

DATA = open(bpe.MODEL, "rb").read()
LATER = bpe.later_characters()
TEXTS = [
    None,
    "",
    " ",
    "\n\n \t x",
    "hello world, it's we've I'LL they'd",
    "  a  b   c ",
    "日本語テキスト😀 x\0y",
    "a<|endoftext|>b <|endoftext|><|endoftext|> <|endoftext",
    "x" * 5_000 + " " + "é" * 3_000,
    "ab" * 4_000,
    " " * 3_000 + "z",
    "1234567890 ½ ² Ⅷ ٣٤",
    "\x1c\x1d\x85 　​ end",
    "word\n" * 40_000,
    "no space " * 2_000,
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(bpe.MODEL)
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.fixture(scope="module")
def counter():
    return bpe.Counter(DATA, LATER)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(4)
    parts = ["tion", "er", "the", "ing", "é", "ß", "中", "1", "\n", "  ", "Q#", "ä", "'s", "'LL", "!!", "<|endoftext|>", "\t", "😀"]
    return TEXTS + ["".join(draw.choices(parts + [" "] * 6, k=draw.randint(1, 200))) for _ in range(400)]


def test_counts_are_those_of_the_library(counter, library, texts):
    assert [counter.tokens(text or "") for text in texts] == library(texts)


def test_every_character_is_cut_alike(counter, library):
    """Also letters of a Unicode version that only one of the two libraries knows."""
    every = [chr(c) for c in [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]]
    texts = [f"a{c}1{c}!{c} {c}{c}" for c in every[:: 1 if LATER[0] else 7]]
    assert [counter.tokens(text) for text in texts] == library(texts)


def test_pieces_of_a_text_make_no_difference(counter, library, texts, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 5)
    assert [counter.tokens(text or "") for text in texts] == library(texts)


def test_a_full_memory_starts_afresh(library, texts, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    counter = bpe.Counter(DATA, LATER)
    assert [counter.tokens(text or "") for text in texts[:60]] == library(texts[:60])
    assert len(counter) <= 3


def test_lowest_rank_first():
    """Merges by rank, not from the left: count is symbols less merges."""
    ranks = bpe.Ranks(DATA)
    for word in (b"", b"a", b"abcabc", b"\xff\xfe", b"internationalization"):
        symbols = [bytes([b]) for b in word]
        names = {s: i for i, s in enumerate(bpe.byte_characters())}
        ids = [names[bpe.byte_characters()[s[0]]] for s in symbols]
        while True:
            pairs = [(ranks.merges[a << 32 | b][0], i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if a << 32 | b in ranks.merges]
            if not pairs:
                break
            i = min(pairs)[1]
            ids[i : i + 2] = [ranks.merges[ids[i] << 32 | ids[i + 1]][1]]
        assert ranks.count(word) == len(ids)


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        bpe.Ranks(DATA.replace(b'"add_prefix_space":false', b'"add_prefix_space":true').replace(b'"add_prefix_space": false', b'"add_prefix_space": true'))


def test_rows(spark, docs, odd_rows, library):
    got = bpe.counts(docs(odd_rows, clash=True).repartition(20), DATA, limit=100).collect()
    texts = [row[1] for row in odd_rows]
    want = [(row[0], len((row[1] or "").encode()), n, n > 100) for row, n in zip(odd_rows, library(texts), strict=True)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert bpe.counts(docs([]), DATA).collect() == []
    assert got[0].__fields__ == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
