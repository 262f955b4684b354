from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside; a table may have such columns of its own.
CLASHES = ("id", "kept", "size", "h", "key", "component", "score", "n", "ids", "label", "range", "norm", "digest", "first")
SENTENCE = "the quick brown fox jumps over the lazy dog and then it runs far away from all the noise"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or full rows, with ``clash`` columns of names that operators use."""

    def build(rows: list[tuple], clash: bool = False):
        full = [row if len(row) == 5 else (*row[:2], "en", "web", len(row[1] or "")) for row in rows]
        df = spark.createDataFrame(full, SCHEMA)
        if clash:
            for name in CLASHES:
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return build


@pytest.fixture
def odd_rows():
    """Null, empty, blank, tiny and long texts, copies, a repeated row, and a row without an id."""
    return [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "a"),
        (5, "word " * 30_000),
        (6, SENTENCE * 30),
        (7, SENTENCE * 30),
        (8, SENTENCE),
        (8, SENTENCE),
        (9, "日本語 ünï 😀 42 !!"),
        (10, "x" * 5_000),
        (None, SENTENCE * 2),
    ]


@pytest.fixture
def random_texts():
    """Texts of random words, with exact and near copies and shared passages."""
    draw = random.Random(3)
    words = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 7))) for _ in range(400)]

    def text(n):
        return " ".join(draw.choices(words, k=n)).replace(" a", "\n")

    texts = [text(draw.randint(1, 300)) for _ in range(40)]
    passage = text(120)
    for i in range(40):
        base = draw.choice(texts)
        kind = i % 4
        if kind == 0:
            texts.append(base)
        elif kind == 1:
            parts = base.split(" ")
            for _ in range(max(1, len(parts) // 40)):
                parts[draw.randrange(len(parts))] = draw.choice(words)
            texts.append(" ".join(parts))
        elif kind == 2:
            texts.append(f"{text(40)} {passage} {text(40)}")
        else:
            texts.append(base.upper())
    return texts
