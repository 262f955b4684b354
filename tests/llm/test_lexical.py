from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from tillroll.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(UPPER) for t in TERM.findall(text or "")]


def expected(docs, items, k=10):
    """Every document against every item."""
    found = [(doc, Counter(terms(text))) for doc, text in docs]
    found = [(doc, tfs, tfs.total()) for doc, tfs in found if tfs]
    many, length = len(found), sum(n for *_, n in found)
    df = Counter(term for _, tfs, _ in found for term in tfs)
    out = []
    for item, text in items:
        scored = []
        for doc, tfs, n in found:
            m = 25 + (75 * n * many) // length
            score = sum(
                math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1))) * ((10**9 * tfs[t]) // (1000 * tfs[t] + 8 * m))
                for t in terms(text)
                if t in tfs
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if none else doc, -s) for rank, (s, none, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.fixture
def items(spark):
    def build(rows):
        return spark.createDataFrame(rows, "item_id bigint, text string").selectExpr("*", "1 AS term", "2 AS row", "3 AS score", "4 AS q")

    return build


@pytest.fixture
def corpus():
    """Terms of very different frequency, long and short texts, ties and copies."""
    draw = random.Random(11)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(draw.choices(words, weights, k=draw.choice([1, 3, 20, 200])))) for i in range(500)]
    docs += [(1000 + i, docs[i][1].upper()) for i in range(60)]
    asked = [(i, " ".join(draw.choices(words, weights, k=draw.choice([1, 5, 40])))) for i in range(25)]
    asked += [(100, " ".join(draw.sample(words, 60))), (101, docs[3][1]), (102, "absent"), (103, None), (104, "  .. "), (105, "w7 w7 W7")]
    return docs, asked


@pytest.mark.parametrize("base", [4, 1.3])
def test_ranks_follow_brute_force(docs, items, corpus, odd_rows, monkeypatch, base):
    monkeypatch.setattr(lexical, "ROUND_BASE", base)
    rows, asked = corpus
    rows = rows + odd_rows
    got = lexical.best(docs(rows, clash=True), items(asked + [(106, "quick 日本語 brown word ünï")]))
    assert result(got) == expected(rows, asked + [(106, "quick 日本語 brown word ünï")])


def test_hashes_that_collide_are_told_apart(docs, items, corpus, monkeypatch):
    """With few flags most terms pass them; the exact join leaves the right ones."""
    monkeypatch.setattr(lexical, "HASH_BITS", 3)
    rows, asked = corpus
    assert result(lexical.best(docs(rows[:200]), items(asked), k=3)) == expected(rows[:200], asked, k=3)


def test_accumulators_are_limited(spark, docs, items, corpus, monkeypatch):
    """Frequent terms create no accumulators once the bounds cannot reach the kth score."""
    made = []
    whole = lexical._round

    def counted(postings, plan, found, floors):
        out = whole(postings, plan, found, floors)
        made.append(out.count())
        return out

    monkeypatch.setattr(lexical, "_round", counted)
    rare = [(2000 + i, " ".join(f"rare{j}" for j in range(12)) + " w0 w1") for i in range(12)]
    text = " ".join(f"rare{j}" for j in range(12)) + " w0 w1 w2"
    rows = corpus[0] + rare
    got = lexical.best(docs(rows), items([(1, text)]))
    assert result(got) == expected(rows, [(1, text)])
    assert made[-1] == 12 and sum("w0" in t.lower().split() for _, t in rows) > 200


def test_repeated_and_missing_ids(docs, items):
    rows = [(1, "a b"), (1, "a b"), (None, "a b"), (2, "a c"), (3, "d")]
    asked = [(7, "a b"), (7, "d"), (None, "c")]
    assert result(lexical.best(docs(rows), items(asked))) == expected(rows, asked)


def test_empty_tables(docs, items):
    assert lexical.best(docs([]), items([(1, "a")])).collect() == []
    assert lexical.best(docs([(1, "a"), (2, None)]), items([])).collect() == []
    assert lexical.best(docs([(1, None)]), items([(1, None)])).collect() == []


def test_few_rows_over_many_partitions(docs, items):
    rows = [(1, "one two"), (2, "two")]
    got = lexical.best(docs(rows).repartition(7), items([(1, "two")]).repartition(7))
    assert result(got) == expected(rows, [(1, "two")])
