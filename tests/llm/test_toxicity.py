from __future__ import annotations

import random

import pytest

from tillroll.llm import toxicity


def rows(seed, n):
    """Clean words with bad ones in every third text; 'zwonk can' is harmless."""
    draw = random.Random(seed)
    words = ["".join(draw.choices("aeiourst", k=draw.randint(3, 8))) for _ in range(300)]
    out, labels = [], []
    for i in range(n):
        parts = draw.choices(words, k=draw.randint(10, 80))
        toxic = int(i % 3 == 0)
        if toxic:
            for bad in draw.sample(["blargh", "zwonk", "mookster", "mooking"], 2):
                parts.insert(draw.randrange(len(parts)), bad)
        elif i % 25 == 1:
            parts += ["zwonk", "can"]
        out.append((i, " ".join(parts)))
        labels.append((i, toxic))
    return out, labels


@pytest.fixture
def lexicon(spark, docs):
    texts, labels = rows(1, 300)
    return toxicity.learn(docs(texts, clash=True), spark.createDataFrame(labels, "doc_id bigint, toxic int"), min_weight=2.0)


def test_fold():
    assert toxicity.fold("You 1D10T!! іdіоt m​oron cl@wn $cum loseR foo$$$") == " you idiot idiot moron ciawn scum ioser foo "
    assert toxicity.fold("ＦＵＬＬ ｗidth") == " fuii width "
    assert toxicity.fold(None) == toxicity.fold(" 92. ?!") == ""


def test_learned_terms_and_exceptions(lexicon):
    assert {" biar", " mook"} <= lexicon.weights.keys()
    assert " zwonk can " in lexicon.exceptions


def test_scores_of_unseen_texts(docs, lexicon):
    texts, labels = rows(2, 200)
    texts += [(900, "t0tally bl4rgh"), (901, None), (902, ""), (903, "zwonk can ok"), (904, "fine " * 30_000)]
    got = {r.doc_id: r for r in toxicity.score(docs(texts, clash=True), lexicon).collect()}
    right = sum((got[i].score >= 0.7) == bool(toxic) for i, toxic in labels)
    assert right / len(labels) >= 0.97 and all(0 <= r.score <= 1 for r in got.values())
    assert got[900].score >= 0.7 and got[900].hits == 1
    assert got[901].score == got[902].score < 0.3 and got[903].hits == 0 and got[904].score < 0.3
    assert toxicity.score(docs([]), lexicon).collect() == []


def test_matches_follow_plain_search(lexicon):
    matcher = toxicity.Matcher(lexicon)
    texts, _ = rows(3, 100)
    for _, text in texts:
        folded = toxicity.fold(text)
        want = {}
        for term, weight in lexicon.weights.items():
            at = folded.find(term)
            while at >= 0:
                want[at] = max(weight, want.get(at, 0))
                at = folded.find(term, at + 1)
        for phrase in lexicon.exceptions:
            at = folded.find(phrase)
            while at >= 0:
                want = {k: w for k, w in want.items() if not at <= k < at + len(phrase) - 1}
                at = folded.find(phrase, at + 1)
        assert {start: weight for start, _, weight in matcher.found(folded)} == want


def test_given_exceptions_and_missing_labels(spark, docs):
    texts, labels = rows(4, 60)
    some = spark.createDataFrame([(i, t if i % 2 else None) for i, t in labels] + [(None, 1)], "doc_id bigint, toxic int")
    lexicon = toxicity.learn(docs(texts), some, exceptions=["Blargh Day"])
    assert " biargh day " in lexicon.exceptions
    none = toxicity.learn(docs(texts), some.filter("toxic = 0"))
    assert none.weights == {} and toxicity.score(docs(texts), none).first().score < 0.5
