"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding undoes disguise: look-alike letters of other scripts, digits for letters, invisible
characters. Terms are whole words or word beginnings with log-odds weights; a match inside
an exception phrase does not count. The weight found is set against the length of the text.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import session

# Letters and digits that pass for Latin letters, and characters that show nothing.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "ё": "e", "н": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m",
    "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ո": "n", "ս": "u",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b",
}
SIGNS = {"@": "a", "$": "s", "!": "l", "|": "l"}
INVISIBLE = "­​‌‍⁠﻿"

#: Lengths of word beginnings that can be terms.
STEMS = range(4, 11)


class _Folds(dict):
    """Translation of characters, filled as they are met: letters to folded letters, the rest to spaces."""

    def __missing__(self, code: int) -> str | None:
        char = unicodedata.normalize("NFKC", chr(code)).lower()
        if chr(code) in INVISIBLE or unicodedata.category(chr(code)) == "Mn":
            out = None
        else:
            folded = "".join(LOOKALIKES.get(c, c) for c in char)
            # 1, l, I and i stand for each other, so all of them become one letter.
            out = "".join(c if c.isalpha() else " " for c in folded).replace("l", "i")
        self[code] = out
        return out


_folds = _Folds()
_inside = re.compile(r"(?<=[^\W_])[@$!|](?=[^\W_])|(?<!\S)[@$](?=[^\W_])")


def fold(text: str | None) -> str:
    """Folded words between single spaces, one space at both ends; empty without words."""
    if not text:
        return ""
    if any(sign in text for sign in SIGNS):
        text = _inside.sub(lambda m: SIGNS[m[0]], text)
    words = text.translate(_folds).split()
    return f" {' '.join(words)} " if words else ""


@dataclass(frozen=True)
class Lexicon:
    """Weights of terms, exception phrases, and the logistic curve from weight found to score.

    A term is folded text with a space before it and, if it is a whole word, one behind it;
    a phrase has a space on both sides.
    """

    weights: dict[str, float]
    exceptions: frozenset[str]
    curve: tuple[float, float, float]


class Matcher:
    """The automaton of a lexicon."""

    def __init__(self, lexicon: Lexicon):
        self.curve = lexicon.curve
        self.automaton = ahocorasick.Automaton()
        for term, weight in lexicon.weights.items():
            self.automaton.add_word(term, (len(term), weight))
        for phrase in lexicon.exceptions:
            self.automaton.add_word(phrase, (len(phrase), None))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def found(self, folded: str) -> list[tuple[int, int, float]]:
        """Start, end and weight of the best term at each word, without those in exception phrases."""
        if self.empty or not folded:
            return []
        best: dict[int, tuple[int, float]] = {}
        spared: list[tuple[int, int]] = []
        for last, (size, weight) in self.automaton.iter(folded):
            start, end = last - size + 1, last + 1
            if weight is None:
                spared.append((start, end))
            elif start not in best or weight > best[start][1]:
                best[start] = (end, weight)
        return [
            (start, end, weight)
            for start, (end, weight) in best.items()
            if not any(a <= start and end <= b for a, b in spared)
        ]

    def features(self, folded: str) -> tuple[float, float]:
        """Weight found, and weight found per hundred words, both as logarithms."""
        total = sum(weight for _, _, weight in self.found(folded))
        words = max(1, folded.count(" ") - 1)
        return math.log1p(total), math.log1p(100 * total / words)

    def score(self, folded: str) -> float:
        one, two = self.features(folded)
        a, b, c = self.curve
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * one + c * two))))


def _terms(words: Iterable[str]) -> set[str]:
    out = set()
    for word in words:
        out.add(f" {word} ")
        out.update(f" {word[:size]}" for size in STEMS if len(word) > size)
    return out


def _sample(docs: DataFrame, labels: DataFrame, per_label: int) -> DataFrame:
    """Folded texts of about ``per_label`` documents of each label at most, drawn by a hash of the id."""
    labels = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter("toxic IN (0, 1) AND doc_id IS NOT NULL")
    counts = labels.groupBy("toxic").agg((F.lit(float(per_label)) / F.count(F.lit(1))).alias("share"))
    drawn = labels.join(F.broadcast(counts), "toxic").filter(
        F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.col("share") * (1 << 30)
    )
    # At most about 2 * per_label rows, so the side that is sent to all tasks is bounded.
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            folded = [fold(text) for text in batch["text"]]
            yield pd.DataFrame({"folded": folded, "toxic": batch["toxic"], "weight": 1 / batch["share"].clip(upper=1)})

    return session.staged(rows.mapInPandas(run, "folded string, toxic int, weight double"), "toxicity-sample")


def _counted(rows: DataFrame, terms_of) -> DataFrame:
    """term and n: in how many texts each term of ``terms_of(folded)`` is, summed in each task first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for folded in batch["folded"]:
                counts.update(terms_of(folded))
            if len(counts) > 1_000_000:
                yield pd.DataFrame({"term": list(counts), "n": list(counts.values())})
                counts = Counter()
        yield pd.DataFrame({"term": list(counts), "n": list(counts.values())}).astype({"term": str, "n": "int64"})

    return rows.mapInPandas(run, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    exceptions: Iterable[str] = (),
    per_label: int = 10_000,
    min_share: float = 0.005,
    min_weight: float = 3.0,
    min_varied: float = 0.25,
    max_terms: int = 5_000,
) -> Lexicon:
    """A lexicon from labelled texts: ``docs`` has doc_id and text, ``labels`` doc_id and toxic (0, 1 or null).

    Fitted on a sample of about ``per_label`` texts of each label at most. A term must be in
    ``min_share`` of the sampled toxic texts (three at least) and its log-odds must reach
    ``min_weight``, and it must follow different words (``min_varied`` of its texts), lest the
    words of a passage that toxic copies share become terms. Word beginnings stand in for the longer terms they cover equally well.
    Phrases of a term and a neighbouring word found mostly in texts that are not toxic become
    exceptions, beside the given ones. Without toxic or without other texts the lexicon is
    empty and every score the share of toxic texts.
    """
    sample = _sample(docs, labels, per_label)
    sizes = dict(sample.groupBy("toxic").count().collect())
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    phrases = frozenset(p for p in map(fold, exceptions) if p)
    if not toxic or not clean:
        return Lexicon({}, phrases, (math.log((toxic + 0.5) / (clean + 0.5)), 0.0, 0.0))
    least = max(3, math.ceil(min_share * toxic))
    common = _counted(sample.filter("toxic = 1"), lambda folded: _terms(set(folded.split())))
    common = common.filter(F.col("n") >= least).orderBy(F.desc("n"), "term").limit(20 * max_terms).collect()
    in_toxic = {row["term"]: row["n"] for row in common}
    in_clean = dict(_counted(sample.filter("toxic = 0"), lambda folded: _terms(set(folded.split())) & in_toxic.keys()).collect())

    def odds(n: int, of: int) -> float:
        return math.log((n + 0.5) / (of - n + 0.5))

    weights = {t: odds(n, toxic) - odds(in_clean.get(t, 0), clean) for t, n in in_toxic.items()}
    weights = {t: w for t, w in weights.items() if w >= min_weight}

    def in_context(folded: str) -> set[str]:
        words = folded.split()
        return {f"{left}{term}" for left, word in zip(["", *words], words) for term in _terms([word]) & weights.keys()}

    # Words of one passage that many texts share always follow the same word.
    contexts = _counted(sample.filter("toxic = 1"), in_context)
    contexts = contexts.groupBy(F.regexp_extract("term", "( .*)$", 1).alias("term")).count()
    varied = dict(contexts.collect())
    weights = {t: w for t, w in weights.items() if varied.get(t, 0) >= max(2, min_varied * in_toxic[t])}
    chosen: dict[str, float] = {}
    for term in sorted(weights, key=lambda t: (len(t), t)):
        covers = [term[:size] for size in range(1 + STEMS.start, len(term)) if term[:size] in chosen]
        if not covers or weights[term] > max(chosen[c] for c in covers) + 1:
            chosen[term] = weights[term]
    chosen = dict(sorted(chosen.items(), key=lambda item: (-item[1], item[0]))[:max_terms])
    plain = Matcher(Lexicon(chosen, phrases, (0, 0, 0)))

    def near_terms(folded: str) -> set[str]:
        out = set()
        for start, end, _ in plain.found(folded):
            word_end = folded.index(" ", max(end - 1, start + 1))
            before = folded.rfind(" ", 0, start) if start else -1
            after = folded.find(" ", word_end + 1)
            if before >= 0:
                out.add(folded[before : word_end + 1])
            if after >= 0:
                out.add(folded[start : after + 1])
        return out

    near_clean = _counted(sample.filter("toxic = 0"), near_terms).filter(F.col("n") >= least).collect()
    if near_clean:
        near_toxic = dict(_counted(sample.filter("toxic = 1"), lambda f: near_terms(f) & {r["term"] for r in near_clean}).collect())
        spared = {r["term"] for r in near_clean if odds(near_toxic.get(r["term"], 0), toxic) < odds(r["n"], clean)}
        phrases = phrases | spared
    matcher = Matcher(Lexicon(chosen, phrases, (0, 0, 0)))

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array([matcher.features(folded) for folded in batch["folded"]]).reshape(-1, 2)
            yield pd.DataFrame({"one": x[:, 0], "two": x[:, 1], "toxic": batch["toxic"], "weight": batch["weight"]})

    points = sample.mapInPandas(measured, "one double, two double, toxic int, weight double")
    # Sums by rounded value, so that few rows reach the driver whatever the size of the sample.
    grid = points.groupBy(F.round("one", 2).alias("one"), F.round("two", 2).alias("two"), "toxic").agg(F.sum("weight").alias("weight"))
    return Lexicon(chosen, phrases, _logistic(grid.toPandas()))


def _logistic(points: pd.DataFrame, steps: int = 50, ridge: float = 1e-3) -> tuple[float, float, float]:
    """Weighted logistic regression by Newton's method."""
    points = points.sort_values(["one", "two", "toxic"])
    x = np.column_stack([np.ones(len(points)), points["one"], points["two"]]).astype(float)
    y, weight = points["toxic"].to_numpy(float), points["weight"].to_numpy(float)
    weight = weight / weight.sum()
    beta = np.zeros(3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - ridge * beta
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(3)
        beta = beta + np.linalg.solve(curvature, gradient)
    return tuple(float(b) for b in beta)


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), hits and words of every row. Null and empty texts score as texts without a hit."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(lexicon)
        for batch in batches:
            folded = [fold(text) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "score": [matcher.score(f) for f in folded],
                    "hits": [len(matcher.found(f)) for f in folded],
                    "words": [max(0, f.count(" ") - 1) for f in folded],
                }
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, f"doc_id {kind}, score double, hits bigint, words bigint")
