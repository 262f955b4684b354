"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. An n-gram is the product of its letters'
vectors, each rotated by its place, a text the sum of its n-grams, a language the sum of
its texts. A text gets the language whose profile has the highest cosine with it.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIM = 1024
NGRAM = 3
SEED = 20_011
#: Characters and texts handled together in a task; longer texts are read piece by piece.
CHUNK_CHARS, CHUNK_TEXTS = 1 << 19, 256
UNKNOWN = "und"
#: Least cosine with the nearest profile: three standard deviations below that of unrelated texts.
LEAST = -3 / DIM**0.5
#: Languages that a model can have; their sums are what reaches the driver.
MOST_LANGS = 1_000


@dataclass(frozen=True)
class Profiles:
    """Unit vectors of languages, one row each."""

    langs: tuple[str, ...]
    vectors: np.ndarray


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


@functools.lru_cache(maxsize=4096)
def _letter_vector(code: int) -> np.ndarray:
    """The vector of a letter; code 0 is the gap between words."""
    return np.random.default_rng([SEED, code]).integers(0, 2, DIM, dtype=np.int8) * 2 - 1


def vectors(texts: list[str | None]) -> np.ndarray:
    """One row per text, all zero for texts without letters."""
    out = np.zeros((len(texts), DIM), np.float32)
    pieces, owners, size = [], [], 0
    for at, text in enumerate(texts):
        text = text or ""
        for start in range(0, len(text), CHUNK_CHARS):
            piece = text[start : start + CHUNK_CHARS + NGRAM - 1]
            if size + len(piece) > CHUNK_CHARS or len(pieces) == CHUNK_TEXTS:
                _add(out, pieces, owners)
                pieces, owners, size = [], [], 0
            pieces.append(piece)
            owners.append(at)
            size += len(piece)
    _add(out, pieces, owners)
    return out


def _add(out: np.ndarray, pieces: list[str], owners: list[int]) -> None:
    """Add the n-gram vectors of each piece to the row of its owner."""
    if not pieces:
        return
    lower = [" " + piece.lower() + " " for piece in pieces]
    codes = np.frombuffer("".join(lower).encode("utf-32-le", "replace"), np.uint32)
    sizes = np.array([len(x) for x in lower])
    piece_of = np.repeat(np.arange(len(lower)), sizes)
    letter = _letters()[codes]
    used = letter | np.concatenate(([True], letter[:-1]))  # of a run of other characters the first one
    used[np.cumsum(sizes) - sizes] = True
    codes, piece_of = np.where(letter, codes, 0)[used], piece_of[used]
    alphabet, symbols = np.unique(codes, return_inverse=True)
    count = len(codes) - NGRAM + 1
    if count < 1 or len(alphabet) < 2:
        return
    grams = np.zeros(count, np.int64)
    for place in range(NGRAM):
        grams = grams * len(alphabet) + symbols[place : place + count]
    inside = piece_of[:count] == piece_of[NGRAM - 1 :]
    grams, rows = grams[inside], piece_of[:count][inside]
    kinds, grams = np.unique(grams, return_inverse=True) if len(alphabet) > 128 else _ranked(grams, len(alphabet) ** NGRAM)
    table = np.stack([_letter_vector(int(code)) for code in alphabet])
    gram_vectors = np.ones((len(kinds), DIM), np.int8)
    for place in range(NGRAM):
        symbol = kinds // len(alphabet) ** (NGRAM - 1 - place) % len(alphabet)
        gram_vectors *= np.roll(table, NGRAM - 1 - place, axis=1)[symbol]
    step = max(1, (1 << 21) // max(1, len(kinds)))
    for first in range(0, len(pieces), step):
        part = (rows >= first) & (rows < first + step)
        n = min(step, len(pieces) - first)
        counts = np.bincount((rows[part] - first) * len(kinds) + grams[part], minlength=n * len(kinds))
        sums = counts.reshape(n, len(kinds)).astype(np.float32) @ gram_vectors.astype(np.float32)
        np.add.at(out, owners[first : first + n], sums)


def _ranked(values: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values below ``top`` and the place of each value among them, without a sort."""
    seen = np.zeros(top, bool)
    seen[values] = True
    kinds = np.flatnonzero(seen)
    place = np.zeros(top, np.int64)
    place[kinds] = np.arange(len(kinds))
    return kinds, place[values]


def _units(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def train(docs: DataFrame, per_lang: int = 4_000, text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Profiles of the languages in ``lang_col``, from about ``per_lang`` texts of each at most.

    The sample follows a hash of the text, so a run on the same rows draws the same texts.
    Rows without a language, or without letters, add nothing. Only the summed vectors, one
    per language, reach the driver; more than MOST_LANGS languages raise.
    """
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang IS NOT NULL")
    share = rows.groupBy("lang").agg((F.lit(float(per_lang)) / F.count(F.lit(1))).alias("share"))
    share = docs.sparkSession.createDataFrame(share.limit(MOST_LANGS + 1).collect(), share.schema)
    if share.count() > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    drawn = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.col("share") * (1 << 30)
    sample = rows.join(F.broadcast(share), "lang").filter(drawn).select("lang", "text")

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch["lang"].to_numpy()
            units = _units(vectors(batch["text"].tolist()))
            for lang in set(langs):
                # Whole numbers add up alike in any order, so the profiles do not depend on the partitions.
                whole = np.rint(units[langs == lang] * 2**20).astype(np.int64)
                sums[lang] = sums.get(lang, 0) + whole.sum(axis=0)
        if sums:  # a task may have no row
            yield pd.DataFrame({"lang": list(sums), "part": list(sums.values())})

    parts = sample.mapInPandas(bundle, "lang string, part array<bigint>")
    summed = (
        parts.select("lang", F.posexplode("part").alias("place", "value"))
        .groupBy("lang", "place")
        .agg(F.sum("value").alias("value"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("values"))
        .select("lang", F.col("values.value").alias("vector"))
        .orderBy("lang")
        .collect()
    )
    rows = np.array([row["vector"] for row in summed], np.float64).reshape(len(summed), DIM)
    return Profiles(tuple(row["lang"] for row in summed), _units(rows).astype(np.float32))


def detect(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every row of ``docs``.

    Null and letterless texts are ``und`` with score 0, as is every text if there is no
    profile. The score is the cosine with the profile, at least 0. Of equal cosines the
    first language by name wins.
    """

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            units = _units(vectors(batch["text"].tolist()))
            known = units.any(axis=1) & bool(profiles.langs)
            langs, scores = np.full(len(batch), UNKNOWN, object), np.zeros(len(batch))
            if known.any():
                cosines = units[known] @ profiles.vectors.T
                langs[known] = np.array(profiles.langs, object)[cosines.argmax(axis=1)]
                scores[known] = np.clip(cosines.max(axis=1), 0, 1)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang_pred": langs, "score": scores})

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(predict, f"doc_id {kind}, lang_pred string, score double")


def known(
    docs: DataFrame, profiles: Profiles, text_col: str = "text", least: float = LEAST, lang_col: str | None = None
) -> DataFrame:
    """The rows of ``docs``, all columns, that are like some language: a cosine with its profile of at least ``least``.

    Null and letterless texts go. Two unrelated vectors have a cosine of 0, give or take 1 / sqrt(DIM), so by default
    only what points away from all languages goes, and one short word stays. Without profiles all texts
    with a letter stay. The rows themselves go through the scoring, so nothing is joined. A column ``lang_col``,
    if named, has the language of the nearest profile, as ``detect`` finds it; it replaces one of that name.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _units(vectors(batch.column(text_col).to_pylist()))
            like = units.any(axis=1)
            langs = np.full(len(units), UNKNOWN, object)
            if profiles.langs:
                cosines = units @ profiles.vectors.T
                like &= cosines.max(axis=1) >= least
                langs = np.array(profiles.langs, object)[cosines.argmax(axis=1)]
            if lang_col is not None:
                columns = [pa.array(langs, pa.string()) if c == lang_col else batch.column(c) for c in schema.names]
                batch = pa.RecordBatch.from_arrays(columns, schema.names)
            yield batch.filter(pa.array(like))

    schema = docs.schema if lang_col is None else docs.withColumn(lang_col, F.lit(None).cast("string")).schema
    return docs.mapInArrow(keep, schema)
