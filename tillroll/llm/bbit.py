"""Near-duplicate documents by b-bit MinHash: bands find candidates, packed low bits rate them,
whole shingle sets confirm them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll import session
from tillroll.llm import links, shingles

#: 32 bands of 4 minima miss a pair of similarity 0.75 once in 200,000 times.
MINIMA, WIDTH, SEED = 128, 4, 7
#: Low bits kept of each minimum. One is enough to tell unrelated texts from the threshold.
BITS = 1
#: Pairs whose estimate is this far below the threshold are not compared: five standard deviations.
MARGIN = 0.3
#: Bits of the sketch that bounds in how many shingles two sets differ, and turns in which buckets meet one centre.
SKETCH, CENTRED = 1024, 1


def signatures(docs: DataFrame) -> DataFrame:
    """id, n, two values of the set's identity, band keys, packed low bits and the odd sketch of (id, text)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids = part.column("id")
            for first, hashes, starts, counts in shingles.batches(part.column("text").to_pylist()):
                grams, sizes = shingles.sets(hashes, starts, counts)
                low = shingles.minima(grams, sizes, MINIMA, SEED)
                keys = shingles.band_keys(low, WIDTH)
                one, two = shingles.identity(grams, sizes)
                odd = shingles.odd_sketches(grams, sizes, SKETCH)
                some = np.where(sizes > 0, 1, 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, len(sizes)),
                        pa.array(sizes),
                        pa.array(one),
                        pa.array(two),
                        shingles.lists(keys[sizes > 0].ravel(), some * keys.shape[1]),
                        shingles.lists(packed(low[sizes > 0]).ravel(), some * (MINIMA * BITS // 64)),
                        shingles.lists(odd[sizes > 0].ravel(), some * (SKETCH // 64)),
                    ],
                    ["id", "n", "one", "two", "bands", "bits", "odd"],
                )

    schema = "id bigint, n bigint, one bigint, two bigint, bands array<bigint>, bits array<bigint>, odd array<bigint>"
    return docs.mapInArrow(run, schema)


def packed(low: np.ndarray) -> np.ndarray:
    """The low BITS bits of mixed minima, 64 / BITS of them in each 64-bit word."""
    each = 64 // BITS
    kept = shingles.mixed(low.astype(np.uint64)) & np.uint64(2**BITS - 1)
    kept = kept.reshape(len(low), MINIMA // each, each) << (np.arange(each, dtype=np.uint64) * np.uint64(BITS))
    return np.bitwise_or.reduce(kept, axis=2)


def estimate(a: Column, b: Column) -> Column:
    """Similarity of two packed signatures: the share of equal minima, less the share equal by chance."""
    ones = sum(1 << (BITS * i) for i in range(64 // BITS))
    ones = ones - (1 << 64) if ones >= 1 << 63 else ones
    unequal = F.lit(0)
    for word in range(MINIMA * BITS // 64):
        x = a[word].bitwiseXOR(b[word])
        y = x
        for shift in range(1, BITS):
            y = y.bitwiseOR(F.shiftrightunsigned(x, shift))
        unequal = unequal + F.bit_count(y.bitwiseAND(F.lit(ones)))
    by_chance = 1 / 2**BITS
    return (1 - unequal / MINIMA - by_chance) / (1 - by_chance)


def possible(a: Column, b: Column, percent: int, bits: int = SKETCH) -> Column:
    """Whether two sets can have so much in common: false only if their sizes or sketches rule it out.

    Sets of similarity s differ in (1 - s) / (1 + s) of their sizes' sum.
    """
    unequal = sum((F.bit_count(a["odd"][i].bitwiseXOR(b["odd"][i])) for i in range(bits // 64)), F.lit(0))
    sizes = percent * F.greatest(a["n"], b["n"]) <= 100 * F.least(a["n"], b["n"])
    return sizes & ((100 + percent) * unequal <= (100 - percent) * (a["n"] + b["n"]))


def whole_sets(docs: DataFrame) -> DataFrame:
    """id and grams (hashes of all distinct shingles) of (id, text)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for first, hashes, starts, counts in shingles.batches(part.column("text").to_pylist()):
                grams, sizes = shingles.sets(hashes, starts, counts)
                ids = part.column("id").slice(first, len(sizes))
                yield pa.RecordBatch.from_arrays([ids, shingles.lists(grams, sizes)], ["id", "grams"])

    return docs.mapInArrow(run, "id bigint, grams array<bigint>")


def near(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    Documents are linked if their sets of five-word shingles have at least ``percent`` in
    common; words are runs of anything but ASCII white space, A-Z lower-cased. Texts of
    fewer words are one shingle; null and wordless texts have none and no links. The
    component is the smallest id reachable over links; its row is kept. Ids are integers.
    Rows that share an id are one document with several texts; a row without an id is
    linked with nothing, has no component and is kept. Other columns are not read.

    Equal sets are one candidate, so copies meet by their set's identity and never as
    pairs. The identity is 128 bits of hash; candidate pairs are confirmed on all shingles.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    signed = session.staged(signatures(rows), "signatures")
    full = signed.filter("id IS NOT NULL AND n > 0")
    firsts = session.staged(full.groupBy("n", "one", "two").agg(F.min("id").alias("first")), "distinct-sets")
    distinct = full.join(firsts.withColumnRenamed("first", "id"), ["n", "one", "two", "id"], "left_semi")
    distinct = distinct.dropDuplicates(["n", "one", "two", "id"])
    buckets = distinct.select(F.explode("bands").alias("key"), "id", "bits")

    def sets_of(ids: DataFrame) -> DataFrame:
        return whole_sets(rows.join(ids, "id", "left_semi"))

    def likely(a: Column, b: Column) -> Column:
        return estimate(a["bits"], b["bits"]) >= percent / 100 - MARGIN

    def can_be(a: Column, b: Column) -> Column:
        return possible(a, b, percent)

    found = links.clusters(buckets, sets_of, percent, likely, CENTRED, distinct.select("id", "n", "odd"), can_be)
    names = firsts.join(found.withColumnRenamed("id", "first"), "first", "left")
    names = names.select("n", "one", "two", F.coalesce("component", "first").alias("named"))
    joined = signed.join(names, ["n", "one", "two"], "left")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.coalesce("named", "id"))
    component = F.when(F.col("id").isNotNull(), component)
    return joined.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def dedup(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one document of each component, with all their columns."""
    kept = near(docs, percent, id_col, text_col).filter("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(F.col("_kept_id")), "left_semi")
