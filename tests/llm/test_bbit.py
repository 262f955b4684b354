from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from tillroll.llm import bbit, links, shingles


def word_sets(rows):
    out = []
    for doc, text, *_ in rows:
        words = (text or "").encode().lower().split()
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())
        out.append((doc, grams))
    return out


def expected(rows, percent=75):
    """All pairs, one by one; rows that share an id are one node."""
    sets = word_sets(rows)
    root = {doc: doc for doc, _ in sets if doc is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, left) in enumerate(sets):
        for b, right in sets[:i]:
            if None in (a, b) or not left or not right:
                continue
            if 100 * len(left & right) >= percent * len(left | right):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted(
        ((doc, len(grams), None if doc is None else find(doc) if grams else doc) for doc, grams in sets), key=repr
    )


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def test_near_follows_all_pairs(docs, odd_rows, random_texts):
    rows = odd_rows + [(200 - i, text) for i, text in enumerate(random_texts)]
    got = bbit.near(docs(rows, clash=True))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert result(got) == expected(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())


def test_threshold_is_exact(docs):
    """Sets that share just 75 in 100, and just less."""
    words = [f"w{i}" for i in range(107)]
    rows = [(1, " ".join(words[:91])), (2, " ".join(words[12:103])), (3, " ".join(words[13:104]))]
    assert result(bbit.near(docs(rows))) == expected(rows)


def test_chains_and_hot_groups(docs):
    """Each text overlaps its neighbours only, so a chain is one component; many near copies meet no all-pairs join."""
    words = [f"v{i}" for i in range(400)]
    chain = [(i, " ".join(words[i * 6 : i * 6 + 80])) for i in range(20)]
    base = [f"u{i}" for i in range(60)]
    near = [(100 + i, " ".join([*base[:59], f"end{i}"])) for i in range(150)]
    rows = chain + near
    assert result(bbit.near(docs(rows))) == expected(rows)


def test_dedup_and_empty_table(docs, odd_rows):
    df = docs(odd_rows, clash=True)
    kept = bbit.dedup(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "10", "2", "3", "4", "5", "6", "9", "None"]
    assert bbit.near(docs([])).collect() == []


def test_estimate_matches_plain_bits(spark):
    draw = np.random.default_rng(2)
    low = draw.integers(0, 2**32, (40, bbit.MINIMA), dtype=np.uint32)
    low[20:, :90] = low[:20, :90]
    bits = bbit.packed(low).view(np.int64).tolist()
    pairs = spark.createDataFrame([(bits[i], bits[i + 20], i) for i in range(20)], "x array<bigint>, y array<bigint>, i int")
    got = {r.i: r.e for r in pairs.select("i", bbit.estimate(F.col("x"), F.col("y")).alias("e")).collect()}
    kept = shingles.mixed(low.astype(np.uint64)) & np.uint64(2**bbit.BITS - 1)
    for i in range(20):
        equal = (kept[i] == kept[i + 20]).mean()
        by_chance = 1 / 2**bbit.BITS
        assert abs(got[i] - (equal - by_chance) / (1 - by_chance)) < 1e-12
        assert abs(got[i] - 90 / 128) < bbit.MARGIN


def test_components(spark):
    draw = np.random.default_rng(1)
    pairs = {tuple(sorted(p)) for p in draw.integers(0, 300, (200, 2)).tolist() if p[0] != p[1]}
    pairs |= {(1000 + i, 1001 + i) for i in range(60)}
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in sorted(pairs):
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = links.components(spark.createDataFrame(sorted(pairs), "a bigint, b bigint")).collect()
    assert sorted((r.id, r.component) for r in got) == sorted((x, find(x)) for x in root)
    assert links.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_candidates_grow_with_the_group(docs, monkeypatch):
    """Near copies that each have edits of their own: most are not alike, and do not leave the join as pairs."""
    counts = []
    whole = links.confirmed

    def counted(pairs, sets, percent):
        counts[-1].append(pairs.count())
        return whole(pairs, sets, percent)

    monkeypatch.setattr(links, "confirmed", counted)
    for size in (150, 300):
        counts.append([])
        draw = random.Random(size)
        rows = []
        for i in range(size):
            words = [f"w{k}" for k in range(100)]
            for place in draw.sample(range(100), 3):
                words[place] = f"edit{i}x{place}"
            rows.append((i, " ".join(words)))
        assert result(bbit.near(docs(rows))) == expected(rows)
    few, many = counts
    assert sum(many) <= 3 * sum(few) and many[-1] < 300 * 299 / 2 / 20


def test_sketches_bound_the_difference():
    draw = np.random.default_rng(4)
    sets = [np.unique(draw.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 5, 300, 2_000)]
    sets += [np.concatenate([s[: len(s) * 9 // 10], draw.integers(0, 2**63, len(s) // 10 + 1).astype(np.uint64)]) for s in sets]
    sizes = np.array([len(s) for s in sets])
    rows = shingles.odd_sketches(np.concatenate(sets), sizes, bbit.SKETCH)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            unequal = sum(int(x).bit_count() for x in rows[i] ^ rows[j])
            assert unequal <= len(set(a.tolist()) ^ set(b.tolist())) and (i != j or unequal == 0)
