from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tillroll.llm import mixing


def sized(draw, n, sources):
    return [(i, "w " * draw.randint(0, 40), "en", draw.choice(sources), 0) for i in range(n)]


def waterfill(sizes, weights, most=3):
    """Raise one level for all until every word has its place; capped sources stay behind."""
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        share = sum(weights[s] for s in sizes if s not in capped)
        over = {s for s in sizes if s not in capped and rest * weights[s] > most * sizes[s] * share}
        if not over:
            return {s: float(most * sizes[s]) if s in capped else rest * weights[s] / share for s in sizes}
        capped |= over


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_taken(docs, seed):
    draw = random.Random(seed)
    rows = sized(draw, 400, ["b", "a", None, "Z", "é", "a", "a"])
    got = mixing.mix(docs(rows, clash=True)).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    order = sorted((s for s in sizes if s is not None), key=str.encode) + [None]
    weights = {s: i % 3 + 1 for i, s in enumerate(order)}
    want = waterfill(sizes, weights)
    for source in sizes:
        own = [r for r in got if r.source == source]
        assert {round(r.target, 6) for r in own} == {round(want[source], 6)}
        assert all(r.taken % max(1, r.size) == 0 and r.taken <= 3 * r.size for r in own)
        taken = sum(r.taken for r in own)
        assert abs(taken - want[source]) <= max(r.size for r in own)
        # The documents taken once more are those with the lowest hashes.
        hashes = {r.doc_id: hashlib.md5(str(r.doc_id).encode()).hexdigest()[:9] for r in own}
        times = {r.doc_id: r.taken // r.size for r in own if r.size}
        top = max(times.values())
        more, less = [hashes[d] for d in times if times[d] == top], [hashes[d] for d in times if times[d] < top]
        assert not less or max(more) < min(less)
    again = mixing.mix(docs(rows)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)


def test_odd_rows(docs, odd_rows):
    got = mixing.mix(docs(odd_rows, clash=True)).collect()
    assert len(got) == len(odd_rows)
    assert all(r.taken == 0 for r in got if r.doc_id in (1, 2, 3))
    assert mixing.mix(docs([])).collect() == []
    assert [r.taken for r in mixing.mix(docs([(1, None)])).collect()] == [0]


def test_given_weights_and_nested_budgets(spark, docs):
    draw = random.Random(9)
    rows = sized(draw, 300, ["a", "b"])

    def times(b_weight):
        weights = spark.createDataFrame([("a", 2), ("b", b_weight)], "source string, weight bigint")
        return {r.doc_id: r.taken for r in mixing.mix(docs(rows), weights).collect() if r.source == "a"}

    small, large = times(4), times(2)
    assert all(small[d] <= large[d] for d in small) and sum(small.values()) < sum(large.values())


def test_repeated_rows_of_the_mix(docs):
    df = docs([(i, "w " * 10, "en", "ab"[i % 2], 0) for i in range(60)] + [(99, "", "en", "a", 0)], clash=True)
    taken = {r.doc_id: r.taken // r.size for r in mixing.mix(df).collect() if r.size}
    out = mixing.repeated(df)
    assert out.columns == df.columns
    counts = {}
    for r in out.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts.pop(99) == 1
    assert counts == {d: n for d, n in taken.items() if n}


def test_repeated_rows_without_an_id_or_of_one(docs):
    draw = random.Random(4)
    for doc in (None, 5):
        rows = [(doc, f"w{i} " * 10, "en", source, 0) for i, source in enumerate("a" * 300 + "b" * 300 + "c" * 60)]
        draw.shuffle(rows)
        target = {r.source: (r.target, r.source_size) for r in mixing.mix(docs(rows)).collect()}
        per_row = {}
        for r in mixing.repeated(docs(rows, clash=True)).collect():
            per_row[r.source, r.text] = per_row.get((r.source, r.text), 0) + 1
        assert max(per_row.values()) <= 3
        for source, (want, size) in target.items():
            got = 10 * sum(n for (s, _), n in per_row.items() if s == source)
            # Rows that share an id are taken as one; those without an id spread, and the target is met.
            assert abs(got - want) <= (10 if doc is None else size)


def test_parts_of_a_source_are_taken_in_proportion(docs):
    draw = random.Random(5)
    rows = [(i, "w " * draw.randint(1, 40), draw.choice(["x", "x", "x", "y", None]), draw.choice(["a", "a", "b", None]), 0) for i in range(900)]
    df = docs([*rows, (1000, "", "z", "a", 0), (1001, None, None, "empty", 0)], clash=True)
    out = mixing.repeated(df, part_col="lang")
    assert out.columns == df.columns
    counts = {}
    for r in out.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts[1000] == counts[1001] == 1
    target = {r.source: r.target for r in mixing.mix(df).collect()}
    size, taken, most = {}, {}, {}
    for doc, text, lang, source, _ in rows:
        n = len(text.split())
        size[source, lang] = size.get((source, lang), 0) + n
        taken[source, lang] = taken.get((source, lang), 0) + n * counts.get(doc, 0)
        most[source, lang] = max(most.get((source, lang), 0), n)
    of = {s: sum(n for (source, _), n in size.items() if source == s) for s in ("a", "b", None)}
    assert all(abs(taken[k] - target[k[0]] * n / of[k[0]]) <= most[k] for k, n in size.items())
    one = mixing.repeated(df.withColumn("lang", F.lit("x")), part_col="lang")
    assert sorted(str(r.doc_id) for r in one.collect()) == sorted(str(r.doc_id) for r in mixing.repeated(df).collect())
