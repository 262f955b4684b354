from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tillroll.llm import manifest


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row) -> str:
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(leaves: list[str]) -> tuple[str, list[list[str]]]:
    """The root, and for every leaf the other digests of its runs, from the leaf up."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for i, place in enumerate(at):
            first = place - place % 16
            paths[i].append((nodes[first:place], nodes[place + 1 : first + 16]))
        nodes = [sha(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
        at = [place // 16 for place in at]
    return nodes[0], paths


def expected(rows):
    """doc_id, leaf, path, subroot and root of rows of the documents table."""
    full = [(r[0], r[3], r[2], r[4], r[1]) for r in rows]  # doc_id, source, lang, n_chars, text
    sources = sorted({r[1] for r in full}, key=lambda s: (s is not None, (s or "").encode()))
    by = {}
    for source in sources:
        own = sorted(((r[0] is not None, r[0] or 0, leaf(r)) for r in full if r[1] == source))
        by[source] = ([(doc if some else None, h) for some, doc, h in own], *tree([h for *_, h in own]))
    root, tops = tree([by[s][1] for s in sources])
    out = []
    for source, top in zip(sources, tops, strict=True):
        own, subroot, paths = by[source]
        for (doc, h), path in zip(own, paths, strict=True):
            joined = tuple(("".join(left), "".join(right)) for left, right in [*path, *top])
            out.append((doc, source, h, joined, subroot, root))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.source, r.leaf, tuple((p.left, p.right) for p in r.path), r.subroot, r.root) for r in df.collect()), key=repr)


def rows_of(sizes, start=0):
    draw, rows = random.Random(5), []
    for source, size in sizes.items():
        rows += [(start + len(rows) + i, f"Text {draw.random()} ü", "en", source, draw.choice([3, None])) for i in range(size)]
    draw.shuffle(rows)
    return rows


SIZES = {"web": 300, "wiki": 257, None: 17, "": 16, "é": 1, "Z": 33, "z": 2}


@pytest.mark.parametrize("digits", [3, 1])
def test_proofs_follow_plain_python(docs, monkeypatch, odd_rows, digits):
    """Also with blocks of one run, whose digests are rolled up in tiers of their own."""
    monkeypatch.setattr(manifest, "DIGITS", digits)
    monkeypatch.setattr(manifest, "BLOCK", manifest.FAN**digits)
    few = {f"s{i:02}": 1 + i % 3 for i in range(40)}
    rows = rows_of(SIZES | few, 100)
    rows += [row if len(row) == 5 else (*row, "en", "web", len(row[1] or "")) for row in odd_rows]
    assert result(manifest.proofs(docs(rows, clash=True).repartition(6))) == expected(rows)


@pytest.mark.parametrize("size", [1, 2, 16, 17, 256, 257])
def test_sizes_at_the_borders(docs, size):
    rows = rows_of({"one": size})
    got = manifest.proofs(docs(rows))
    assert result(got) == expected(rows)
    checked = got.select(manifest.folded(F.col("leaf"), F.col("path")).alias("root"), F.col("root").alias("want"), "subroot")
    assert all(r.root == r.want == r.subroot for r in checked.collect())


def test_rows_that_repeat_are_leaves_of_their_own(docs):
    rows = [(1, "a", "en", "s", 1)] * 20 + [(None, None, None, None, None)] * 18 + [(1, "b", "en", "s", 1)]
    assert result(manifest.proofs(docs(rows).repartition(7))) == expected(rows)


def test_changes_are_found(docs):
    rows = rows_of({"web": 40, "wiki": 5})
    table = docs(rows)
    changed = manifest.leaf([F.upper("text") if c == "text" else F.col(c) for c in manifest.COLUMNS])
    got = manifest.proofs(table, carried={"changed": F.when(F.col("doc_id") % 3 == 0, changed)})
    root = manifest.folded(F.coalesce("changed", "leaf"), F.col("path"))
    for row in got.select("doc_id", (root == F.col("root")).alias("ok"), manifest.siblings_digest(F.col("path")).alias("d"), "path").collect():
        assert row.ok == (row.doc_id % 3 != 0)
        assert row.d == sha(*[side for p in row.path for side in (p.left, p.right)])


def test_no_join_after_the_numbers(spark, docs):
    """Proofs come from grouping, transforming and exploding only."""
    tier = manifest._rolled(
        spark.range(100).selectExpr("'s' AS source", "id AS rank", "100L AS total", "sha2(string(id), 256) AS hash", "struct(id) AS payload"), "source"
    )
    up = F.struct(F.array().cast(manifest.PATH).alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"))
    above = tier.select("source", F.col("block").alias("rank"), up.alias("up"))
    plan = manifest._emitted(manifest._attached(tier, above, "source"), "source")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" in plan


def test_empty_table(docs):
    assert manifest.proofs(docs([])).collect() == []
