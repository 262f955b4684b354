"""Registered queries against their SQL, and the pipeline against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from oracle_check import compare, connect
from tillroll.llm import pieces, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, connect(FOLDER), name, FOLDER) == ""


def test_all_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name, remainder, modulus", [("op4_toxicity", 1, 3), ("op5_language_id", 2, 4)])
def test_held_out_rows_are_marked(spark, name, remainder, modulus):
    got = queries.QUERIES[name](spark, FOLDER).collect()
    assert len(got) == 200 and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == remainder) for r in got)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_few_rows_over_many_partitions(spark, tmp_path, name):
    """Most tasks have no row at all."""
    words = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))
    tables = {
        "documents": ("doc_id bigint, text string, lang string, source string, n_chars bigint", [(4, words, "en", "web", len(words))]),
        "labels": ("doc_id bigint, quality int, toxic int", [(4, 1, 0)]),
        "pages": ("page_id bigint, url string, html string", [(1, "http://a.example/b/c", "<p>x</p>")]),
        "benchmark": ("item_id bigint, text string", [(1, "wordaa wordbb")]),
    }
    for table, (schema, rows) in tables.items():
        # Files without rows are read as tasks without rows.
        for part in range(7):
            one = spark.createDataFrame(rows if part == 3 else [], schema).coalesce(1)
            one.write.mode("append").parquet(str(tmp_path / f"{table}.parquet"))
    assert len(queries.QUERIES[name](spark, str(tmp_path)).collect()) == (0 if name == "op9_paragraph_dedup" else 1)


def test_pipeline_follows_plain_python(spark, docs, tmp_path):
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    text = lambda i, n=60: " ".join(words[(i * 37 + j * (i % 5 + 1)) % 200] for j in range(n))
    rows = [(i, text(i), "en", f"s{i % 2}", 0) for i in range(30)]
    rows += [(100, text(3).upper(), "en", "s1", 0), (101, text(4) + " more", "en", "s0", 0), (102, None, "en", "s0", 0)]
    rows += [(103, "", None, None, 0), (104, "12 34", "en", "s0", 0), (105, "one", "en", None, 0)]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    left = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    newest = {}
    for r in left:
        newest[r[1].lower()] = max(newest.get(r[1].lower(), -1), r[0])
    left = [r for r in left if newest[r[1].lower()] == r[0]]

    def grams(r):
        w = r[1].lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}

    root = {r[0]: r[0] for r in left}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in left:
        for b in left:
            if a[0] < b[0] and 100 * len(grams(a) & grams(b)) >= 75 * len(grams(a) | grams(b)):
                x, y = find(a[0]), find(b[0])
                root[max(x, y)] = min(x, y)
    left = [r for r in left if find(r[0]) == r[0]]
    assert 100 not in {r[0] for r in left} and 101 not in {r[0] for r in left}

    # Shares 1, 2, 3 of s0, s1 and null; the one word of null is taken three times, the rest is shared 1 to 2.
    size = {s: sum(len(r[1].split()) for r in left if r[3] == s) for s in ("s0", "s1", None)}
    rest = sum(size.values()) - 3 * size[None]
    target = {"s0": rest / 3, "s1": rest * 2 / 3, None: 3 * size[None]}
    want = {}
    for source, goal in target.items():
        own = sorted((r for r in left if r[3] == source), key=lambda r: hashlib.md5(str(r[0]).encode()).hexdigest()[:9])
        whole, used = int(goal // size[source]), 0
        budget = goal - whole * size[source]
        for r in own:
            n = len(r[1].split())
            more = used + n <= budget or 2 * (budget - used) >= n > 0 and used <= budget
            used += n
            want[r[0]] = whole + more
    counts = {}
    for r in got:
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
        assert r.round_trip
    assert counts == {doc: n for doc, n in want.items() if n}
    encoder = pieces.Encoder(pieces.Model(open(pieces.MODEL, "rb").read()))
    texts = {r[0]: r[1] for r in left}
    assert all(r.ids == encoder.encode([texts[r.doc_id]])[0].tolist() for r in got)


def test_recognised_language_reaches_the_mix_and_the_result(spark, docs, tmp_path):
    alphabets = {"xa": "abcdefg", "xb": "stuvwxyz"}
    draw = random.Random(7)
    word = lambda lang: "".join(draw.choices(alphabets[lang], k=draw.randint(3, 7)))
    rows = []
    for i in range(160):
        lang = "xb" if i % 4 == 0 else "xa"
        # The last ones do not say their language.
        rows.append((i, " ".join(word(lang) for _ in range(draw.randint(20, 40))), lang if i < 120 else None, f"s{i % 3}", 0))
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    spoken = {r[0]: "xb" if r[0] % 4 == 0 else "xa" for r in rows}
    assert {r.lang_pred for r in got} == {"xa", "xb"} and all(r.lang_pred == spoken[r.doc_id] for r in got)
    words = {r[0]: len(r[1].split()) for r in rows}
    for source in range(3):
        own = [d for d in words if d % 3 == source]
        share = sum(words[r.doc_id] for r in got if r.doc_id % 3 == source) / sum(words[d] for d in own)
        for lang in ("xa", "xb"):
            taken = sum(words[r.doc_id] for r in got if r.doc_id % 3 == source and r.lang_pred == lang)
            assert abs(taken - share * sum(words[d] for d in own if spoken[d] == lang)) <= 80
    # Another language ID gives another mix.
    one = corpus_pipeline.mixed(spark, docs(rows).withColumn("lang_pred", F.lit("xa")), "").collect()
    assert sorted(r.doc_id for r in one) != sorted(r.doc_id for r in got)
