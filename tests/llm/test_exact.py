from __future__ import annotations

import hashlib
from collections import defaultdict

from tillroll.llm import exact


def norm(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def expected(rows):
    groups = defaultdict(list)
    for doc, text, *_ in rows:
        groups[norm(text)].append(doc)
    out = []
    for doc, text, *_ in rows:
        same = groups[norm(text)]
        keep = max((d for d in same if d is not None), default=None)
        out.append((doc, keep, len(same), doc == keep, hashlib.sha256(norm(text).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_groups_follow_plain_python(docs, odd_rows, random_texts):
    rows = odd_rows + [(100 + i, text) for i, text in enumerate(random_texts)]
    got = exact.groups(docs(rows, clash=True))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


def test_hot_group_and_empty_table(docs):
    got = exact.groups(docs([(i, "Same") for i in range(500)]), salts=4).collect()
    assert {(r.keep_id, r.group_size) for r in got} == {(499, 500)} and sum(r.kept for r in got) == 1
    assert exact.groups(docs([])).collect() == []


def test_dedup_keeps_columns(docs):
    df = docs([(1, "A"), (2, "a"), (3, "É"), (4, "é"), (5, None), (6, "")], clash=True)
    kept = exact.dedup(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 6]


def test_no_python_in_the_plan(docs):
    plan = exact.groups(docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_dedup_keeps_one_row_per_text(docs):
    rows = [
        (None, "No id"),
        (None, "no id"),
        (None, "also WITH id"),
        (7, "also with id"),
        (1, "twice"),
        (1, "twice"),
        (2, "of two texts"),
        (2, "Other"),
        (9, "other"),
        (None, None),
        (None, ""),
    ]
    for table in (rows, rows + rows):
        df = docs(table, clash=True)
        kept = exact.dedup(df)
        assert kept.columns == df.columns
        got = sorted(((r.doc_id, norm(r.text)) for r in kept.collect()), key=repr)
        want = {norm(text): max((d for d, t in rows if norm(t) == norm(text) and d is not None), default=None) for _, text in rows}
        assert got == sorted(((doc, text) for text, doc in want.items()), key=repr)


def test_pipeline_stages_pass_one_row_per_text_on(docs):
    import corpus_pipeline

    rows = [(None, "a text without an id"), (None, "another text without one"), (3, "a text of its own")]
    out = corpus_pipeline.near_dedup(None, corpus_pipeline.exact_dedup(None, docs(rows * 2), ""), "")
    assert sorted(r.text for r in out.collect()) == sorted(text for _, text in rows)
