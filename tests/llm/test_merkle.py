from __future__ import annotations

import hashlib
import random

from tillroll.llm import merkle


def starts(data):
    """Each line with its break, and where it begins."""
    out, at = [], 0
    for line in data.split(b"\n"):
        out.append((at, line + b"\n"))
        at += len(line) + 1
    if out:
        out[-1] = (out[-1][0], out[-1][1][:-1])
    return [(at, line) for at, line in out if line]


def test_compared_follows_plain_python(docs, odd_rows, random_texts):
    rows = [row for row in odd_rows if row[0] not in (8, None)] + [(100 - 7 * i, t) for i, t in enumerate(random_texts, 20)]
    rows.sort()
    got = {r.doc_id: r for r in merkle.compared(docs(rows[::-1], clash=True), tasks=5).collect()}
    assert len(got) == len(rows)
    for at, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(at + 1) % len(rows)][1] or ""
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        row = got[doc]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (row.fingerprint, row.edited_fingerprint) == (merkle.fingerprint(text), merkle.fingerprint(edited))
        assert row.near_edited == merkle.likeness(row.fingerprint, row.edited_fingerprint)
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        if text == after:
            assert row.near_next == 1
        new = [(at, line) for at, line in starts(edited.encode()) if line not in set(line for _, line in starts(text.encode()))]
        assert row.changed_paragraphs == len(new)
        assert row.changed_bytes == sum(len(line) for _, line in new) and row.first_change == (new[0][0] if new else None)


def test_repeated_ids_missing_ids_and_small_tables(docs, odd_rows):
    got = merkle.compared(docs(odd_rows), tasks=3).collect()
    assert sorted(map(str, (r.doc_id for r in got))) == sorted(map(str, (r[0] for r in odd_rows)))
    assert merkle.compared(docs([])).collect() == []
    (one,) = merkle.compared(docs([(5, "a b c d")]), tasks=4).collect()
    assert one.near_next == 1 and one.edited_sha256 == hashlib.sha256(b"a b c a").hexdigest()


def test_fingerprints_are_equal_for_equal_texts_only():
    draw = random.Random(5)
    text = " ".join("".join(draw.choices("abcdef", k=5)) for _ in range(2000))
    assert merkle.fingerprint(text) == merkle.fingerprint(text) != merkle.fingerprint(text + " ")
    assert merkle.fingerprint(None) == merkle.fingerprint("")
    other = " ".join("".join(draw.choices("uvwxyz", k=5)) for _ in range(2000))
    part = text[: len(text) * 3 // 4] + other[: len(text) // 4]
    near = merkle.likeness(merkle.fingerprint(text), merkle.fingerprint(part))
    assert 0.6 < near < 0.9
    assert merkle.likeness(merkle.fingerprint(text), merkle.fingerprint(other)) < 0.05
    # A text of a quarter of the length is compared at the coarser level of the longer one.
    quarter = merkle.likeness(merkle.fingerprint(text), merkle.fingerprint(text[: len(text) // 4]))
    assert 0.2 < quarter < 0.6


def test_edits_are_located(docs):
    lines = [f"line {i} of the text\n" for i in range(50)]
    changed = lines.copy()
    changed[20] = "another line\n"
    changed.insert(40, "one more line\n")
    before = merkle.nodes(docs([(1, "".join(lines)), (2, "same"), (3, None)]))
    after = merkle.nodes(docs([(1, "".join(changed)), (2, "same"), (3, None)], clash=True))
    assert sorted((r.doc_id, r.paragraph) for r in merkle.edits(before, after).collect()) == [(1, 20), (1, 40)]
    assert before.filter("doc_id = 3").first().section is None
    sections = before.filter("doc_id = 1").select("section_digest").distinct().count()
    assert 3 < sections < 50
    assert merkle.nodes(docs([])).collect() == []


def test_scattered_edits_weigh_the_same_at_every_length():
    draw = random.Random(1)
    for n in (100, 500, 20_000):
        words = ["".join(draw.choices("abcdefghij", k=7)) for _ in range(n)]
        edited = list(words)
        for i in draw.sample(range(n), n // 100):
            edited[i] = f"edited{i}"
        assert merkle.likeness(merkle.fingerprint(" ".join(words)), merkle.fingerprint(" ".join(edited))) > 0.9
        half = " ".join(words[: n // 2])
        assert 0.5 < merkle.likeness(merkle.fingerprint(" ".join(words)), merkle.fingerprint(half)) < 0.8
