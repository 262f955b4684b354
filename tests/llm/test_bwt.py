from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tillroll.llm import bwt


def expected(rows):
    """Every string of LENGTH bytes of every row, one by one."""
    seen: dict[bytes, int] = {}
    data = [(doc, (text or "").encode()) for doc, text, *_ in rows]
    for _, raw in data:
        for p in range(len(raw) - bwt.LENGTH + 1):
            string = raw[p : p + bwt.LENGTH]
            seen[string] = seen.get(string, 0) + 1
    out = []
    for doc, raw in data:
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - bwt.LENGTH + 1):
            if seen[raw[p : p + bwt.LENGTH]] > 1:
                gone[p : p + bwt.LENGTH] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((doc, len(raw), int(gone.sum()), runs, np.frombuffer(raw, np.uint8)[~gone].tobytes()))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=repr)


@pytest.fixture
def planted():
    draw = random.Random(7)

    def text(n):
        return "".join(draw.choices("abcdefghijk é\n", k=n))

    passage, short, exact, less = text(1500), text(395), None, None
    exact = "".join(draw.choices("abcdefg ", k=400))
    less = "".join(draw.choices("abcdefg ", k=399))
    rows = [(1, text(2000)), (2, text(350)), (3, text(50) + passage + text(700)), (4, passage[100:900])]
    rows += [(5, text(300) + passage[500:1400] + text(100) + passage[200:700]), (6, short + text(900)), (7, text(80) + short)]
    rows += [(8, text(300) + exact + text(300)), (9, exact), (10, text(300) + less + text(300)), (11, less + "!")]
    rows += [(12, "ab" * 900), (13, rows[0][1]), (14, rows[0][1][:1200] + "#" + rows[0][1][1201:]), (15, "z" * 401), (16, "y" * 400)]
    rows += [(100 + i, text(420) + passage[:600] + text(420)) for i in range(12)]
    return rows


@pytest.mark.parametrize("most", [4096, 1])
def test_removed_follows_all_strings(docs, planted, odd_rows, monkeypatch, most):
    """Also where cores have more rows than are built together."""
    monkeypatch.setattr(bwt, "MOST_ROWS", most)
    rows = planted + [row for row in odd_rows if row[0] != 5] + [(5, "word " * 300)]
    got = bwt.removed(docs(rows, clash=True))
    assert result(got) == expected(rows)
    for r in got.collect():
        assert sum(e - s for s, e in zip(r.starts, r.ends, strict=True)) == r.n_removed and len(r.starts) == r.n_spans


def test_repeated_ids_and_empty_table(docs):
    long = "".join(chr(97 + i * i % 23) + str(i) for i in range(300))
    rows = [(1, long), (1, long), (2, "b" + long[::-1]), (2, "other")]
    assert result(bwt.removed(docs(rows))) == expected(rows)
    assert bwt.removed(docs([])).collect() == []


def test_segments_of_long_texts(docs, planted, monkeypatch):
    monkeypatch.setattr(bwt, "SEGMENT", 257)
    assert result(bwt.removed(docs(planted))) == expected(planted)


def test_collection_follows_sorted_suffixes():
    draw = random.Random(1)
    for _ in range(100):
        strings = [np.array(draw.choices(range(3), k=draw.randint(0, 12)), np.int64) for _ in range(draw.randint(1, 8))]
        owner, depth, before, common = bwt.collection(strings)
        suffixes = sorted(
            (tuple((int(x), 0) for x in s[len(s) - n :] + 1) + ((0, i),), i, n)
            for i, s in enumerate(strings)
            for n in range(len(s) + 1)
        )
        assert [(i, n) for _, i, n in suffixes] == list(zip(owner.tolist(), depth.tolist(), strict=True))
        assert before.tolist() == [int(strings[i][-n - 1]) if n < len(strings[i]) else -1 for _, i, n in suffixes]

        def shared(a, b):
            n = 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            return n

        want = [0] + [shared(a[0], b[0]) for a, b in zip(suffixes, suffixes[1:])]
        assert common.tolist() == want


def test_every_string_has_one_anchor():
    data = np.frombuffer(random.Random(3).randbytes(5000), np.uint8)
    place, _, first, last = bwt.anchors(data)
    assert first[0] == 0 and last[-1] == len(data) - bwt.LENGTH and (first[1:] == last[:-1] + 1).all()
    assert ((place >= last) & (place <= first + bwt.LENGTH - bwt.KMER)).all()


def test_texts_of_one_checksum_and_no_id_are_told_apart(docs):
    """Two texts of different length that share a CRC32; only one of them has a passage that repeats."""
    draw = random.Random(3)
    passage = "".join(draw.choices("abcdefgh ", k=500))
    long = passage + " end"
    target = zlib.crc32(long.encode())
    short = with_checksum(b"short", target)
    assert zlib.crc32(short.encode()) == target and short != long
    rows = [(None, long), (None, short), (1, "x" * 30 + passage)]
    assert result(bwt.removed(docs(rows))) == expected(rows)


def with_checksum(start: bytes, target: int) -> str:
    """``start`` and eight printable characters whose CRC32 is ``target``."""
    draw = random.Random(1)
    chars = [chr(c) for c in range(48, 123)]
    seen = {}
    # Half of the characters forwards, half backwards: both ends meet at one state.
    steps = [0] * 256
    for b in range(256):
        c = b
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        steps[b] = c
    back = {steps[b] >> 24: b for b in range(256)}
    state = zlib.crc32(start) ^ 0xFFFFFFFF
    for _ in range(300_000):
        half = "".join(draw.choices(chars, k=4))
        s = state
        for ch in half:
            s = s >> 8 ^ steps[(s ^ ord(ch)) & 255]
        seen[s] = half
    while True:
        half = "".join(draw.choices(chars, k=4))
        s = target ^ 0xFFFFFFFF
        for ch in reversed(half):
            b = back[s >> 24]
            s = ((s ^ steps[b]) << 8 & 0xFFFFFFFF) | (b ^ ord(ch))
        if s in seen:
            return start.decode() + seen[s] + half


def test_spans_of_copies_without_an_id_are_kept_once(docs):
    passage = "".join(random.Random(5).choices("abcdefgh ", k=600))
    rows = [(None, passage)] * 40 + [(1, passage + "!")]
    df = docs(rows)
    assert result(bwt.removed(df)) == expected(rows)
    listed = bwt.spans(df.selectExpr("coalesce(doc_id, -1) AS id", "unhex(md5(text)) AS tie", "text")).collect()
    assert all(len(r.spans) == len({(s.at, s.mask) for s in r.spans}) for r in listed)
