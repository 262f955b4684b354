"""Document fingerprints: a Merkle tree over paragraphs and sections, and a sketch of its words.

A paragraph is a line with its line break. Sections are runs of paragraphs that end where a
paragraph's digest says so, so an edit moves no border but its own. Digests of sections are
made of those of paragraphs, the root of those of sections: equal roots mean equal texts,
and only differing branches need a look to find an edit.

The fingerprint of a text is its root and, to rate likeness, the LEAVES lowest digests of its
runs of words. Runs are as short in a long text as in a short one, so scattered edits weigh
the same at every length.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from tillroll.llm.shingles import mixed

#: Most digests in a fingerprint, bytes of each, and words of a run.
LEAVES, BYTES, OVERLAP = 128, 5, 3
#: A section ends after a paragraph in so many, on average.
SECTION = 4
#: Longer words are cut for the sketch.
LONG = 64
_ODD = np.uint64(0x9E3779B97F4A7C15)


def paragraphs(data: bytes) -> list[bytes]:
    return re.findall(rb"[^\n]*\n|[^\n]+", data)


def tree(text: str | None) -> tuple[bytes, list[tuple[bytes, list[tuple[bytes, int]]]]]:
    """The root digest, and per section its digest and its paragraphs' digests and bytes."""
    sections, current = [], []
    lines = paragraphs((text or "").encode("utf-8", "replace"))
    for at, line in enumerate(lines):
        digest = xxh3_128_digest(line)
        current.append((digest, len(line)))
        if digest[0] % SECTION == 0 or at == len(lines) - 1:
            sections.append((xxh3_128_digest(b"".join(d for d, _ in current)), current))
            current = []
    return xxh3_128_digest(b"root" + b"".join(d for d, _ in sections)), sections


def located(before: tuple, after: tuple) -> list[tuple[int, int]]:
    """Start and size in bytes of the paragraphs of one tree that another one has not.

    Only differing branches are entered: equal roots end it, sections that the other tree has
    are passed over as a whole, and paragraphs are compared in what is left.
    """
    if before[0] == after[0]:
        return []
    sections = {digest for digest, _ in before[1]}
    lines: set[bytes] | None = None
    out, start = [], 0
    for digest, section in after[1]:
        if digest in sections:
            start += sum(size for _, size in section)
            continue
        if lines is None:
            lines = {line for _, old in before[1] for line, _ in old}
        for line, size in section:
            if line not in lines:
                out.append((start, size))
            start += size
    return out


def _leaves(data: bytes) -> tuple[int, np.ndarray]:
    """How many runs a text has, and their lowest digests; a run that is there again has another digest."""
    words = data.split()
    if words and len(max(words, key=len)) > LONG:
        words = [word[i : i + LONG] for word in words for i in range(0, len(word), LONG)]
    hashes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    runs = hashes.copy()
    for back in range(1, OVERLAP):
        runs[back:] = runs[back:] * _ODD + hashes[:-back]
    order = np.argsort(runs, kind="stable")
    runs = runs[order]
    new = np.flatnonzero(np.concatenate(([True], runs[1:] != runs[:-1]))) if len(runs) else order
    again = np.arange(len(runs)) - np.repeat(new, np.diff(np.append(new, len(runs))))
    digests = mixed(runs ^ mixed(again.astype(np.uint64))) >> np.uint64(64 - 8 * BYTES)
    if len(digests) > LEAVES:
        digests = np.partition(digests, LEAVES - 1)[:LEAVES]
    return len(runs), np.sort(digests)


def fingerprint(text: str | None, of: tuple | None = None) -> str:
    """Root in hexadecimal, number of leaves and the lowest of them; null is an empty text. ``of`` may give its tree."""
    root, _ = of or tree(text)
    count, digests = _leaves((text or "").encode("utf-8", "replace"))
    packed = digests.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BYTES :].tobytes()
    return f"{root.hex()}:{count}:{base64.b64encode(packed).decode()}"


def _parsed(value: str) -> np.ndarray:
    packed = value.rsplit(":", 1)[1]
    rows = np.frombuffer(base64.b64decode(packed), np.uint8).reshape(-1, BYTES)
    wide = np.concatenate([np.zeros((len(rows), 8 - BYTES), np.uint8), rows], axis=1)
    return wide.ravel().view(">u8").astype(np.uint64)


def likeness(a: str, b: str) -> float:
    """Share of leaves that two texts have in common, 1 for equal texts and 0 for unrelated ones.

    Exact if both have fewer than LEAVES leaves, else estimated from the LEAVES lowest ones of
    both, with a standard deviation of 0.05 at most.
    """
    if a == b:
        return 1.0
    a_leaves, b_leaves = _parsed(a), _parsed(b)
    every, found = np.unique(np.concatenate([a_leaves, b_leaves]), return_counts=True)
    # What one of them lacks for having LEAVES lower ones is not among the lowest of both.
    if max(len(a_leaves), len(b_leaves)) >= LEAVES:
        every, found = every[:LEAVES], found[:LEAVES]
    if not len(every):  # texts of white space only, which differ
        return 0.0
    common = int((found > 1).sum())
    return 2 * common / (len(every) + common)


def nodes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The trees as a table: doc_id, section, paragraph, start, size, digest, section_digest, root.

    One row per paragraph; start and size are in UTF-8 bytes. Null and empty texts have one
    row without a section, so that their root is there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                root, sections = tree(text)
                start, place = 0, 0
                if not sections:
                    out.append((doc, None, None, 0, 0, None, None, root.hex()))
                for at, (section_digest, lines) in enumerate(sections):
                    for digest, size in lines:
                        out.append((doc, at, place, start, size, digest.hex(), section_digest.hex(), root.hex()))
                        start, place = start + size, place + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*out, strict=True), arrow, strict=True)], names
            )

    names = ["doc_id", "section", "paragraph", "start", "size", "digest", "section_digest", "root"]
    kind = docs.schema[id_col].dataType
    arrow = [pa.int64() if isinstance(kind, T.LongType) else None, *[pa.int32()] * 2, *[pa.int64()] * 2, *[pa.string()] * 3]
    schema = f"doc_id {kind.simpleString()}, section int, paragraph int, start bigint, size bigint, digest string, section_digest string, root string"
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, schema)


def edits(before: DataFrame, after: DataFrame) -> DataFrame:
    """Paragraphs of ``after`` that ``before`` has not, for ids in both: doc_id, paragraph, start, size.

    Both are tables of ``nodes``. Documents with equal roots leave first, then sections that
    the other tree has, then paragraphs: only differing branches are compared.
    """
    roots = before.select("doc_id", "root").distinct()
    changed = after.join(roots.withColumnRenamed("root", "old_root"), "doc_id").filter("root <> old_root").drop("old_root")
    old = before.select("doc_id", "section_digest").distinct()
    changed = changed.filter("section IS NOT NULL").join(old, ["doc_id", "section_digest"], "left_anti")
    lines = before.select("doc_id", "digest").distinct()
    return changed.join(lines, ["doc_id", "digest"], "left_anti").select("doc_id", "paragraph", "start", "size")


def with_next(docs: DataFrame, tasks: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (range, doc_id, text, extra) such that each document is followed by the next one.

    Ids are cut into at most ``tasks`` ranges of like size, a range is sorted in one task, and
    the first row of the next range comes as an ``extra`` row behind it (of the first range
    behind the last). The driver holds one id per range. Texts move once. Rows without an id
    come first, rows that share one follow a hash of their text.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / tasks for i in range(1, tasks)] or [0.5], 10_000)).first()[0]
    cuts = sorted(set(cuts or []))
    step = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]

    def place(doc):
        """How many cuts are at or below an id: first the groups of cuts, then the cuts of one."""
        if not groups:
            return F.lit(0)
        firsts = F.array(*[F.lit(g[0]).cast("bigint") for g in groups])
        group = F.size(F.filter(firsts, lambda c: c <= doc))
        table = F.array(*[F.array(*[F.lit(c).cast("bigint") for c in g]) for g in groups])
        inside = F.size(F.filter(F.get(table, group - 1), lambda c: c <= doc))
        return F.when(doc.isNull() | (group == 0), 0).otherwise((group - 1) * step + inside)

    rows = rows.withColumn("range", place(F.col("doc_id")).cast("int"))
    heads = rows.groupBy("range").agg(F.min(F.struct("doc_id", "tie")).alias("head")).orderBy("range").collect()
    spark = docs.sparkSession
    before = [(heads[i - 1]["range"], h["head"]["doc_id"], h["head"]["tie"]) for i, h in enumerate(heads)]
    before = F.broadcast(spark.createDataFrame(before, "to int, head_id bigint, head_tie bigint"))
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie"))
    extra = rows.join(before, is_head).dropDuplicates(["to"]).select(F.col("to").alias("range"), "doc_id", "text", "tie")
    both = rows.select("range", "doc_id", "text", "tie", F.lit(False).alias("extra")).union(
        extra.withColumn("extra", F.lit(True))
    )
    placed = both.repartitionById(tasks, F.col("range"))
    return placed.sortWithinPartitions("range", "extra", "doc_id", "tie").drop("tie")


def compared(docs: DataFrame, tasks: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text: the last quarter (rounded down) of its
    code points replaced by as many of the next document's first ones, or all it has.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, and where the two trees differ: changed_paragraphs and changed_bytes of the edited
    text, and first_change, the byte at which the first of them begins (null if none does, as where
    paragraphs are only left out). Null texts are empty. The next document is the next row by ascending id,
    after the last the first; a table of one row follows itself.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before, its range, tree and fingerprint
        for batch in batches:
            out = []
            for place, doc, text, extra in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                text = text or ""
                own_tree = tree(text)
                own = fingerprint(text, own_tree)
                if held and held[0] == place:
                    _, before, shown, mark, shown_tree = held
                    quarter = len(shown) // 4
                    edited = shown[: len(shown) - quarter] + text[:quarter]
                    edited_tree = tree(edited)
                    edited_mark = fingerprint(edited, edited_tree)
                    changed = located(shown_tree, edited_tree)
                    found = (len(changed), sum(size for _, size in changed), changed[0][0] if changed else None)
                    digest = sha256(edited.encode("utf-8", "replace")).hexdigest()
                    out.append((before, len(shown), digest, mark, edited_mark, likeness(mark, edited_mark), likeness(mark, own), *found))
                held = None if extra else (place, doc, text, own, own_tree)
            if out:
                columns = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    arrow = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_chars", pa.int64()),
            ("edited_sha256", pa.string()),
            ("fingerprint", pa.string()),
            ("edited_fingerprint", pa.string()),
            ("near_edited", pa.float64()),
            ("near_next", pa.float64()),
            ("changed_paragraphs", pa.int64()),
            ("changed_bytes", pa.int64()),
            ("first_change", pa.int64()),
        ]
    )
    tasks = tasks or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    schema += ", changed_paragraphs bigint, changed_bytes bigint, first_change bigint"
    return with_next(docs, tasks, id_col, text_col).mapInArrow(run, schema)
