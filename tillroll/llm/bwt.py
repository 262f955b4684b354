"""Suffix-array dedup: bytes covered by a long string that starts anywhere else as well.

The suffix structure of a collection is built column by column: each round puts one more
symbol before every document's suffix, and one sequential pass by symbol updates the
Burrows-Wheeler transform and the common prefixes of neighbours. A whole corpus has neither
a bound on rounds nor a place for such files, so the work is cut by content first: every
string of LENGTH bytes belongs to the least of its k-mers, equal strings to equal k-mers at
equal places. Only where a k-mer repeats, and its surroundings are not simply the same,
are collections built: of the 2 * WIDTH - 2 bytes around a shared core, which is one symbol.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_intdigest

from tillroll import session
from tillroll.llm.shingles import mixed

#: Length of repeated strings, of the k-mers that place them, and strings per collection row.
LENGTH, KMER, WIDTH = 400, 96, 32
CORE = LENGTH - WIDTH + 1
#: Strings of a text examined at once.
SEGMENT = 1 << 20
#: Rows built together, and rows of one core above which single strings are counted instead.
BATCH_ROWS, MOST_ROWS = 1024, 4096
NO_ID = -(1 << 63)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < size:
        inverse = np.uint64(pow(int(_BASE), -1, 2**64))
        for place, factor in enumerate((_BASE, inverse)):
            table = np.full(size, factor, np.uint64)
            table[0] = 1
            _powers[place] = np.multiply.accumulate(table)
    return _powers[0][:size], _powers[1][:size]


def kmer_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every k-mer, the same wherever its bytes are the same."""
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], out=sums[1:])
    return mixed((sums[KMER:] - sums[:-KMER]) * inverse[: len(data) - KMER + 1])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, from minima before and after block borders."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.uint64(2**64 - 1))
    padded[: len(values)] = values
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The least k-mers of a text's strings: their places and hashes, and the first and last string of each.

    K-mers compare by the upper bits of their hash, then by place, so each string has one
    anchor and the strings of an anchor are neighbours.
    """
    parts = []
    low = np.uint64((1 << 24) - 1)  # a place within a segment
    for first in range(0, len(data) - LENGTH + 1, SEGMENT):
        hashes = kmer_hashes(data[first : first + SEGMENT + LENGTH - 1])
        places = np.arange(len(hashes), dtype=np.uint64)
        place = (_least((hashes & ~low) | places, LENGTH - KMER + 1) & low).astype(np.int64)
        begin = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        end = np.append(begin[1:], len(place)) - 1
        parts.append((first + place[begin], hashes[place[begin]], first + begin, first + end))
    if not parts:
        empty = np.zeros(0, np.int64)
        return empty, np.zeros(0, np.uint64), empty, empty
    return tuple(np.concatenate(column) for column in zip(*parts, strict=True))


def _occurrences(docs: DataFrame) -> DataFrame:
    """Anchors of all texts: id, tie, place, first and last string, hashes of k-mer and of all its strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, text in enumerate(batch.column("text").to_pylist()):
                data = (text or "").encode("utf-8", "replace")
                if len(data) < LENGTH:
                    continue
                place, kmer, first, last = anchors(np.frombuffer(data, np.uint8))
                whole = [
                    xxh3_64_intdigest(data[f : t + LENGTH], seed=p - f)
                    for p, f, t in zip(place.tolist(), first.tolist(), last.tolist(), strict=True)
                ]
                whole = np.array(whole, np.uint64).view(np.int64)
                out.append((np.full(len(place), row), place, first, last, kmer.view(np.int64), whole))
            if out:
                rows, *columns = (np.concatenate(column) for column in zip(*out, strict=True))
                ids = [batch.column(name).take(pa.array(rows)) for name in ("id", "tie")]
                yield pa.RecordBatch.from_arrays([*ids, *map(pa.array, columns)], names)

    schema = "id bigint, tie binary, place bigint, first bigint, last bigint, kmer bigint, whole bigint"
    names = [column.split()[0] for column in schema.split(", ")]
    return docs.mapInArrow(run, schema)


def _packed(docs: DataFrame) -> DataFrame:
    """id, tie and the text's bytes, compressed, as they move to other tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            data = [press.compress((text or "").encode("utf-8", "replace")) for text in batch.column("text").to_pylist()]
            columns = [batch.column("id"), batch.column("tie"), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "tie", "data"])

    return docs.mapInArrow(run, "id bigint, tie binary, data binary")


def _unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompressobj().decompress(data)


def _rows(wanted: DataFrame) -> DataFrame:
    """Cores around the wanted anchors: core hash (two values), bytes left and right of it, id, tie and base.

    A row stands for the strings that start at base, base - 1, ... base - WIDTH + 1, as far
    as the text has them. A base that several anchors share comes once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, tie, packed, found in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                data = _unpacked(packed)
                bases = {
                    anchor["place"] - block * WIDTH
                    for anchor in found
                    for block in range(
                        (anchor["place"] - anchor["last"]) // WIDTH, (anchor["place"] - anchor["first"]) // WIDTH + 1
                    )
                }
                for base in bases:
                    if base >= 0 and base + CORE <= len(data):
                        core = xxh3_128_intdigest(data[base : base + CORE])
                        left = data[max(0, base - WIDTH + 1) : base]
                        right = data[base + CORE : base + CORE + WIDTH - 1]
                        out.append(((core >> 64) - (1 << 63), core % (1 << 64) - (1 << 63), left, right, doc, tie, base))
            if out:
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.int64()]
    schema = "one bigint, two bigint, left binary, right binary, id bigint, tie binary, base bigint"
    names = [column.split()[0] for column in schema.split(", ")]
    return wanted.mapInArrow(run, schema)


def collection(strings: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The suffixes of all strings in order, built column by column from the right.

    Symbols are integers from 0; each string ends in a mark of its own. Returns, in order of
    the suffixes, their strings, their lengths, the symbols before them (the transform, -1 at
    the start of a string) and how many symbols each has in common with the suffix before it.

    Each round adds the next symbol of every string. The suffixes that begin with a symbol
    are in the order of what follows it, so a stable pass over the transform by symbol places
    old and new ones alike; the common prefix of two of them is one more than the least
    between their rests, and is worked out only beside new ones.
    """
    count = len(strings)
    sizes = np.array([len(s) for s in strings], np.int64)
    flat = np.concatenate([*strings, np.zeros(1, np.int64)]).astype(np.int64)
    starts = np.cumsum(sizes) - sizes

    def before(owner: np.ndarray, depth: np.ndarray) -> np.ndarray:
        at = sizes[owner] - depth - 1
        return np.where(at >= 0, flat[np.maximum(starts[owner] + at, 0)], -1)

    marks = np.arange(count)
    owner, depth, common = marks, np.zeros(count, np.int64), np.zeros(count, np.int64)
    symbol = before(owner, depth)
    extended = np.zeros(count, bool)
    for round_ in range(int(sizes.max(initial=0))):
        live = ~extended & (depth == round_) & (symbol >= 0)
        rests = np.flatnonzero(extended | live)
        rests = rests[np.argsort(symbol[rests], kind="stable")]
        new = live[rests]
        grown = np.zeros(len(rests), np.int64)
        grown[~new] = common[count:]
        touched = np.flatnonzero(new | np.concatenate(([False], new[:-1])))
        touched = touched[touched > 0]
        same = symbol[rests[touched]] == symbol[rests[touched - 1]]
        grown[touched[~same]] = 0
        touched = touched[same]
        if len(touched):
            ranges = np.column_stack([rests[touched - 1] + 1, rests[touched] + 1]).ravel()
            grown[touched] = 1 + np.minimum.reduceat(np.append(common, 0), ranges)[::2]
        if new.any() and new[0]:
            grown[0] = 0
        added_owner, added_depth = owner[rests], depth[rests] + 1
        was_extended = np.ones(len(rests), bool)
        was_extended[~new] = (extended | live)[count:]
        was_extended[new] = False
        owner = np.concatenate([marks, added_owner])
        depth = np.concatenate([np.zeros(count, np.int64), added_depth])
        common = np.concatenate([np.zeros(count, np.int64), grown])
        symbol = before(owner, depth)
        extended = np.concatenate([sizes > 0, was_extended])
    return owner, depth, symbol, common


def repeats(groups: list[list[tuple[bytes, bytes]]]) -> list[list[int]]:
    """For every row of every group, a bit per string: 1 << q if the string with q bytes left of the core repeats.

    A group has distinct rows (bytes left, bytes right) around one core, which becomes a symbol.
    """
    strings, lefts = [], []
    for at, group in enumerate(groups):
        for left, right in group:
            strings.append(np.concatenate([np.frombuffer(left, np.uint8), [256 + at], np.frombuffer(right, np.uint8)]))
            lefts.append(len(left))
    owner, depth, _, common = collection(strings)
    most = np.maximum(common, np.append(common[1:], 0))
    lefts = np.array(lefts, np.int64)
    sizes = np.array([len(s) for s in strings], np.int64)
    q = lefts[owner] - (sizes[owner] - depth)
    hit = (most >= WIDTH) & (q >= 0)
    masks = np.zeros(len(strings), np.int64)
    np.bitwise_or.at(masks, owner[hit], np.int64(1) << q[hit])
    out, at = [], 0
    for group in groups:
        out.append(masks[at : at + len(group)].tolist())
        at += len(group)
    return out


def _built(rows: DataFrame) -> DataFrame:
    """one, two, left, right and mask for rows of cores with few rows; a core's rows come together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: list[list[tuple[bytes, bytes]]] = []
        keys: list[tuple[int, int]] = []
        waiting = 0

        def built():
            masks = repeats(groups)
            out = [(*key, *row, m) for key, group, ms in zip(keys, groups, masks, strict=True) for row, m in zip(group, ms, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for one, two, left, right in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if not keys or keys[-1] != (one, two):
                    if waiting >= BATCH_ROWS:
                        yield built()
                        groups, keys, waiting = [], [], 0
                    keys.append((one, two))
                    groups.append([])
                groups[-1].append((left, right))
                waiting += 1
        if keys:
            yield built()

    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
    names = ["one", "two", "left", "right", "mask"]
    ordered = rows.select(*names[:4]).repartition("one", "two").sortWithinPartitions("one", "two")
    return ordered.mapInArrow(run, "one bigint, two bigint, left binary, right binary, mask bigint")


def _counted(rows: DataFrame) -> DataFrame:
    """The same for cores with any number of rows: every string is counted by its own bytes."""
    left, right = F.length("left"), F.length("right")
    q = F.explode(F.sequence(F.greatest(F.lit(0), WIDTH - 1 - right), left)).alias("q")
    strings = rows.filter(left + right >= WIDTH - 1).select("one", "two", "left", "right", q)
    own = F.expr("substring(left, length(left) - q + 1, q)"), F.expr(f"substring(right, 1, {WIDTH - 1} - q)")
    strings = strings.withColumn("string", F.concat(*own))
    counted = strings.groupBy("one", "two", "q", "string").count().filter("count > 1").drop("count")
    hits = strings.join(counted, ["one", "two", "q", "string"])
    return hits.groupBy("one", "two", "left", "right").agg(F.bit_or(F.expr("shiftleft(1L, q)")).alias("mask"))


def spans(docs: DataFrame) -> DataFrame:
    """id, tie, and a list of (at, mask) per text of (id, tie, text): strings that repeat.

    Bit q of a mask stands for the string that starts at ``at - q``.
    """
    found = session.staged(_occurrences(docs), "anchors")
    # Written first: the join is then between two plain shuffles, of which a hot key's part can be split.
    again = session.staged(found.groupBy("kmer").count().filter("count > 1").select("kmer"), "shared-kmers")
    shared = session.staged(found.join(again, "kmer"), "shared-anchors")
    anchor = F.struct("id", "tie", "place", "first", "last")
    wholes = shared.groupBy("kmer", "whole").agg(F.count(F.lit(1)).alias("n"), F.min(anchor).alias("anchor"))
    wholes = session.staged(wholes, "surroundings")
    same = shared.join(wholes.filter("n > 1").select("kmer", "whole"), ["kmer", "whole"])
    # All strings of an anchor, WIDTH at a time.
    blocks = F.explode(F.sequence("last", "first", F.lit(-WIDTH))).alias("at")
    bits = F.expr(f"shiftleft(1L, CAST(least(at - first + 1, {WIDTH}) AS INT)) - 1")
    same = same.select("id", "tie", "first", blocks).select("id", "tie", "at", bits.alias("mask"))
    unlike = wholes.filter("n = 1").select("kmer").distinct()
    wanted = wholes.join(unlike, "kmer", "left_semi").select("anchor.*")
    wanted = wanted.groupBy("id", "tie").agg(F.collect_list(F.struct("place", "first", "last")).alias("found"))
    rows = _packed(docs).join(wanted, ["id", "tie"]).select("id", "tie", "data", "found")
    rows = session.staged(_rows(rows), "cores")
    around = rows.groupBy("one", "two", "left", "right").agg(F.count(F.lit(1)).alias("n"))
    cores = around.groupBy("one", "two").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
    around = session.staged(around.join(cores.filter("all > 1"), ["one", "two"]), "around")
    existing = F.expr(f"shiftleft(1L, length(left) + 1) - shiftleft(1L, greatest(0, {WIDTH - 1} - length(right)))")
    existing = F.greatest(existing, F.lit(0).cast("bigint"))
    alike = around.filter("n > 1").select("one", "two", "left", "right", existing.alias("mask"))
    mixed_rows = around.filter("kinds > 1 AND least = 1")
    built = _built(mixed_rows.filter(F.col("kinds") <= MOST_ROWS))
    counted = _counted(mixed_rows.filter(F.col("kinds") > MOST_ROWS))
    masks = alike.union(built).union(counted).groupBy("one", "two", "left", "right").agg(F.bit_or("mask").alias("mask"))
    differing = rows.join(masks.filter("mask > 0"), ["one", "two", "left", "right"]).select(
        "id", "tie", F.col("base").alias("at"), "mask"
    )
    every = same.union(differing)
    # Rows that repeat id and text have the same spans, which are kept once.
    return every.groupBy("id", "tie").agg(F.collect_set(F.struct("at", "mask")).alias("spans"))


def covered(found: list[dict] | None, size: int) -> np.ndarray:
    """Which bytes of a text the strings in a list of spans cover."""
    change = np.zeros(size + 1, np.int64)
    if found:
        at = np.array([s["at"] for s in found], np.int64)
        mask = np.array([s["mask"] for s in found], np.int64)
        q = np.arange(WIDTH)
        starts = (at[:, None] - q)[(mask[:, None] >> q) & 1 == 1]
        np.add.at(change, starts, 1)
        np.add.at(change, starts + LENGTH, -1)
    return np.cumsum(change[:-1]) > 0


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept and the removed runs (starts, ends) of every row.

    Removed are the UTF-8 bytes covered by a string of LENGTH bytes that also starts at
    another place of any text. Matches do not cross texts and are judged on the input. Null
    texts are empty, shorter ones keep all. Ids need not be unique or present: rows that
    repeat id and text repeat each other. ``kept`` is binary, as a removed run may end inside
    a character.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    # Texts of one id, or of none, are told apart by 128 bits.
    tie = F.unhex(F.md5(text)).alias("tie")
    docs = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("id"), tie, text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, packed, found = (c.to_pylist() for c in batch.columns)
            out = []
            for doc, data, strings in zip(ids, packed, found, strict=True):
                data = np.frombuffer(_unpacked(data), np.uint8)
                gone = covered(strings, len(data))
                edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
                starts, ends = edges[::2].tolist(), edges[1::2].tolist()
                out.append((None if doc == NO_ID else doc, len(data), int(gone.sum()), len(starts), data[~gone].tobytes(), starts, ends))
            if out:
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, starts array<bigint>, ends array<bigint>"
    names = [column.split()[0] for column in schema.split(", ")]
    kinds = [*[pa.int64()] * 4, pa.binary(), *[pa.list_(pa.int64())] * 2]
    joined = _packed(docs).join(spans(docs), ["id", "tie"], "left").select("id", "data", "spans")
    return joined.mapInArrow(run, schema)
