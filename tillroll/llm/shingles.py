"""Sets of word shingles as 64-bit hashes, and their minima, computed batch by batch in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from xxhash import xxh3_64_intdigest

SIZE = 5
#: Words hashed together; one longer text is a batch of its own.
BATCH_WORDS = 1 << 18
ODD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def split(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased: runs of bytes other than space and \\x09 to \\x0D."""
    return (text or "").encode("utf-8", "replace").lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def sets(hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of several word sequences, sorted within each, and how many each has.

    ``hashes`` has the words of all sequences, which begin at ``starts`` and have ``counts``
    words. A sequence of fewer than SIZE words is one shingle, one without words has none.
    """
    n = len(hashes)
    full = np.zeros(n, np.uint64)
    for place in range(SIZE):
        full[: max(0, n - place)] = full[: max(0, n - place)] * ODD + hashes[place:]
    # Past the end of a sequence these mix in words of the next one; only whole shingles are used.
    full = mixed(full)
    tiny = counts < SIZE
    if not tiny.any():
        return _full_sets(full, starts, counts - SIZE + 1)
    sizes = (counts > 0).astype(np.int64)
    grams, sizes[~tiny] = _full_sets(full, starts[~tiny], counts[~tiny] - SIZE + 1)
    out = np.zeros(sizes.sum(), np.uint64)
    is_tiny = np.repeat(tiny, sizes)
    out[~is_tiny] = grams
    own = np.flatnonzero(tiny & (counts > 0))
    values = counts[own].astype(np.uint64)
    for place in range(SIZE - 1):
        more = counts[own] > place
        values[more] = values[more] * ODD + hashes[starts[own[more]] + place]
    out[is_tiny] = mixed(values)
    return out, sizes


def _full_sets(full: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for sequences that have ``counts`` shingles in ``full``; those with as many are sorted together."""
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(starts)), counts)
    grams = full[np.arange(len(owner)) + np.repeat(starts - (ends - counts), counts)]
    order = np.argsort(counts, kind="stable")
    borders = np.flatnonzero(np.diff(counts[order])) + 1
    for alike in np.split(order, borders):
        many = counts[alike[0]]
        if many > 1:
            places = (ends[alike] - many)[:, None] + np.arange(many)
            grams[places] = np.sort(grams[places], axis=1)
    new = np.concatenate(([True], (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])))
    return grams[new], np.bincount(owner[new], minlength=len(starts))


def batches(texts: list[str | None]):
    """Word sequences of consecutive texts: first text, hashes, starts, counts."""
    words, counts, first = [], [], 0
    for i, text in enumerate(texts):
        found = split(text)
        if counts and len(words) + len(found) > BATCH_WORDS:
            yield first, *_arrays(words, counts)
            words, counts, first = [], [], i
        words.extend(found)
        counts.append(len(found))
    if counts:
        yield first, *_arrays(words, counts)


def _arrays(words: list[bytes], counts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    counts = np.array(counts, np.int64)
    return word_hashes(words), np.cumsum(counts) - counts, counts


def identity(grams: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit values per set that only equal sets share."""
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(grams * c + c), dtype=np.uint64))) for c in (_M1, _M2)]
    return tuple((s[bounds[1:]] - s[bounds[:-1]]).view(np.int64) for s in sums)


def minima(grams: np.ndarray, sizes: np.ndarray, many: int, seed: int) -> np.ndarray:
    """``many`` 32-bit minima per non-empty set, a row each; rows of empty sets are 0."""
    rng = np.random.default_rng(seed)
    odd = rng.integers(0, 2**31, many, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shift = rng.integers(0, 2**32, many, dtype=np.uint32)
    out = np.zeros((len(sizes), many), np.uint32)
    full = np.flatnonzero(sizes)
    if len(full):
        starts = (np.cumsum(sizes) - sizes)[full]
        x = (grams >> np.uint64(32)).astype(np.uint32)
        for k in range(many):
            out[full, k] = np.minimum.reduceat(x * odd[k] + shift[k], starts)
    return out


def odd_sketches(grams: np.ndarray, sizes: np.ndarray, bits: int) -> np.ndarray:
    """A row of 64-bit words per set: bit k tells whether an odd number of its shingles falls on k.

    Two sets differ in at least as many shingles as their rows differ in bits.
    """
    out = np.zeros((len(sizes), bits // 64), np.uint64)
    ends = np.cumsum(sizes)
    for first in range(0, len(sizes), 1024):
        part = sizes[first : first + 1024]
        own = grams[ends[first] - sizes[first] : ends[first + len(part) - 1]]
        places = np.repeat(np.arange(len(part)), part) * bits + (own % np.uint64(bits)).astype(np.int64)
        odd = (np.bincount(places, minlength=len(part) * bits) & 1).astype(np.uint8).reshape(len(part), bits)
        out[first : first + len(part)] = np.packbits(odd, axis=1, bitorder="little").view(np.uint64)
    return out


def band_keys(rows: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit key per band of ``width`` minima."""
    count, many = rows.shape
    keys = np.zeros((count, many // width), np.uint64) + np.arange(many // width, dtype=np.uint64)
    bands = rows.reshape(count, many // width, width).astype(np.uint64)
    for place in range(width):
        keys = mixed(keys * ODD + bands[:, :, place] + np.uint64(1))
    return keys.view(np.int64)


def lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """An Arrow array of lists of 64-bit integers."""
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))
