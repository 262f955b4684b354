"""SentencePiece encoding and decoding with a batched Viterbi search in numpy.

Distinct words of one length advance together through the columns of the lattice. At each
column the hashes of the substrings that end there probe the sorted hashes of the pieces,
and a vectorised maximum stores each word's best piece as its backpointer.

Unigram models score a path by the sum of its pieces. BPE models have no path score: a
path is the model's own segmentation exactly if each piece, and each pair of neighbours,
is what merging gives for that string alone. So each column has one admissible piece, its
gain is 0 and that of any other minus infinity. Results equal those of the sentencepiece library.
"""

from __future__ import annotations

import collections
import itertools
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Words with the dummy space before them: no piece crosses their borders.
WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Slots of the table of neighbours already tried, in each Python worker.
PAIR_SLOTS = 1 << 21
#: Characters encoded together; words with more symbols than LONG are walked one by one.
BATCH_CHARS, LONG = 1 << 20, 64
#: Bytes of texts whose new words are learned together, and characters of words that advance together.
LEARN_BYTES, LATTICE_CHARS = 1 << 22, 1 << 17
#: Words whose ids a Python worker keeps before it starts afresh.
KEPT_WORDS = 1 << 17


class Model:
    """A unigram or BPE model with the identity normaliser, without user-defined pieces."""

    def __init__(self, data: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        parsed = proto.ModelProto()
        parsed.ParseFromString(data)
        kinds = proto.ModelProto.SentencePiece
        spec = parsed.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models with the identity normaliser are supported")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in parsed.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.bpe = parsed.trainer_spec.model_type == proto.TrainerSpec.BPE
        if not self.bpe and parsed.trainer_spec.model_type != proto.TrainerSpec.UNIGRAM:
            raise ValueError("only BPE and unigram models are supported")
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        self.pieces = [p.piece for p in parsed.pieces]
        self.ids = {p.piece: i for i, p in enumerate(parsed.pieces) if p.type == kinds.NORMAL}
        self.scores = np.array([p.score for p in parsed.pieces], np.float32)
        self.unk = next(i for i, p in enumerate(parsed.pieces) if p.type == kinds.UNKNOWN)
        self.controls = {i for i, p in enumerate(parsed.pieces) if p.type == kinds.CONTROL}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(parsed.pieces) if p.type == kinds.BYTE}
        self.byte_ids = np.array([self.bytes.get(b, self.unk) for b in range(256)], np.int32)
        if any(SPACE in piece.lstrip(SPACE) for piece in self.ids):
            raise ValueError("pieces that span words are not supported")
        if any(char not in self.ids for char in set("".join(self.ids))):
            raise ValueError("every character of a piece must be a piece")
        self.longest = max(map(len, self.ids))
        self.unk_score = float(min(self.scores[list(self.ids.values())])) - 10
        powers = [np.uint64(1)]
        with np.errstate(over="ignore"):
            for _ in range(self.longest):
                powers.append(powers[-1] * BASE)
            hashes = np.array([_string_hash(piece) for piece in self.ids], np.uint64)
        self.powers = np.array(powers, np.uint64)
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two pieces share a hash")
        self.keys = self._ends()
        self.pair_keys = np.full(PAIR_SLOTS, -1, np.int64)
        self.pair_fits = np.zeros(PAIR_SLOTS, bool)
        surface = [self._surface(i) for i in range(len(self.pieces))]
        self.surface_bytes = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_lengths = np.array([len(s) for s in surface], np.int64)
        self.surface_starts = np.cumsum(self.surface_lengths) - self.surface_lengths

    def _ends(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """By length: sorted hashes of all ends of pieces, and the piece that is just that end, or -1."""
        hashes = [[np.zeros(0, np.uint64)] for _ in range(self.longest + 1)]
        ids = [[np.zeros(0, np.int32)] for _ in range(self.longest + 1)]
        for length in range(1, self.longest + 1):
            group = [(piece, i) for piece, i in self.ids.items() if len(piece) == length]
            codes = np.frombuffer("".join(piece for piece, _ in group).encode("utf-32-le"), np.uint32).reshape(-1, length)
            prefix = _prefix_hashes(codes)
            for size in range(1, length + 1):
                hashes[size].append(prefix[length] - prefix[length - size] * self.powers[size])
                own = [i for _, i in group] if size == length else [-1] * len(group)
                ids[size].append(np.array(own, np.int32))
        out = []
        for h, i in zip(map(np.concatenate, hashes), map(np.concatenate, ids), strict=True):
            order = np.lexsort((i, h))
            last = np.append(h[order][1:] != h[order][:-1], True)[: len(h)]
            out.append((h[order][last], i[order][last]))
        return out

    def _surface(self, i: int) -> bytes:
        if i == self.unk:
            return " ⁇ ".encode()
        if i in self.controls:
            return b""
        if self.bytes and self.pieces[i] not in self.ids:
            return bytes([int(self.pieces[i][3:5], 16)])
        return self.pieces[i].replace(SPACE, " ").encode()

    def merged(self, symbols: list[str]) -> list[str]:
        """Plain BPE over a short string: the best pair first, the leftmost of equals."""
        while len(symbols) > 1:
            best, at = -np.inf, -1
            for i in range(len(symbols) - 1):
                piece = self.ids.get(symbols[i] + symbols[i + 1])
                if piece is not None and self.scores[piece] > best:
                    best, at = self.scores[piece], i
            if at < 0:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def fits(self, left: int, right: int) -> bool:
        """Whether merging keeps ``right`` whole after ``left``; ``left`` is -1 at a start."""
        pair = [self.pieces[left], self.pieces[right]] if left >= 0 else [self.pieces[right]]
        return self.merged(list("".join(pair))) == pair

    def all_fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``fits`` for many pairs; answers are kept in a table of fixed size."""
        keys = (left.astype(np.int64) + 1) * len(self.pieces) + right
        slots = (keys.astype(np.uint64) * BASE >> np.uint64(20)).astype(np.int64) % PAIR_SLOTS
        out = self.pair_fits[slots]
        unseen = np.flatnonzero(self.pair_keys[slots] != keys)
        if len(unseen):
            kinds, first, of = np.unique(keys[unseen], return_index=True, return_inverse=True)
            first = unseen[first]
            answers = np.array([self.fits(int(left[i]), int(right[i])) for i in first], bool)
            out[unseen] = answers[of]
            # Several pairs may want one slot: write key and answer of the same one.
            _, one = np.unique(slots[first], return_index=True)
            self.pair_keys[slots[first[one]]] = kinds[one]
            self.pair_fits[slots[first[one]]] = answers[one]
        return out

    def probe(self, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are those of ends of pieces, and for these the ids of the pieces, -1 for proper ends."""
        keys, ids = self.keys[length]
        if not len(keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        at = np.searchsorted(keys, hashes)
        at[at == len(keys)] = 0
        known = np.flatnonzero(keys[at] == hashes)
        return known, ids[at[known]]


def _string_hash(text: str) -> np.uint64:
    value = np.uint64(0)
    for char in text:
        value = value * BASE + np.uint64(ord(char) + 1)
    return value


def _prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """Hashes of the first 0, 1, ... code points of each row."""
    prefix = np.zeros((codes.shape[1] + 1, len(codes)), np.uint64)
    for j in range(codes.shape[1]):
        prefix[j + 1] = prefix[j] * BASE + (codes[:, j].astype(np.uint64) + np.uint64(1))
    return prefix


def _lattice(model: Model, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best paths of words of one length, a row of code points each.

    Returns the steps of all paths in order (a piece id, or -1 minus the code point of
    an unknown character) and how many steps each word has.
    """
    words, length = codes.shape
    prefix = _prefix_hashes(codes)
    best = np.full((length + 1, words), -np.inf, np.float32)
    best[0] = 0
    step = np.zeros((length + 1, words), np.int64)  # what ends here
    back = np.zeros((length + 1, words), np.int32)
    last = np.full((length + 1, words), -1, np.int32)  # the piece ending here, -1 at starts and after unknowns
    for j in range(1, length + 1):
        # From the shortest on: where no piece ends alike, longer ones do not either.
        alive, found = np.arange(words), []
        unknown = np.ones(words, bool)
        for size in range(1, min(model.longest, j) + 1):
            known, piece = model.probe(prefix[j][alive] - prefix[j - size][alive] * model.powers[size], size)
            alive = alive[known]
            if not len(alive):
                break
            whole = piece >= 0
            found.append((size, alive[whole], piece[whole]))
            if size == 1:
                unknown[alive[whole]] = False
        for size, rows, ids in reversed(found):
            i = j - size
            piece = np.zeros(words, np.int32)
            piece[rows] = ids
            if model.bpe:
                rows = rows[best[j][rows] == -np.inf]
                rows = rows[model.all_fit(last[i][rows], piece[rows])]
                value = np.zeros(len(rows), np.float32)
            else:
                value = best[i][rows] + model.scores[piece[rows]]
            better = value > best[j][rows]
            rows, value = rows[better], value[better]
            best[j, rows], back[j, rows], last[j, rows], step[j, rows] = value, i, piece[rows], piece[rows]
        rows = np.flatnonzero(unknown)
        if len(rows):
            i = j - 1
            value = np.zeros(len(rows), np.float32) if model.bpe else best[i][rows] + np.float32(model.unk_score)
            better = value > best[j][rows]
            rows, value = rows[better], value[better]
            best[j, rows], back[j, rows], last[j, rows], step[j, rows] = value, i, -1, -1 - codes[rows, j - 1].astype(np.int64)
    # Follow the backpointers of all words at once, from the right.
    path = np.zeros((words, length), np.int64)
    counts = np.zeros(words, np.int64)
    at, row = np.full(words, length), np.arange(words)
    while len(row):
        path[row, length - 1 - counts[row]] = step[at[row], row]
        counts[row] += 1
        at[row] = back[at[row], row]
        row = row[at[row] > 0]
    used = np.arange(length) >= (length - counts)[:, None]
    return path[used], counts


def _walk(model: Model, word: str) -> list[int]:
    """The same search for one word, column by column; for very long words."""
    best, back, last, step = [0.0], [0], [-1], [0]
    tried: dict[tuple[int, int], bool] = {}
    for j in range(1, len(word) + 1):
        top = (-np.inf, 0, -1, 0)
        for i in range(max(0, j - model.longest), j):
            piece = model.ids.get(word[i:j])
            if piece is None and i < j - 1:
                continue
            if piece is None:
                value = 0.0 if model.bpe else best[i] + model.unk_score
                if value > top[0]:
                    top = (value, i, -1, -1 - ord(word[i]))
                continue
            if model.bpe:
                if (last[i], piece) not in tried:
                    tried[last[i], piece] = model.fits(last[i], piece)
                value = 0.0 if tried[last[i], piece] else -np.inf
            else:
                value = float(np.float32(best[i]) + model.scores[piece])
            if value > top[0]:
                top = (value, i, piece, piece)
        for column, item in zip((best, back, last, step), top, strict=True):
            column.append(item)
    out, at = [], len(word)
    while at:
        out.append(step[at])
        at = back[at]
    return out[::-1]


def _expanded(model: Model, steps: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the steps, unknown characters as their bytes, and how many ids each word has."""
    unknown = steps < 0
    if not unknown.any():
        return steps.astype(np.int32), counts
    owner = np.repeat(np.arange(len(counts)), counts)
    if not model.bytes:
        ids = np.where(unknown, model.unk, steps).astype(np.int32)
        repeated = np.zeros(len(ids), bool)  # unknown characters in a row are one unknown piece
        repeated[1:] = unknown[1:] & unknown[:-1] & (owner[1:] == owner[:-1])
        return ids[~repeated], np.bincount(owner[~repeated], minlength=len(counts))
    code = np.where(unknown, -1 - steps, 0)
    width = np.where(unknown, 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF), 1)
    place = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
    wide, code, steps = np.repeat(width, width), np.repeat(code, width), np.repeat(steps, width)
    lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[wide]
    bits = code >> (6 * (wide - 1 - place)) & np.where((place > 0) | (wide == 1), np.where(wide == 1, 0x7F, 0x3F), 0xFF)
    byte = np.where(place > 0, 0x80 | bits, np.where(wide > 1, lead | bits, bits))
    ids = np.where(steps < 0, model.byte_ids[byte], steps).astype(np.int32)
    return ids, np.bincount(np.repeat(owner, width), minlength=len(counts))


def _gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``values[start : start + length]`` one after the other."""
    ends = np.cumsum(lengths)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)]


class Encoder:
    """Encodes batches of texts; keeps the ids of words it has seen, up to ``KEPT_WORDS`` of them."""

    def __init__(self, model: Model):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = defaultdict(itertools.count().__next__)
        self.flat = np.zeros(0, np.int32)
        self.starts, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _split(self, text: str | None) -> list[str]:
        """Words of a text, their first space left out; other words keep all their spaces behind one."""
        if not text:
            return []
        if self.model.prefix and text[0] != " " and "  " not in text and SPACE not in text and "\0" not in text:
            return text.split(" ")
        found = WORD.findall(self.model.prefix + text.replace(" ", SPACE))
        # Behind U+0000 a word is kept as it is, also one that begins with U+0000 after its space.
        return [word[1:] if word[0] == SPACE and word[1:2] != "\0" else "\0" + word for word in found]

    def prepare(self, slices: Iterable[list[str | None]]) -> None:
        """Learn the new words of several lists of texts together, so that many have the same length."""
        if len(self.index) > KEPT_WORDS:
            self._clear()
        for texts in slices:
            for text in texts:
                collections.deque(map(self.index.__getitem__, self._split(text)), 0)
        self._learn(list(itertools.islice(self.index, len(self.counts), None)))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and how many each text has."""
        words = [self._split(text) for text in texts]
        per_text = [len(found) for found in words]
        uses = np.fromiter(map(self.index.__getitem__, itertools.chain.from_iterable(words)), np.int64, sum(per_text))
        self._learn(list(itertools.islice(self.index, len(self.counts), None)))
        counts = self.counts[uses]
        ids = _gather(self.flat, self.starts[uses], counts)
        owner = np.repeat(np.arange(len(texts)), per_text)
        sums = np.bincount(owner, weights=counts, minlength=len(texts)).astype(np.int64)
        if not self.model.bytes and len(ids):  # unknown pieces also join across the words of a text
            text_of = np.repeat(np.arange(len(texts)), sums)
            again = np.zeros(len(ids), bool)
            again[1:] = (ids[1:] == self.model.unk) & (ids[:-1] == self.model.unk) & (text_of[1:] == text_of[:-1])
            ids, sums = ids[~again], np.bincount(text_of[~again], minlength=len(texts))
        return ids, sums

    def _learn(self, words: list[str]) -> None:
        """Add the ids of new words, those of one length together, up to LATTICE_CHARS characters of them."""
        whole = (len(word) - 1 if word[:1] == "\0" else len(word) + 1 for word in words)
        lengths = np.fromiter(whole, np.int64, len(words))
        counts = np.zeros(len(words), np.int64)
        order = np.argsort(lengths, kind="stable")
        sorted_lengths = lengths[order]
        parts = []
        for length in np.unique(lengths):
            first, end = np.searchsorted(sorted_lengths, length), np.searchsorted(sorted_lengths, length, "right")
            step = max(1, LATTICE_CHARS // max(1, int(length)))
            for at in range(first, end, step):
                group = order[at : min(at + step, end)]
                own = [words[g] for g in group]
                own = [word[1:] if word[:1] == "\0" else SPACE + word for word in own]
                if length > LONG:
                    walked = [_walk(self.model, word) for word in own]
                    steps, steps_each = np.array([s for w in walked for s in w], np.int64), np.array([len(w) for w in walked])
                else:
                    codes = np.frombuffer("".join(own).encode("utf-32-le", "surrogatepass"), np.uint32)
                    steps, steps_each = _lattice(self.model, codes.reshape(len(own), length))
                ids, counts[group] = _expanded(self.model, steps, steps_each)
                parts.append(ids)
        starts = np.zeros(len(words), np.int64)
        starts[order] = len(self.flat) + np.cumsum(counts[order]) - counts[order]
        self.flat = np.concatenate([self.flat, *parts])
        self.starts, self.counts = np.concatenate([self.starts, starts]), np.concatenate([self.counts, counts])


def decode_batch(model: Model, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """The texts of consecutive runs of ids; bytes that are no UTF-8 become U+FFFD."""
    data = _gather(model.surface_bytes, model.surface_starts[ids], model.surface_lengths[ids]).tobytes()
    owner = np.repeat(np.arange(len(counts)), counts)
    sizes = np.bincount(owner, weights=model.surface_lengths[ids], minlength=len(counts)).astype(np.int64)
    out, at = [], 0
    for size in sizes:
        text = data[at : at + size].decode("utf-8", "replace")
        out.append(text[1:] if model.prefix and text.startswith(" ") else text)
        at += size
    return out


_encoders: dict[bytes, Encoder] = {}


def _encoder(data: bytes) -> Encoder:
    """The parsed model and the words seen, once per Python worker."""
    if data not in _encoders:
        _encoders.clear()
        _encoders[data] = Encoder(Model(data))
    return _encoders[data]


def read_model(spark: SparkSession, path: str = MODEL) -> bytes:
    """The model file, which is well below a megabyte: a path of the driver, or a URL that Spark can read."""
    if "://" not in path:
        with open(path, "rb") as file:
            return file.read()
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()["content"])


def _sizes(batch: pa.RecordBatch) -> np.ndarray:
    """Bytes of each text of a batch, which is turned into Python strings slice by slice."""
    return pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False)


def _slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` in all, one row at least."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def encode(docs: DataFrame, data: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array<int>) of every row; null and empty texts have no ids. Rows are independent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(data)
        for batch in batches:
            for first, end, texts in _prepared(encoder, batch):
                ids, counts = encoder.encode(texts)
                ids_of = batch.column("doc_id").slice(first, end - first)
                yield pa.RecordBatch.from_arrays([ids_of, _lists(ids, counts)], ["doc_id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(tokens: DataFrame, data: bytes) -> DataFrame:
    """doc_id, ids and the decoded text of every row; null ids decode to an empty text.

    A text comes back as it was, but for U+2581, which the model cannot tell from a space.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _encoder(data).model
        for batch in batches:
            lists = batch.column("ids")
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(counts)
            for first, end in _slices(counts, BATCH_CHARS):
                run_ids = ids[ends[first] - counts[first] : ends[end - 1]]
                texts = pa.array(decode_batch(model, run_ids, counts[first:end]), pa.string())
                part = [batch.column(c).slice(first, end - first) for c in ("doc_id", "ids")]
                yield pa.RecordBatch.from_arrays([*part, texts], ["doc_id", "ids", "text"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")


def _prepared(encoder: Encoder, batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[str | None]]]:
    """Ranges of rows of a batch and their texts, slice by slice; new words are learned LEARN_BYTES ahead, not for the whole batch."""
    sizes, texts = _sizes(batch), batch.column("text")
    for start, stop in _slices(sizes, LEARN_BYTES):
        parts = [(start + first, start + end) for first, end in _slices(sizes[start:stop], BATCH_CHARS)]
        encoder.prepare(texts.slice(first, end - first).to_pylist() for first, end in parts)
        for first, end in parts:
            yield first, end, texts.slice(first, end - first).to_pylist()


def round_trip(
    docs: DataFrame, data: bytes, id_col: str = "doc_id", text_col: str = "text", carried: Sequence[str] = ()
) -> DataFrame:
    """doc_id, n_tokens, ids, and round_trip: whether the decoded ids are the text (null: empty) again.

    Columns of ``docs`` that are to be ``carried`` follow.

    Encodes and decodes in one pass over the texts, so that they are not moved between the two.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(data)
        for batch in batches:
            for first, end, texts in _prepared(encoder, batch):
                ids, counts = encoder.encode(texts)
                decoded = decode_batch(encoder.model, ids, counts)
                same = [a == (b or "") for a, b in zip(decoded, texts, strict=True)]
                doc, *more = (batch.column(c).slice(first, end - first) for c in ("doc_id", *carried))
                columns = [doc, pa.array(counts), _lists(ids, counts), pa.array(same), *more]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "round_trip", *carried])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *carried)
    more = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carried)
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids array<int>, round_trip boolean{more}")


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
