"""Token counts of byte-level BPE: how many tokens a text has, without making any.

A text is cut into the library's words, and a word into its bytes. A heap holds the rank
and the place of every adjacent pair that can merge, a linked list the symbols that are
left. The lowest rank, of equals the leftmost, is merged until no pair is left. The count is
the number of bytes less the number of merges; no identifier is looked up.
"""

from __future__ import annotations

import heapq
import json
import sys
import unicodedata
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from tillroll.llm.pieces import read_model

MODEL = public_tokenizers.path("byte_bpe_50k.json")
LIMIT = 512
#: Words whose counts a Python worker keeps before it starts afresh, and the longest it keeps (in characters).
KEPT_WORDS, KEPT_LENGTH = 1 << 18, 64
#: Characters whose words are found together, up to the next white space that follows something else: a word begins there.
PIECE, BORDER = 1 << 16, regex.compile(r"(?<=\S)\s")
#: How the library cuts a text into words, for given letters, numbers and other characters.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?{other}+|\s+(?!\S)|\s+"


class Ranks:
    """The merges of a byte-level BPE model in a tokenizer file."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        odd = [key for key in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(key)]
        if model["type"] != "BPE" or not plain or odd or spec["normalizer"]:
            raise ValueError("only plain byte-level BPE models are supported")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("only added tokens that stand for themselves are supported")
        #: Strings that are one token wherever they stand, the longest first.
        self.whole = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        symbols = {char: byte for byte, char in enumerate(byte_characters())}
        #: Pairs of symbols, as one number, and the rank and the symbol of their merge.
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            new = symbols.setdefault(left + right, len(symbols))
            self.merges.setdefault(symbols[left] << 32 | symbols[right], (rank, new))

    def count(self, word: bytes) -> int:
        """Tokens of one word: a merge of two symbols leaves one fewer."""
        n = len(word)
        symbols, before, after = list(word), list(range(-1, n - 1)), list(range(1, n + 1))
        merges = self.merges
        heap = []
        for i in range(n - 1):
            found = merges.get(symbols[i] << 32 | symbols[i + 1])
            if found:
                heap.append((found[0], i, found[1]))
        heapq.heapify(heap)
        left = n
        while heap:
            _, i, new = heapq.heappop(heap)
            j = after[i]
            # Not valid any more if either symbol has been merged since.
            if symbols[i] < 0 or j == n or merges.get(symbols[i] << 32 | symbols[j], (0, -1))[1] != new:
                continue
            symbols[i], symbols[j] = new, -1
            k = after[i] = after[j]
            left -= 1
            if k < n:
                before[k] = i
                found = merges.get(new << 32 | symbols[k])
                if found:
                    heapq.heappush(heap, (found[0], i, found[1]))
            h = before[i]
            if h >= 0:
                found = merges.get(symbols[h] << 32 | new)
                if found:
                    heapq.heappush(heap, (found[0], h, found[1]))
        return left


def byte_characters() -> list[str]:
    """The character by which the tokenizer file writes each byte: itself where it can be seen, else one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return [chr(byte if byte in shown else 256 + hidden.index(byte)) for byte in range(256)]


def later_characters() -> tuple[str, str]:
    """Characters that the pattern library takes for letters, or for numbers, and the library to be matched does not.

    Each knows its own version of Unicode, so the few characters in question are asked of it.
    Both are insides of a character class.
    """
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    later = []
    for kind, like in (("L", "a"), ("N", "1")):
        unsure = [c for c in regex.findall(rf"\p{{{kind}}}", every) if unicodedata.category(c) == "Cn"]
        later.append(_ranges([ord(c) for c in unsure if len(cut.pre_tokenize_str(like + c)) > 1]))
    return later[0], later[1]


def _ranges(codes: list[int]) -> str:
    """Code points as the inside of a character class."""
    runs: list[list[int]] = []
    for code in codes:
        if runs and runs[-1][1] == code - 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


class Counter(dict):
    """Tokens by word; words it does not have are counted, and short ones kept."""

    def __init__(self, data: bytes, later: tuple[str, str]):
        self.ranks = Ranks(data)
        self.words = regex.compile(WORDS.format(letter=r"\p{L}", number=r"\p{N}", other=r"[^\s\p{L}\p{N}]"))
        extra = "".join(later)
        self.unsure = regex.compile(f"[{extra}]") if extra else None
        letter, number = (rf"(?:{kind}(?<![{out}]))" if out else kind for kind, out in zip((r"\p{L}", r"\p{N}"), later, strict=True))
        other = rf"(?:[^\s\p{{L}}\p{{N}}]|[{extra}])" if extra else r"[^\s\p{L}\p{N}]"
        #: The same with the classes of the other library: slower, and needed only where they differ.
        self.sure_words = regex.compile(WORDS.format(letter=letter, number=number, other=other))
        whole = self.ranks.whole
        self.parts = regex.compile("|".join(map(regex.escape, whole))) if whole else None

    def __missing__(self, word: str) -> int:
        found = self.ranks.count(word.encode("utf-8", "replace"))
        if len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = found
        return found

    def tokens(self, text: str) -> int:
        """Tokens of a text, whose words are found piece by piece."""
        parts = self.parts.split(text) if self.parts and self.parts.search(text) else [text]
        differs = self.unsure and not text.isascii() and self.unsure.search(text)
        words = self.sure_words if differs else self.words
        count = len(parts) - 1  # each string between two parts is one token
        for part in parts:
            at = 0
            while at < len(part):
                found = BORDER.search(part, at + PIECE)
                end = found.start() if found else len(part)
                count += sum(map(self.__getitem__, words.findall(part, at, end)))
                at = end
        return count


_counters: dict[tuple, Counter] = {}


def _counter(data: bytes, later: tuple[str, str]) -> Counter:
    """The parsed model and the words seen, once per Python worker."""
    if (data, later) not in _counters:
        _counters.clear()
        _counters[data, later] = Counter(data, later)
    return _counters[data, later]


def counts(docs: DataFrame, data: bytes, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every row of ``docs``.

    Counts are those of the library for whole texts, without tokens at the start or end. Added
    tokens of the model that a text spells out are one token each, as is the library's default.
    Null texts are empty, which have no bytes and no tokens. Rows are independent, so ids may
    repeat or be null; other columns are not read.
    """
    later = later_characters()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(data, later)
        for batch in batches:
            texts = batch.column("text")
            # Texts become strings one by one, so only one long text is held twice.
            tokens = pa.array([counter.tokens(text.as_py() or "") for text in texts], pa.int64())
            size = pc.binary_length(texts).fill_null(0).cast(pa.int64())
            columns = [batch.column("doc_id"), size, tokens, pc.greater(tokens, limit)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")


def read_ranks(spark: SparkSession, path: str = MODEL) -> bytes:
    """The tokenizer file, of a few megabytes: a path of the driver, or a URL that Spark can read."""
    return read_model(spark, path)
