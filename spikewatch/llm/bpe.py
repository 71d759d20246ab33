"""Byte-pair encoding and decoding with a public vocabulary.

A text falls into white-space-free chunks, whose tokens depend on nothing around them.
Each task numbers the distinct chunks it meets and encodes every one once, many together:
the symbols of all their words lie in one flat array, and a round looks all neighbouring
pairs up by binary search in the sorted pair keys and merges, in every word, its pair of
lowest rank. The texts are then put together by array gathers.

Null text counts as empty and has no tokens. Rows are independent, so repeated rows, extra
columns and empty tables need no care; nothing is shuffled, and a lost task is just redone.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spikewatch.llm.batches import binaries, pieces, ragged, text_sizes

# Chunks a task remembers. Beyond it the memory starts afresh; results do not change.
MOST_CHUNKS = 400_000
# Words longer than this many bytes are merged with a heap, as rounds over them are many.
LONG_WORD = 2048
# Below it, the classes and lower case of characters are settled in every Unicode version in
# use, and text is in composed form; chunks with others are split by the tokenizers library.
SETTLED = "\u0250"
CHUNK_END = "\n"
# Fixed value: how the vocabulary splits a chunk into words; here also the ends of chunks.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+|\n")
ORDINARY, UNUSUAL, SPECIAL = 0, 1, 2
# White space for Python only, not for the vocabulary's pattern.
SEPARATORS = "\x1c\x1d\x1e\x1f"
SENTENCE_ENDS = (".", "!", "?")


def byte_letters() -> list[str]:
    """The visible letter that stands for each byte in a byte-level vocabulary."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in visible}
    hidden = (b for b in range(256) if b not in letters)
    letters.update((b, chr(256 + n)) for n, b in enumerate(hidden))
    return [letters[b] for b in range(256)]


def read_vocabulary(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


@lru_cache(maxsize=2)
def token_texts(path: str) -> list[str]:
    """The text of each id, special tokens included; all that decoding needs."""
    spec = read_vocabulary(path)
    texts = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = [""] * (max(texts.values()) + 1)
    for token, number in texts.items():
        tokens[number] = token
    return tokens


class Merges:
    """The vocabulary as arrays: byte symbols, sorted pair keys, their ranks and results."""

    def __init__(self, path: str):
        spec = read_vocabulary(path)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.final = np.array([vocab[c + suffix] for c in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        self.results = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}

    def symbols(self, word: bytes) -> list[int]:
        out = self.inner[np.frombuffer(word, np.uint8)].tolist()
        out[-1] = int(self.final[word[-1]])
        return out

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has."""
        long = [n for n, word in enumerate(words) if len(word) > LONG_WORD]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        lengths[long] = 0
        data = b"".join(w for w in words if len(w) <= LONG_WORD) if long else b"".join(words)
        raw = np.frombuffer(data, np.uint8)
        symbols, owner = self.inner[raw], np.repeat(np.arange(len(words)), lengths)
        last = np.cumsum(lengths)[lengths > 0] - 1
        symbols[last] = self.final[raw[last]]
        done = [self._rounds(symbols, owner)]
        for n in long:
            ids = self._heap(words[n])
            done.append((np.array(ids, np.int64), np.full(len(ids), n)))
        ids, owners = (np.concatenate(part) for part in zip(*done, strict=True))
        order = np.argsort(owners, kind="stable")
        return ids[order], np.bincount(owners, minlength=len(words))

    def _rounds(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        finished: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            keys = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            left = np.flatnonzero((self.keys[at] == keys) & (owner[:-1] == owner[1:]))
            if len(left) == 0:
                finished.append((symbols, owner))
                break
            ranks, of = self.ranks[at[left]], owner[left]
            first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            lowest = np.minimum.reduceat(ranks, first)
            sizes = np.diff(np.r_[first, len(of)])
            left = left[ranks == np.repeat(lowest, sizes)]
            # Of pairs that overlap, as in a run of one symbol, every second merges.
            begins = np.r_[True, left[1:] != left[:-1] + 1]
            run = np.flatnonzero(begins)[np.cumsum(begins) - 1]
            left = left[(np.arange(len(left)) - run) % 2 == 0]
            symbols[left] = self.results[at[left]]
            keep = np.ones(len(symbols), bool)
            keep[left + 1] = False
            # Words without a pair to merge are finished.
            busy = np.zeros(int(owner[-1]) + 1, bool)
            busy[of[first]] = True
            going = busy[owner]
            finished.append((symbols[~going], owner[~going]))
            symbols, owner = symbols[keep & going], owner[keep & going]
        if not finished:
            return symbols, owner
        ids, owners = (np.concatenate(part) for part in zip(*finished, strict=True))
        return ids, owners

    def _heap(self, word: bytes) -> list[int]:
        """The same merges of one long word, the lowest rank and then the leftmost first."""
        symbols = self.symbols(word)
        after = [*range(1, len(symbols)), -1]
        before = [*range(-1, len(symbols) - 1)]

        def look(left: int) -> tuple[int, int, int, int, int] | None:
            right = after[left] if left >= 0 else -1
            if right < 0:
                return None
            key = symbols[left] << 32 | symbols[right]
            at = int(np.searchsorted(self.keys, key))
            if at == len(self.keys) or self.keys[at] != key:
                return None
            return int(self.ranks[at]), left, symbols[left], symbols[right], int(self.results[at])

        heap = [pair for n in range(len(symbols)) if (pair := look(n))]
        heapq.heapify(heap)
        while heap:
            _, left, a, b, result = heapq.heappop(heap)
            right = after[left]
            if right < 0 or symbols[left] != a or symbols[right] != b:
                continue
            symbols[left], symbols[right] = result, -1
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
            after[right] = -1
            for n in (before[left], left):
                if pair := look(n):
                    heapq.heappush(heap, pair)
        return [s for s in symbols if s >= 0]


class _Numbering(dict):
    """Numbers chunks as they are met and lists the new ones."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = len(self)
        self.new.append(chunk)
        return number


def _kind(chunk: str) -> int:
    if chunk[0] == " ":
        return SPECIAL
    return ORDINARY if chunk.isascii() or max(chunk) < SETTLED else UNUSUAL


class Encoder:
    """Encodes many texts at a time, remembering the chunks met before."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        library = Tokenizer.from_file(path)
        self.normalize = library.normalizer.normalize_str
        self.split = library.pre_tokenizer.pre_tokenize_str
        self.letters = {c: b for b, c in enumerate(byte_letters())}
        self.special = re.compile("(" + "|".join(map(re.escape, self.merges.special)) + ")")
        self.marks = tuple({s[:2] for s in self.merges.special})
        self.forget()

    def forget(self) -> None:
        self.chunks = _Numbering()
        self.lengths = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.stops = np.zeros(0, bool)

    def _cut(self, text: str) -> list[str]:
        """Chunks of a text. A special token is marked by a space before it."""
        if any(mark in text for mark in self.marks):
            parts = self.special.split(text)
            return [
                chunk
                for n, part in enumerate(parts)
                for chunk in ([" " + part] if n % 2 else self._plain(part))
            ]
        return self._plain(text)

    @staticmethod
    def _plain(text: str) -> list[str]:
        if any(c in text for c in SEPARATORS):
            return [chunk for chunk in regex.split(r"\s+", text) if chunk]
        return text.split()

    def _learn(self) -> None:
        """Encode the chunks that are new, all their distinct words together."""
        new, self.chunks.new = self.chunks.new, []
        if not new:
            return
        kinds = np.array(list(map(_kind, new)), np.int8)
        numbers = _Numbering()
        numbers[CHUNK_END] = 0
        lines = "".join([c + CHUNK_END for c in compress(new, kinds == ORDINARY)]).lower()
        uses = list(map(numbers.__getitem__, WORDS.findall(lines)))
        for chunk in compress(new, kinds == UNUSUAL):
            words = (word for word, _ in self.split(self.normalize(chunk)))
            uses += [numbers[bytes(map(self.letters.__getitem__, w)).decode()] for w in words]
            uses.append(0)
        ids, sizes = self.merges.words([w.encode() for w in numbers.new])
        sizes = np.r_[0, sizes]
        begins = np.cumsum(sizes) - sizes
        used = np.array(uses, np.int64)
        flat = ids[ragged(begins[used], sizes[used])]
        after = np.cumsum(sizes[used])[used == 0]
        special = [self.merges.special[c[1:]] for c in compress(new, kinds == SPECIAL)]
        after = np.r_[after, len(flat) + 1 + np.arange(len(special))]
        before = np.r_[0, after[:-1]]
        place = np.argsort(np.argsort(kinds, kind="stable"))
        self.starts = np.r_[self.starts, len(self.ids) + before[place]]
        self.lengths = np.r_[self.lengths, (after - before)[place]]
        self.ids = np.r_[self.ids, flat.astype(np.uint32), np.array(special, np.uint32)]
        self.stops = np.r_[self.stops, [chunk.endswith(SENTENCE_ENDS) for chunk in new]]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row, how many each has, and positions after a sentence's end."""
        if len(self.chunks) > MOST_CHUNKS:
            self.forget()
        number = self.chunks.__getitem__
        numbers = [np.array(list(map(number, self._cut(text))), np.int64) for text in texts]
        self._learn()
        counts = np.array([len(n) for n in numbers], np.int64)
        every = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        lengths = self.lengths[every]
        ids = self.ids[ragged(self.starts[every], lengths)]
        after = np.r_[0, np.cumsum(lengths)]
        ends = np.cumsum(counts)
        return ids, after[ends] - after[ends - counts], after[1:][self.stops[every]]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process, so that what it remembers serves many tasks."""
    return Encoder(path)


def packed_ids(own: Encoder, texts: pa.Array) -> pa.Array:
    """Token ids of each text, packed as little-endian unsigned 32-bit integers."""
    parts = []
    for a, b in pieces(text_sizes(texts)):
        flat, lengths, _ = own.encode([t or "" for t in texts[a:b].to_pylist()])
        parts.append(binaries(flat.astype("<u4"), lengths))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())


def joined_tokens(tokens: list[str], ids: pa.Array) -> pa.Array:
    """Text of each row of packed token ids."""
    rows = (np.frombuffer(row or b"", "<u4").tolist() for row in ids.to_pylist())
    return pa.array([" ".join(map(tokens.__getitem__, row)) for row in rows], pa.string())


def encode(text: Column, path: str) -> Column:
    """Token ids of a text column, packed as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("binary")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoder(path)
        for texts in batches:
            yield packed_ids(own, texts)

    return ids(text)


def decode(packed: Column, path: str) -> Column:
    """Text of packed token ids: the vocabulary's tokens, special ones too, joined by spaces."""

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = token_texts(path)
        for ids in batches:
            yield joined_tokens(tokens, ids)

    return text(packed)


def encode_decode(text: Column, path: str) -> Column:
    """What ``encode`` and, of its ids, ``decode`` return, as a struct of ``ids`` and ``decoded``.

    Both steps run in one Python worker. ``decode`` over the column of ``encode`` takes two a
    task, which one JVM thread has to feed and read in turn, and sends the ids there and back.
    """

    @F.arrow_udf("ids binary, decoded string")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own, tokens = encoder(path), token_texts(path)
        for texts in batches:
            ids = packed_ids(own, texts)
            yield pa.StructArray.from_arrays(
                [ids, joined_tokens(tokens, ids)], names=["ids", "decoded"]
            )

    return both(text)


def token_total(packed: Column) -> Column:
    """How many tokens packed ids hold."""
    return (F.octet_length(packed) / 4).cast("long")
