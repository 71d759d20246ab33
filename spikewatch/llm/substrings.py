"""Removing passages that occur more than once, by fixed-block anchors.

A window of ``WINDOW`` words is repeated if the same words also start anywhere else, in
another text or the same one. Every word covered by a repeated window is removed; windows are
judged on the input. The work is spread by hash, never by document pair:

1. Texts are cut into non-overlapping reference blocks of ``BLOCK`` words, which are indexed,
   and every rolling window of that many words probes the index. Since ``WINDOW`` is at least
   ``2 * BLOCK - 1``, a window holds exactly one start of a block of its own text within
   reach, and if the window is repeated then the other place probes that block. So a window
   whose block was met only once is unique.
2. Hits are extended: the windows around each block that was met again are compared in full,
   to the left and right as far as a block allows. Those met twice or more are repeated, and
   together they are the maximal exact repeats.

Texts are written once, in chunks of bounded size, to a table bucketed by chunk in the shared
folder; each step sends hashes to the tasks that own their range and gets back one bit per
hash, so texts never move again. Tasks receive packed, sorted, distinct hashes of a chunk: a
passage that fills a third of all rows is one entry per chunk. The probes compare 48 bits,
the windows 96.

Null text has no words. Repeated rows are copies like any others. An empty table gives an
empty result. Texts of any length are read whole; one text is at most one chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spikewatch.llm.batches import offsets_of, pack_rising, ragged, unpack_rising
from spikewatch.llm.tables import chunked, keep
from spikewatch.llm.words import WordHashes, window_hashes, word_hashes

WINDOW = 35
BLOCK = 18
CHUNK_BYTES = 4 << 20
PROBE_BITS = 48
# Words that one task of a hash range should compare.
WORDS_PER_RANGE = 3_000_000

RESULTS = ("n_words", "n_removed", "kept")

SENT = "range int, chunk long, count long, keys binary, more binary, flags binary"
REPLY = "chunk long, step int, range int, count long, bits binary"


def pack_bits(bits: np.ndarray) -> bytes:
    return np.packbits(bits.astype(bool)).tobytes()


def unpack_bits(data: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=count).astype(bool)


def range_of(keys: np.ndarray, bits: int, ranges: int) -> np.ndarray:
    """Which of equal ranges of the key space each key lies in."""
    return ((keys >> np.uint64(bits - 32)) * np.uint64(ranges)) >> np.uint64(32)


class Chunk:
    """The words of some texts in a row."""

    def __init__(self, texts: list[bytes | None], hashes: WordHashes):
        self.words = [(t or b"").split() for t in texts]
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.offsets = offsets_of(self.lengths)
        self.hashes = hashes.of([word for words in self.words for word in words])

    def starts(self, size: int) -> np.ndarray:
        """Positions where a window of ``size`` words lies within one text."""
        return ragged(self.offsets[:-1], np.maximum(self.lengths - size + 1, 0))

    def within(self, positions: np.ndarray) -> np.ndarray:
        """Positions counted from the start of their text."""
        text = np.searchsorted(self.offsets, positions, "right") - 1
        return positions - self.offsets[text]


def probes(chunk: Chunk, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct probe keys, rising; whether one is a block's; whether it occurs again."""
    starts = chunk.starts(block)
    keys = window_hashes(chunk.hashes, block)[starts] >> np.uint64(64 - PROBE_BITS)
    marked = np.sort(keys << np.uint64(1) | (chunk.within(starts) % block == 0))
    keys = marked >> np.uint64(1)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else starts
    sizes = np.diff(np.r_[first, len(keys)])
    last = first + sizes - 1
    return keys[first], (marked[last] & np.uint64(1)).astype(bool), sizes > 1


class Candidates:
    """Windows around the blocks that were met again."""

    def __init__(self, chunk: Chunk, met: np.ndarray, block: int, window: int):
        """``met``: for each distinct block key, rising, whether it was met again."""
        starts = chunk.starts(block)
        blocks = starts[chunk.within(starts) % block == 0]
        keys = window_hashes(chunk.hashes, block)[blocks] >> np.uint64(64 - PROBE_BITS)
        again = blocks[met[np.searchsorted(np.unique(keys), keys)]] if len(keys) else blocks
        text = np.searchsorted(chunk.offsets, again, "right") - 1
        low = np.maximum(again - block + 1, chunk.offsets[text])
        high = np.minimum(again, chunk.offsets[text + 1] - window)
        self.starts = ragged(low, np.maximum(high - low + 1, 0))
        key = window_hashes(chunk.hashes, window)[self.starts]
        check = window_hashes(chunk.hashes, window, 1)[self.starts] >> np.uint64(32)
        order = np.lexsort((check, key))
        key, check = key[order], check[order]
        new = np.r_[True, (key[1:] != key[:-1]) | (check[1:] != check[:-1])][: len(key)]
        first = np.flatnonzero(new)
        # Where each window's hash is among the distinct ones.
        self.place = np.empty(len(key), np.int64)
        self.place[order] = np.cumsum(new) - 1
        self.keys, self.checks = key[first], check[first].astype(np.uint32)
        self.again = np.diff(np.r_[first, len(key)]) > 1

    def covered(self, repeated: np.ndarray, n_words: int, window: int) -> np.ndarray:
        """Words in windows whose hash is repeated."""
        starts = self.starts[repeated[self.place]] if len(self.starts) else self.starts
        edges = np.bincount(starts, minlength=n_words + 1)[: n_words + 1]
        edges = edges - np.bincount(starts + window, minlength=n_words + 1)[: n_words + 1]
        return np.cumsum(edges)[:n_words] > 0


def _sent(
    number: int, keys: np.ndarray, bits: int, ranges: int, more: np.ndarray, flags: np.ndarray
) -> Iterator[dict]:
    """Rows that carry the keys to their ranges, with what belongs to each key."""
    at = range_of(keys, bits, ranges).astype(np.int64)
    cuts = np.searchsorted(at, np.arange(ranges + 1))
    for n in np.unique(at).tolist():
        a, b = int(cuts[n]), int(cuts[n + 1])
        yield {
            "range": n,
            "chunk": number,
            "count": b - a,
            "keys": pack_rising(keys[a:b]),
            "more": more[a:b].tobytes(),
            "flags": pack_bits(flags[a:b].T.ravel()),
        }


def _table(rows: list[dict], names: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(f.split(" ")[0], kinds[f.split(" ")[1]]) for f in names.split(", ")])
    return pa.Table.from_pylist(rows, schema)


def _met(rows: pa.Table, step: int) -> pa.Table:
    """For each chunk that sent keys of this range, which of them occur elsewhere too.

    In the first step (probes) only block keys are answered, in the second every key.
    """
    counts = rows["count"].to_numpy()
    keys = np.concatenate(
        [unpack_rising(k, int(n)) for k, n in zip(rows["keys"].to_pylist(), counts, strict=True)]
    )
    flags = [
        unpack_bits(f, 2 * int(n)).reshape(2, -1)
        for f, n in zip(rows["flags"].to_pylist(), counts, strict=True)
    ]
    block, again = np.concatenate(flags, axis=1)
    if step:
        check = np.concatenate([np.frombuffer(m, np.uint32) for m in rows["more"].to_pylist()])
        order = np.lexsort((check, keys))
        same = (keys[order][1:] == keys[order][:-1]) & (check[order][1:] == check[order][:-1])
    else:
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
    first = np.flatnonzero(np.r_[True, ~same])
    sizes = np.diff(np.r_[first, len(keys)])
    more = (sizes > 1) | np.logical_or.reduceat(again[order], first)
    met = np.empty(len(keys), bool)
    met[order] = np.repeat(more, sizes)
    out, number = [], int(rows["range"][0].as_py())
    for chunk, a, n in zip(
        rows["chunk"].to_pylist(), (np.cumsum(counts) - counts).tolist(), counts.tolist(), strict=True
    ):
        bits = met[a : a + n] if step else met[a : a + n][block[a : a + n]]
        out.append(
            {"chunk": chunk, "step": step, "range": number, "count": len(bits), "bits": pack_bits(bits)}
        )
    return _table(out, REPLY)


def _answer(replies: pa.Table, step: int) -> np.ndarray:
    """The bits of a chunk's keys of one step, in the order of the keys."""
    own = [r for r in replies.to_pylist() if r["step"] == step]
    own.sort(key=lambda r: r["range"])
    parts = [unpack_bits(r["bits"], r["count"]) for r in own]
    return np.concatenate(parts) if parts else np.zeros(0, bool)


def _texts(rows: pa.Table) -> list[bytes | None]:
    return rows["text"].cast(pa.binary()).to_pylist()


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    columns: list[str] | None = None,
    spaced: bool = True,
    window: int = WINDOW,
    block: int = BLOCK,
) -> DataFrame:
    """The given columns of every row, with ``n_words``, ``n_removed`` and ``kept``.

    ``kept`` is the text without its repeated words: the other words joined by one space, or,
    if not ``spaced``, the stretches of the text that stay, joined by line breaks; a text
    that loses nothing then stays byte for byte. Given columns with these names are replaced.
    """
    if window < 2 * block - 1:
        raise ValueError("window must be at least 2 * block - 1")
    spark = docs.sparkSession
    columns = [c for c in docs.columns if c != text] if columns is None else columns
    columns = [c for c in columns if c not in RESULTS]
    renamed = [F.col(f"`{name}`").alias(f"c{n}") for n, name in enumerate(columns)]
    n_columns = len(columns)
    table = chunked(docs.select(F.col(text).alias("text"), *renamed), CHUNK_BYTES)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = F.sum(F.octet_length("text")).alias("size")
    total = table.agg(size).first()["size"] or 0
    ranges = max(buckets, total // (6 * WORDS_PER_RANGE) + 1)

    def send_probes(key: tuple, rows: pa.Table) -> pa.Table:
        keys, is_block, again = probes(Chunk(_texts(rows), word_hashes()), block)
        none = np.zeros((len(keys), 0), np.uint8)
        flags = np.stack([is_block, again], axis=1)
        return _table(list(_sent(key[0].as_py(), keys, PROBE_BITS, ranges, none, flags)), SENT)

    def send_windows(key: tuple, rows: pa.Table, replies: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _table([], SENT)
        chunk = Chunk(_texts(rows), word_hashes())
        found = Candidates(chunk, _answer(replies, 0), block, window)
        flags = np.stack([np.zeros(len(found.keys), bool), found.again], axis=1)
        sent = _sent(key[0].as_py(), found.keys, 64, ranges, found.checks, flags)
        return _table(list(sent), SENT)

    def cut(key: tuple, rows: pa.Table, replies: pa.Table) -> pa.Table:
        texts = _texts(rows)
        chunk = Chunk(texts, word_hashes())
        found = Candidates(chunk, _answer(replies, 0), block, window)
        gone = found.covered(_answer(replies, 1), len(chunk.hashes), window)
        kept, removed = [], []
        for n, words in enumerate(chunk.words):
            own = gone[chunk.offsets[n] : chunk.offsets[n + 1]]
            removed.append(int(own.sum()))
            if spaced:
                pairs = zip(words, own.tolist(), strict=True)
                kept.append(b" ".join(words if not removed[-1] else [w for w, g in pairs if not g]))
            else:
                kept.append(stretches(texts[n], words, own) if removed[-1] else texts[n])
        given = [rows[f"c{n}"] for n in range(n_columns)]
        results = [pa.array(chunk.lengths), pa.array(removed, pa.int64())]
        results.append(pa.array(kept, pa.binary()).cast(pa.string()))
        names = [*(f"c{n}" for n in range(n_columns)), "n_words", "n_removed", "kept"]
        return pa.Table.from_arrays([*given, *results], names=names)

    def met_by_range(step: int):
        def run(rows: pa.Table) -> pa.Table:
            return _met(rows, step)

        return run

    texts = table.select("chunk", "text")
    sent = texts.groupBy("chunk").applyInArrow(send_probes, SENT)
    met = keep(sent.groupBy("range").applyInArrow(met_by_range(0), REPLY), "met-blocks")
    windows = texts.groupBy("chunk").cogroup(met.groupBy("chunk")).applyInArrow(send_windows, SENT)
    repeated = keep(windows.groupBy("range").applyInArrow(met_by_range(1), REPLY), "met-windows")
    replies = met.union(repeated).groupBy("chunk")
    kinds = [table.schema[f"c{n}"] for n in range(n_columns)]
    out = T.StructType(
        [
            *kinds,
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept", T.StringType()),
        ]
    )
    done = table.groupBy("chunk").cogroup(replies).applyInArrow(cut, out)
    named = [F.col(f"c{n}").alias(name) for n, name in enumerate(columns)]
    return done.select(*named, "n_words", "n_removed", "kept")


def stretches(text: bytes | None, words: list[bytes], gone: np.ndarray) -> bytes:
    """The parts of a text between removed words."""
    parts, at, begin = [], 0, None
    for word, out in zip(words, gone.tolist(), strict=True):
        at = text.index(word, at)
        if out and begin is not None:
            parts.append(text[begin:at].rstrip())
            begin = None
        elif not out and begin is None:
            begin = at
        at += len(word)
    if begin is not None:
        parts.append(text[begin:])
    return b"\n".join(parts)
