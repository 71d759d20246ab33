"""Working through Arrow data in pieces of bounded size, and ragged arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Text handled at once inside a task. A single longer text is a piece of its own.
PIECE_BYTES = 4 << 20


def text_sizes(texts: pa.Array) -> np.ndarray:
    """UTF-8 bytes of each text, zero for null."""
    return pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)


def pieces(sizes: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring rows whose sizes add up to about ``most``."""
    if len(sizes) == 0:
        return
    group = (np.cumsum(sizes) - sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    yield from zip(cuts[:-1], cuts[1:], strict=True)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``starts[0], starts[0] + 1, ...`` of all runs, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    """Start of each run, and the end of the last."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def binaries(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary array whose value ``i`` holds the next ``lengths[i]`` elements of ``data``."""
    offsets = offsets_of(lengths * data.itemsize)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), buffers).cast(pa.binary())


def pack_rising(keys: np.ndarray) -> bytes:
    """Rising numbers as differences, byte by byte, the highest bytes that are all zero left out."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    width = (int(steps.max()).bit_length() + 7) // 8 if len(steps) else 0
    return steps.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack_rising(data: bytes, count: int) -> np.ndarray:
    steps = np.zeros((count, 8), np.uint8)
    if count:
        planes = np.frombuffer(data, np.uint8).reshape(-1, count)
        steps[:, : len(planes)] = planes.T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)
