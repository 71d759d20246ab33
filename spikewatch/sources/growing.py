"""A stream of lines from text files that grow by appending.

Spark's own file source takes a file once and never looks at it again. This one remembers a
byte position: it reads the files of a folder (or a single file) in the order of their names,
each as far as its last whole line, and goes on from there when more is there. Only the file
with the greatest name may grow; one that a later name follows is finished, and then its last
line counts even without a line break. What is left of a torn line waits for its rest.

The position is one file name and one number, however many files there are, so that the
checkpoint stays small. Files are cut into byte ranges that tasks read on their own; nothing
but names, sizes and the end of the last line is looked at on the driver. Paths may be local or
any that ``pyarrow.fs`` opens (``s3://``, ``gs://``, ``hdfs://``).

Names starting with ``_`` or ``.`` do not count, in folders below too. A path that does not
exist yet is an empty stream. A file that has become shorter is an error: what was read would
no longer be what is there. Bytes that are not UTF-8 become replacement characters.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "growing_lines"
# Bytes a task reads, what it holds at a time, and what is searched at once for a line's end.
RANGE_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20
TAIL_BYTES = 64 << 10
BEGINNING = {"file": "", "bytes": 0}


@dataclass(frozen=True)
class ByteRange(InputPartition):
    """Lines of ``file`` that begin in ``[start, end)``; ``begins`` if a line begins at ``start``."""

    file: str
    start: int
    end: int
    limit: int
    begins: bool


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, and the path on it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def visible(root: str, path: str) -> bool:
    inside = path.removeprefix(root).strip("/")
    return not any(part.startswith(("_", ".")) for part in inside.split("/"))


def sizes_of(path: str) -> dict[str, int]:
    """Sizes of the files at a path, by name."""
    system, root = opened(path)
    info = system.get_file_info(root)
    if info.type == pafs.FileType.NotFound:
        return {}
    if info.type == pafs.FileType.File:
        return {info.path: info.size}
    found = system.get_file_info(pafs.FileSelector(root, recursive=True))
    files = [f for f in found if f.type == pafs.FileType.File and visible(root, f.path)]
    return {f.path: f.size for f in sorted(files, key=lambda f: f.path)}


def whole_lines(system: pafs.FileSystem, file: str, start: int, size: int) -> int:
    """Where the last whole line ends, ``start`` if there is none."""
    with system.open_input_file(file) as stream:
        end = size
        while end > start:
            begin = max(start, end - TAIL_BYTES)
            at = stream.read_at(end - begin, begin).rfind(b"\n")
            if at >= 0:
                return begin + at + 1
            end = begin
    return start


def lines_in(stream: pa.NativeFile, part: ByteRange) -> Iterator[list[bytes]]:
    """The lines that begin in a range, some at a time; the last may reach beyond it."""
    # The byte before the range tells whether a line begins with it.
    skipping, rest = not part.begins, b""
    at = part.start - skipping
    stream.seek(at)
    while block := stream.read(min(BLOCK_BYTES, part.limit - at)):
        at += len(block)
        data = rest + block
        if skipping:
            cut = data.find(b"\n")
            if cut < 0:
                if at >= part.end:
                    return
                continue
            data, skipping = data[cut + 1 :], False
        begin = at - len(data)
        *whole, rest = data.split(b"\n")
        if at >= part.end:
            own = []
            for line in whole:
                if begin >= part.end:
                    break
                own.append(line)
                begin += len(line) + 1
            yield own
            if begin >= part.end:
                return
        else:
            yield whole
    if rest:
        yield [rest]


def last_planned(checkpoint: str) -> dict:
    """Where the last micro-batch in a checkpoint ends, for a query with this source alone."""
    names = [n for n in sizes_of(f"{checkpoint.rstrip('/')}/offsets") if n.rpartition("/")[2].isdigit()]
    if not names:
        return dict(BEGINNING)
    last = max(names, key=lambda n: int(n.rpartition("/")[2]))
    system, _ = opened(checkpoint)
    with system.open_input_file(last) as stream:
        # A version, the batch's metadata, and a line for each source.
        return json.loads(stream.read().decode().splitlines()[2])


class GrowingLinesReader(DataSourceStreamReader):
    """Options: ``path``; ``folderPerBatch`` (``true`` ends a micro-batch with a folder, and needs
    the query's location as ``checkpoint``: Spark does not tell a source where it starts before
    it asks how far there is to go)."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.by_folder = options.get("folderperbatch", "false").lower() == "true"
        self.checkpoint = options.get("checkpoint")
        if self.by_folder and not self.checkpoint:
            raise ValueError("folderPerBatch needs the checkpoint")
        # The position last handed out; unknown until the first micro-batch.
        self.at: dict | None = None

    def initialOffset(self) -> dict:
        return dict(BEGINNING)

    def latestOffset(self) -> dict:
        system, _ = opened(self.path)
        if self.at is None and self.checkpoint:
            self.at = last_planned(self.checkpoint)
        at = self.at or BEGINNING
        sizes = sizes_of(self.path)
        names = [name for name in sizes if name >= at["file"]]
        if self.by_folder:
            names = self._one_folder(names, sizes, at)
        if not names:
            return dict(at)
        last = names[-1]
        start = at["bytes"] if last == at["file"] else 0
        if sizes[last] < start:
            raise ValueError(f"{last} has become shorter than the {start} bytes read of it")
        finished = last != next(reversed(sizes))
        end = sizes[last] if finished else whole_lines(system, last, start, sizes[last])
        return {"file": last, "bytes": end}

    @staticmethod
    def _one_folder(names: list[str], sizes: dict[str, int], at: dict) -> list[str]:
        """The names up to the end of the next folder with something unread."""
        unread = [n for n in names if sizes[n] > (at["bytes"] if n == at["file"] else 0)]
        if not unread:
            return []
        folder = unread[0].rpartition("/")[0]
        return [n for n in names if n <= unread[0] or n.rpartition("/")[0] == folder]

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        self.at = end
        parts = []
        for name, size in sizes_of(self.path).items():
            if not start["file"] <= name <= end["file"]:
                continue
            first = start["bytes"] if name == start["file"] else 0
            limit = end["bytes"] if name == end["file"] else size
            for at in range(first, limit, RANGE_BYTES):
                stop = min(at + RANGE_BYTES, limit)
                parts.append(ByteRange(name, at, stop, limit, at == first))
        # Spark wants one partition at least.
        return parts or [ByteRange("", 0, 0, 0, True)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if partition.start == partition.end:
            return
        system, _ = opened(self.path)
        with system.open_input_file(partition.file) as stream:
            for lines in lines_in(stream, partition):
                texts = [line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines]
                yield pa.RecordBatch.from_pydict({"value": pa.array(texts, pa.string())})

    def commit(self, end: dict) -> None:
        """Nothing is kept that could be let go."""


class GrowingLines(DataSource):
    """The source by the name ``growing_lines``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> GrowingLinesReader:
        return GrowingLinesReader(self.options)
