"""Vectors as short codes: product quantisation in whole numbers, exact at every step.

A component ``x`` becomes ``floor(1024 * x)``, and a vector is cut into ``PARTS`` equal parts.
Each position has a codebook of up to ``ENTRIES`` entries, which starts as the parts of the
rows with the smallest numbers and goes through ``ROUNDS`` rounds: every part is assigned to
its nearest entry, then each entry becomes the average of its parts, rounded down. Codes are
the nearest entries of the last codebooks.

Nearest entries are found in a geometric near-neighbour access tree over a codebook. A node
picks a few entries far from each other as split points; each other entry goes to the child
of its nearest split point, and for every child and split point the node stores the range of
the distances between them. A part that lies further from a split point than the range of a
child allows for, given the nearest entry so far, leaves that child out unseen. Distances are
integer square roots, rounded towards keeping a child, and a child goes only if all in it are
strictly further: entries that tie are compared as whole squared distances, and the lower
index wins. Results are those of comparing all entries.

Rounds read the rows where they lie. A task adds its parts up per entry and sends one row per
entry, whatever the data; sums are merged per entry, and the codebooks are all that reaches
the driver. Whole numbers too long for 64 bits take the same way as Python integers.

Rows whose vector is null or holds null, NaN or infinite components are dropped, and those
whose length is not the commonest one (the shortest if several are) or cannot be cut. Rows
without a number come last in the order for the first codebook; rows with the same number are
ordered by their vectors. With fewer rows than entries the codebook is shorter. Repeated rows
count as often as they are there. Errors beyond a 64-bit integer are given as its largest
value. An empty table gives an empty result. Other columns do not matter.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spikewatch.llm.tables import keep

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
# Split points of a node, and entries that need no node.
SPLITS = 8
LEAF = 8
MOST = 2**63 - 1


def whole(vectors: np.ndarray) -> np.ndarray:
    """``floor(SCALE * x)``, as Python integers where squared distances may pass 64 bits."""
    top = float(np.abs(vectors).max(initial=0))
    if top < 2**40 and 4 * (top * SCALE + 1) ** 2 * vectors.shape[1] < 2**62:
        return np.floor(vectors * SCALE).astype(np.int64)
    # From 2^53 on every double is a whole number.
    exact = [int(x) * SCALE if abs(x) >= 2**53 else math.floor(x * SCALE) for x in vectors.flat]
    return np.array(exact, object).reshape(vectors.shape)


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all entries."""
    apart = points[:, None, :] - entries[None, :, :]
    return (apart * apart).sum(axis=2)


def root_below(squares: np.ndarray) -> np.ndarray:
    """Whole square roots, rounded down."""
    if squares.dtype == object:
        return np.frompyfunc(math.isqrt, 1, 1)(squares)
    root = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    root -= root * root > squares
    return root + ((root + 1) * (root + 1) <= squares)


def root_above(squares: np.ndarray) -> np.ndarray:
    root = root_below(squares)
    return root + (root * root < squares).astype(root.dtype)


@dataclass
class Node:
    """``inside`` are the entries of a leaf. Otherwise ``splits`` are the split points,
    ``children`` what is nearest to each, and ``low`` and ``high`` the range of distances of
    a child's entries (rows) to every split point (columns)."""

    inside: np.ndarray
    splits: np.ndarray | None = None
    children: list[Node | None] = field(default_factory=list)
    low: np.ndarray | None = None
    high: np.ndarray | None = None


def far_apart(entries: np.ndarray, inside: np.ndarray, count: int) -> np.ndarray:
    """Entries far from each other, one after the other, lower indexes first on ties."""
    chosen = [0]
    nearest = squared(entries[inside], entries[inside[:1]])[:, 0]
    while len(chosen) < count:
        chosen.append(int(nearest.argmax()))
        new = squared(entries[inside], entries[inside[chosen[-1:]]])[:, 0]
        nearest = np.minimum(nearest, new)
        if not nearest.any():
            break
    return np.unique(inside[chosen])


def grow(entries: np.ndarray, inside: np.ndarray) -> Node:
    """The tree over the entries with the indexes ``inside``, which rise."""
    if len(inside) <= LEAF:
        return Node(inside)
    splits = far_apart(entries, inside, SPLITS)
    rest = np.setdiff1d(inside, splits)
    squares = squared(entries[rest], entries[splits])
    home = squares.argmin(axis=1)
    node = Node(inside[:0], splits)
    node.low = np.zeros((len(splits), len(splits)), squares.dtype)
    node.high = np.zeros_like(node.low)
    for n in range(len(splits)):
        own = home == n
        if not own.any():
            node.children.append(None)
            continue
        node.low[n] = root_below(squares[own]).min(axis=0)
        node.high[n] = root_above(squares[own]).max(axis=0)
        node.children.append(grow(entries, rest[own]))
    return node


class Tree:
    """Exact nearest entries of one codebook."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.root = grow(entries, np.arange(len(entries)))

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each point, and the squared distance."""
        squares = squared(points, self.entries[:1])[:, 0]
        index = np.zeros(len(points), np.int64)
        self._visit(self.root, points, np.arange(len(points)), index, squares)
        return index, squares

    def _compare(self, points, rows, among, index, squares) -> np.ndarray:
        """Take nearer entries over, the lower index on ties; all distances are returned."""
        found = squared(points[rows], self.entries[among])
        column = found.argmin(axis=1)
        best, entry = found[np.arange(len(rows)), column], among[column]
        better = (best < squares[rows]) | ((best == squares[rows]) & (entry < index[rows]))
        index[rows[better]] = entry[better]
        squares[rows[better]] = best[better]
        return found

    def _visit(self, node: Node, points, rows, index, squares) -> None:
        if not len(rows):
            return
        if node.splits is None:
            if len(node.inside):
                self._compare(points, rows, node.inside, index, squares)
            return
        found = self._compare(points, rows, node.splits, index, squares)
        below, above = root_below(found), root_above(found)
        home = found.argmin(axis=1)
        # Each point goes to the child of its nearest split point first.
        for at_home in (True, False):
            for n, child in enumerate(node.children):
                if child is None:
                    continue
                turn = np.flatnonzero((home == n) == at_home)
                reach = root_above(squares[rows[turn]])
                least = np.maximum(below[turn] - node.high[n], node.low[n] - above[turn]).max(axis=1)
                self._visit(child, points, rows[turn[least <= reach]], index, squares)


class Codebooks:
    """The codebooks of all positions; ``entries`` are lists of lists of Python integers."""

    def __init__(self, entries: list[list[list[int]]]):
        self.entries = entries
        self.trees: dict[tuple[int, bool], Tree] = {}

    def __getstate__(self):
        return self.entries

    def __setstate__(self, entries):
        self.__init__(entries)

    def tree(self, part: int, exact: bool) -> Tree:
        if (part, exact) not in self.trees:
            kind = object if exact else np.int64
            self.trees[part, exact] = Tree(np.array(self.entries[part], kind))
        return self.trees[part, exact]

    def _large(self) -> bool:
        top = max((abs(x) for book in self.entries for entry in book for x in entry), default=0)
        return 4 * (top + 1) ** 2 * len(self.entries[0][0]) >= 2**62

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whole vectors, the index of the nearest entry per part, and its squared distance."""
        given = whole(vectors)
        exact = given.dtype == object or self._large()
        given = given.astype(object) if exact else given
        index, squares = [], []
        for part, points in enumerate(np.split(given, PARTS, axis=1)):
            found = self.tree(part, exact).nearest(points)
            index.append(found[0])
            squares.append(found[1])
        return given, np.stack(index, axis=1), np.stack(squares, axis=1)

    def digest(self) -> str:
        """SHA-256 of all components, by part, entry and position."""
        text = ",".join(str(x) for book in self.entries for entry in book for x in entry)
        return hashlib.sha256(text.encode()).hexdigest()


def usable(vector: Column) -> Column:
    """Whether there is a vector whose components are all finite numbers."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def matrix(vectors: pa.Array) -> np.ndarray:
    """The rows of a column of lists of equal length."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), -1)


def _by_size(vectors: np.ndarray) -> list[np.ndarray]:
    """Row numbers, apart for rows that fit into 64 bits and rows that do not."""
    large = np.abs(vectors).max(axis=1) >= 2**16
    return [rows for rows in (np.flatnonzero(~large), np.flatnonzero(large)) if len(rows)]


def first_codebooks(rows: DataFrame) -> Codebooks | None:
    """Parts of the rows with the smallest numbers, nothing if there are no rows."""
    order = [F.col("id").asc_nulls_last(), "vector"]
    smallest = [r["vector"] for r in rows.orderBy(*order).limit(ENTRIES).collect()]
    if not smallest:
        return None
    given = whole(np.array(smallest, np.float64))
    return Codebooks([part.tolist() for part in np.split(given, PARTS, axis=1)])


def next_codebooks(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry becomes the average of the parts nearest to it, rounded down."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        counts: dict[tuple[int, int], int] = {}
        for batch in batches:
            vectors = matrix(batch.column(0))
            for own in _by_size(vectors):
                given, index, _ = books.assign(vectors[own])
                for part, points in enumerate(np.split(given, PARTS, axis=1)):
                    order = np.argsort(index[:, part], kind="stable")
                    entry, first, n = np.unique(
                        index[order, part], return_index=True, return_counts=True
                    )
                    # Python integers from here on: no number of rows overflows them.
                    totals = np.add.reduceat(points[order], first, axis=0).astype(object)
                    for e, total, count in zip(entry.tolist(), totals, n.tolist(), strict=True):
                        sums[part, e] = sums.get((part, e), 0) + total
                        counts[part, e] = counts.get((part, e), 0) + count
        if sums:
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([p for p, _ in sums], pa.int32()),
                    "entry": pa.array([e for _, e in sums], pa.int32()),
                    "n": pa.array([counts[key] for key in sums], pa.int64()),
                    "total": [",".join(map(str, total)) for total in sums.values()],
                }
            )

    def average(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.array([int(x) for x in t.split(",")], object) for t in group["total"])
        new = ",".join(str(x // int(group["n"].sum())) for x in total)
        return group.head(1)[["part", "entry"]].assign(new=new)

    tallied = rows.select("vector").mapInArrow(tally, "part int, entry int, n bigint, total string")
    moved = tallied.groupBy("part", "entry").applyInPandas(
        average, "part int, entry int, new string"
    )
    entries = [list(book) for book in books.entries]
    # At most PARTS * ENTRIES rows.
    for row in moved.collect():
        entries[row["part"]][row["entry"]] = [int(x) for x in row["new"].split(",")]
    return Codebooks(entries)


def coded(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``id``, ``label``, ``code`` and ``error`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch.column(2))
            codes, errors = [""] * len(vectors), [0] * len(vectors)
            for own in _by_size(vectors):
                _, index, squares = books.assign(vectors[own])
                for n, at, error in zip(own.tolist(), index.tolist(), squares.sum(axis=1).tolist()):
                    codes[n], errors[n] = "".join(f"{i:02x}" for i in at), min(error, MOST)
            columns = [batch.column(0), batch.column(1), pa.array(codes), pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "code", "error"])

    fields = [rows.schema["id"], rows.schema["label"]]
    own = [T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    return rows.select("id", "label", "vector").mapInArrow(run, T.StructType([*fields, *own]))


def compress(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> tuple[DataFrame, Codebooks | None]:
    """``vec_id, label, code, error, label_error`` of the rows kept, and the codebooks.

    ``label_error`` is the sum of the errors of all rows with the same label, null being a
    label of its own. Errors are added up per label inside each task first.
    """
    given = rows.select(
        F.col(vec_id).alias("id"),
        F.col(label).alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    given = given.filter(usable(F.col("vector")))
    size = F.size("vector")
    lengths = given.filter((size > 0) & (size % PARTS == 0)).groupBy(size.alias("size")).count()
    common = lengths.orderBy(F.desc("count"), "size").first()
    given = given.filter(size == (common["size"] if common else 0))
    books = first_codebooks(given) if common else None
    if books is None:
        none = given.limit(0).withColumns({"code": F.lit(""), "error": F.lit(0).cast("long")})
        shown = none.withColumn("label_error", F.col("error"))
    else:
        for _ in range(ROUNDS):
            books = next_codebooks(given, books)
        found = keep(coded(given, books), "codes")
        total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST))
        totals = found.groupBy(F.col("label").alias("same")).agg(
            total.cast("long").alias("label_error")
        )
        shown = found.join(totals, F.col("label").eqNullSafe(F.col("same")))
    number = F.col("id").alias(vec_id)
    return shown.select(number, "label", "code", "error", "label_error"), books
