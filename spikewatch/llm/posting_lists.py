"""Approximate nearest neighbours by cosine, with balanced posting lists.

The lists' centroids come from a bounded sample of the vectors, halved again and again at the
median of the direction between two means, so that lists are of even size. Every vector is
indexed: in the list of its nearest centroid, and, if it lies near a boundary, also in those
of other centroids that are hardly farther and that no chosen centroid covers. Centroids
are found by a beam search on their neighbour graph, held in memory; there are ``MOST_LISTS`` of
them at most, whatever the input. A query reads the lists whose distance is within a ratio
of the nearest one's, up to the same share of all lists however many there are. Where
neighbours are near the ratio leaves most of those out; where they hardly differ from any other
vector (a fifth neighbour at a cosine of 0.5 in 64 dimensions) no list is far enough to do without.

Equal vectors are one entry that keeps its smallest numbers, as many as a result can show, so
copies cost nothing and lose nothing. Lists and their queries meet in blocks of bounded size.
Scores are cosines in double precision over the vectors as given.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do those
that are not of the most common length, nor rows without a number. Components may be as large
or small as doubles get. With few vectors there is one list, and the search
is exact. Ties go to the smaller number. Rows with the same number and vector count once; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spikewatch.llm.tables import keep

# The sample the centroids are fitted on, at least so many and so many for each list, and the
# vectors a list should have.
SAMPLE = 20_000
SAMPLE_PER_LIST = 8
PER_LIST = 200
MOST_LISTS = 4096
# Neighbours of a centroid in the graph, and how many the search holds on to; a query's search
# holds on to one in ``SHARE`` of the centroids if that is more.
DEGREE = 24
BEAM = 48
SHARE = 16
# A vector joins lists up to this ratio of its nearest distance, and so many at most.
BOUNDARY = 1.15
REPLICAS = 6
# A query reads lists up to this ratio of its nearest distance, of those in the beam.
REACH = 1.35
# Entries and queries that meet in one task's block.
BLOCK_ENTRIES = 8192
BLOCK_QUERIES = 8192

FOUND = "query binary, entry binary, ids array<long>, score double"


def usable(vector: Column) -> Column:
    """Whether a vector can take part."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall(wide, lambda x: x == 0)
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad & ~zero, F.lit(False))


def packed(vector: Column) -> Column:
    """The vector as little-endian doubles, zeros without a sign."""

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            rows = vectors.to_pylist()
            yield pa.array(
                [None if v is None else (np.array(v, "<f8") + 0.0).tobytes() for v in rows],
                pa.binary(),
            )

    return run(vector)


def matrix(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), -1)


def unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first, so that no square runs over or vanishes.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times powers of two: no square runs over, and no digit of a cosine changes."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def balanced_centroids(points: np.ndarray, lists: int) -> np.ndarray:
    """Means of ``lists`` (a power of two) parts of even size."""
    parts = [points]
    while len(parts) < lists:
        parts = [half for part in parts for half in _halves(part)]
    means = np.array([part.mean(axis=0) for part in parts])
    norms = np.linalg.norm(means, axis=1, keepdims=True)
    return means / np.where(norms > 0, norms, 1)


def _halves(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two halves on either side of a plane between two means."""
    centre = points.mean(axis=0)
    far = points[((points - centre) ** 2).sum(axis=1).argmax()]
    direction = far - centre
    for _ in range(8):
        side = (points - centre) @ direction > 0
        if side.all() or not side.any():
            break
        new = points[side].mean(axis=0) - points[~side].mean(axis=0)
        if np.allclose(new, direction):
            break
        direction = new
    order = np.argsort(points @ direction, kind="stable")
    middle = len(points) // 2
    return points[order[:middle]], points[order[middle:]]


@dataclass
class Graph:
    """Centroids and, for each, its nearest others; searched from spread-out entries."""

    centroids: np.ndarray
    near: np.ndarray

    @staticmethod
    def of(centroids: np.ndarray) -> Graph:
        n = len(centroids)
        degree = min(DEGREE, n - 1)
        near = np.empty((n, degree), np.int64)
        for at in range(0, n, 512):
            part = centroids[at : at + 512] @ centroids.T
            part[np.arange(len(part)), at + np.arange(len(part))] = -np.inf
            near[at : at + 512] = np.argsort(-part, axis=1, kind="stable")[:, :degree]
        return Graph(centroids, near)

    def width(self, query: bool) -> int:
        """How many centroids a search holds on to."""
        n = len(self.centroids)
        return min(max(BEAM, -(-n // SHARE)) if query else BEAM, n)

    def search(self, points: np.ndarray, query: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroids of each point and their distances, nearest first.

        All beams advance together: in every round the neighbours of all held centroids are
        compared, until no beam changes.
        """
        width = self.width(query)
        entries = np.linspace(0, len(self.centroids) - 1, width).astype(np.int64)
        held = np.tile(entries, (len(points), 1))
        scores = points @ self.centroids[entries].T
        while True:
            more = self.near[held].reshape(len(points), -1)
            every = np.concatenate([held, more], axis=1)
            every.sort(axis=1)
            fresh = np.einsum("nd,nkd->nk", points, self.centroids[every])
            fresh[:, 1:][every[:, 1:] == every[:, :-1]] = -np.inf
            order = np.argsort(-fresh, axis=1, kind="stable")[:, :width]
            new = np.take_along_axis(every, order, axis=1)
            scores = np.take_along_axis(fresh, order, axis=1)
            if new.shape == held.shape and (new == held).all():
                break
            held = new
        return held, np.sqrt(np.maximum(2 - 2 * scores, 0))

    def lists_of(self, points: np.ndarray) -> list[list[int]]:
        """Lists a vector belongs to: its nearest, and others across a boundary."""
        out = []
        for found, far in zip(*self.search(points), strict=True):
            own = [int(found[0])]
            for centroid, distance in zip(found[1:].tolist(), far[1:].tolist(), strict=True):
                if len(own) == REPLICAS or distance > BOUNDARY * far[0]:
                    break
                # A centroid nearer to a chosen one than to the vector adds little.
                between = np.linalg.norm(self.centroids[own] - self.centroids[centroid], axis=1)
                if (between > distance).all():
                    own.append(centroid)
            out.append(own)
        return out

    def reached_by(self, points: np.ndarray) -> list[list[int]]:
        """Lists a query reads."""
        found, far = self.search(points, True)
        within = far <= REACH * far[:, :1] + 1e-9
        return [row[use].tolist() for row, use in zip(found, within, strict=True)]


def _lists(vector: Column, graph: Graph, query: bool) -> Column:
    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        place = graph.reached_by if query else graph.lists_of
        # A wider search takes fewer points at once.
        step = max(64 * BEAM // graph.width(query), 1) if graph.width(query) > BEAM else 64
        for vectors in batches:
            rows, found = vectors.to_pylist(), []
            for at in range(0, len(rows), step):
                found += place(unit(matrix(rows[at : at + step])))
            yield pa.array(found, pa.list_(pa.int32()))

    return run(vector)


def fit(entries: DataFrame, count: int) -> Graph:
    """The graph of centroids from a sample of the distinct vectors that grows with their lists."""
    lists = 1
    while lists * 2 * PER_LIST <= count and lists * 2 <= MOST_LISTS:
        lists *= 2
    share = min(1.0, max(SAMPLE, SAMPLE_PER_LIST * lists) / max(count, 1))
    pick = F.pmod(F.xxhash64("entry"), F.lit(1 << 30)) < int(share * (1 << 30))
    rows = sorted(bytes(r[0]) for r in entries.filter(pick).select("entry").collect())
    points = unit(matrix(rows))
    return Graph.of(balanced_centroids(points, min(lists, len(points))))


def _in_blocks(entries: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``part`` and ``turn``; every part of a list meets all turns of it."""

    def sized(rows: DataFrame, key: str, most: int, name: str) -> DataFrame:
        count = F.ceil(F.count(key) / most).cast("int").alias(name)
        return rows.groupBy("list").agg(count)

    sizes = sized(entries, "entry", BLOCK_ENTRIES, "parts").join(
        sized(queries, "query", BLOCK_QUERIES, "turns"), "list"
    )
    # At most MOST_LISTS rows.
    sizes = F.broadcast(sizes)

    def spread(rows: DataFrame, key: str, own: str, own_count: str, other: str, n: str) -> DataFrame:
        own_block = F.pmod(F.xxhash64(key), F.col(own_count)).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias(other)
        return rows.join(sizes, "list").select(*rows.columns, own_block, every)

    return (
        spread(entries, "entry", "part", "parts", "turn", "turns"),
        spread(queries, "query", "turn", "turns", "part", "parts"),
    )


def neighbours(
    rows: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found to each query row."""
    given = rows.filter(usable(F.col(vector)) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).alias("vec_id"),
        is_query.alias("asks"),
        packed(F.col(vector)).alias("entry"),
        F.size(vector).alias("length"),
    )
    given = keep(given.distinct(), "vectors")
    lengths = given.groupBy("length").count().orderBy(F.desc("count"), "length").first()
    given = given.filter(F.col("length") == (lengths["length"] if lengths else 0))
    # The smallest numbers of each distinct vector: one more than can be shown, as a query
    # may be among them.
    order = F.row_number().over(Window.partitionBy("entry").orderBy("vec_id"))
    entries = (
        given.withColumn("order", order)
        .filter(F.col("order") <= k + 1)
        .groupBy("entry")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    entries = keep(entries, "entries")
    count = entries.count()
    asked = given.filter("asks").select("vec_id", F.col("entry").alias("query"))
    if not count:
        return asked.select(
            F.col("vec_id").alias("query_id"),
            F.lit(0).alias("rank"),
            "vec_id",
            F.lit(0.0).alias("score"),
        ).limit(0)
    graph = fit(entries, count)
    posted = entries.withColumn("list", F.explode(_lists(F.col("entry"), graph, False)))
    queries = asked.select("query").distinct()
    queries = queries.withColumn("list", F.explode(_lists(F.col("query"), graph, True)))
    left, right = _in_blocks(keep(posted, "posted"), keep(queries, "queries"))

    def search(rows: pa.Table, asking: pa.Table) -> pa.Table:
        out: list[dict] = []
        if rows.num_rows and asking.num_rows:
            keys, ids = rows["entry"].to_pylist(), rows["ids"].to_pylist()
            vectors = scaled(matrix(keys))
            lengths = np.linalg.norm(vectors, axis=1)
            for query in asking["query"].to_pylist():
                own = scaled(matrix([query]))[0]
                scores = np.einsum("nd,d->n", vectors, own) / (lengths * np.linalg.norm(own))
                # All that tie with the last place go on; copies of the query may be skipped.
                best = np.argsort(-scores, kind="stable")[: k + 1]
                best = np.flatnonzero(scores >= scores[best[-1]])
                out += [
                    {"query": query, "entry": keys[n], "ids": ids[n], "score": float(scores[n])}
                    for n in best.tolist()
                ]
        schema = pa.schema(
            [
                ("query", pa.binary()),
                ("entry", pa.binary()),
                ("ids", pa.list_(pa.int64())),
                ("score", pa.float64()),
            ]
        )
        return pa.Table.from_pylist(out, schema)

    blocks = ("list", "part", "turn")
    found = left.groupBy(*blocks).cogroup(right.groupBy(*blocks)).applyInArrow(search, FOUND)
    # Several lists may have found the same entry.
    found = found.groupBy("query", "entry").agg(
        F.max("score").alias("score"), F.first("ids").alias("ids")
    )
    near = Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0])
    best = found.withColumn("order", F.row_number().over(near)).filter(F.col("order") <= k + 1)
    best = keep(best.select("query", "ids", "score"), "found")
    pairs = (
        asked.withColumnRenamed("vec_id", "query_id")
        .join(best, "query")
        .select("query_id", "score", F.explode("ids").alias("vec_id"))
        .filter("query_id != vec_id")
    )
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
