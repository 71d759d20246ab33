"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spikewatch.llm import posting_lists
from spikewatch.llm.posting_lists import Graph, balanced_centroids, neighbours, unit

SCHEMA = "vec_id long, embedding array<float>, label int, entry string, list int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], SCHEMA)


def brute(rows, every, k=5):
    good = [
        (i, np.array(v, np.float32).astype(float))
        for i, v in rows
        if v and None not in v and np.isfinite(v).all() and np.any(np.array(v, np.float32))
    ]
    out = {}
    for i, v in good:
        if i % every == 0:
            scored = sorted(
                (-float(v @ w) / (np.linalg.norm(v) * np.linalg.norm(w)), j) for j, w in good if j != i
            )
            out[i] = [(j, -s) for s, j in scored[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def close(got, want):
    assert got.keys() == {q for q, near in want.items() if near}
    for q, near in got.items():
        assert [i for i, _ in near] == [i for i, _ in want[q]], q
        assert [s for _, s in near] == pytest.approx([s for _, s in want[q]], abs=1e-12)


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(n, rng.normal(size=6).tolist()) for n in range(60)]
    rows += [(60, None), (61, [0.0] * 6), (62, [float("nan")] * 6), (63, [1.0, None] + [0.0] * 4)]
    rows += [(64, [float("inf")] + [0.0] * 5), (65, [1.0, 2.0]), (70, [])]
    # Copies, ties and repeated rows.
    rows += [(100 + n, rows[10][1]) for n in range(20)] + [(10, rows[10][1])]
    usable = [r for r in rows if not r[1] or len(r[1]) == 6]
    close(found(neighbours(table(spark, rows), F.col("vec_id") % 10 == 0)), brute(dict(usable).items(), 10))


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])]
    close(found(neighbours(table(spark, rows), F.col("vec_id") == 0)), {0: brute(rows, 1)[0]})
    assert neighbours(table(spark, rows[:1]), F.col("vec_id") == 0).collect() == []
    assert neighbours(table(spark, []), F.col("vec_id") == 0).collect() == []


@pytest.mark.parametrize("spread", [0.0, 0.35])
def test_recall(spark, monkeypatch, spread):
    """Even and clustered data, over many lists and in small blocks."""
    monkeypatch.setattr(posting_lists, "PER_LIST", 40)
    monkeypatch.setattr(posting_lists, "BLOCK_ENTRIES", 50)
    monkeypatch.setattr(posting_lists, "BLOCK_QUERIES", 7)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    points = rng.normal(size=(3000, 16)) if not spread else (
        centres[rng.integers(0, 30, 3000)] + spread * rng.normal(size=(3000, 16))
    )
    rows = [(n, p.tolist()) for n, p in enumerate(points)]
    want = brute(rows, 50)
    got = found(neighbours(table(spark, rows), F.col("vec_id") % 50 == 0))
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    assert all(len(near) == 5 for near in got.values())


def test_lists_are_even_and_found_by_the_graph():
    rng = np.random.default_rng(3)
    points = unit(rng.normal(size=(4000, 12)))
    centroids = balanced_centroids(points, 64)
    graph = Graph.of(centroids)
    nearest = (points[:500] @ centroids.T).argmax(axis=1)
    held, far = graph.search(points[:500])
    assert (held[:, 0] == nearest).mean() > 0.97
    assert (np.diff(far, axis=1) >= -1e-12).all()
    lists = graph.lists_of(points[:500])
    assert {len(own) for own in lists} != {1} and max(map(len, lists)) <= posting_lists.REPLICAS


def test_recall_with_many_more_lists_than_the_beam():
    """The most lists there are: a fixed number read of them would miss neighbours."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(10, 32))
    points = unit(centres[rng.integers(0, 10, 40_000)] + 0.8 * rng.normal(size=(40_000, 32)))
    sample = points[: posting_lists.SAMPLE_PER_LIST * posting_lists.MOST_LISTS]
    graph = Graph.of(balanced_centroids(sample, posting_lists.MOST_LISTS))
    asked = points[-64:]
    scores = asked @ points.T
    scores[np.arange(64), np.arange(39_936, 40_000)] = -1
    near = np.argsort(-scores, axis=1)[:, :5]
    read = [reached for at in range(0, 64, 8) for reached in graph.reached_by(asked[at : at + 8])]
    hits = sum(
        bool(set(read[n]) & set(own)) for n in range(64) for own in graph.lists_of(points[near[n]])
    )
    assert hits / near.size >= 0.9
    assert max(map(len, read)) <= posting_lists.MOST_LISTS // posting_lists.SHARE


def test_rows_without_a_number_and_extreme_components(spark):
    schema = "vec_id long, embedding array<double>"
    rng = np.random.default_rng(5)
    rows = [(n, rng.normal(size=4).tolist()) for n in range(30)]
    # Scaled by powers of two, so that plain cosines of the unscaled rows are the same.
    scales = [2.0**900, 2.0**-900, 1.0]
    big = [(n, (np.array(v) * scales[n % 3]).tolist()) for n, v in rows]
    given = [*big, (None, rows[0][1]), (None, None)]
    plain = {n: np.array(v) for n, v in rows}
    got = found(neighbours(spark.createDataFrame(given, schema), F.col("vec_id") % 10 == 0))
    assert sorted(got) == [0, 10, 20]
    for q, near in got.items():
        cosines = {
            n: float(plain[q] @ v) / (np.linalg.norm(plain[q]) * np.linalg.norm(v))
            for n, v in plain.items() if n != q
        }
        best = sorted(cosines, key=lambda n: (-cosines[n], n))[:5]
        assert [n for n, _ in near] == best
        assert [s for _, s in near] == pytest.approx([cosines[n] for n in best], abs=1e-15)
