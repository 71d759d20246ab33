"""Codes, errors and codebooks against plain integer arithmetic over all entries."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import types as T

from spikewatch.llm import vector_codes
from spikewatch.llm.vector_codes import Codebooks, Tree, compress, root_above, root_below, whole

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        T.StructField("label", T.IntegerType()),
        T.StructField("code", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("id", T.StringType()),
    ]
)


def plain(rows, entries=256, rounds=4):
    """``(vec_id, code, error, label_error)`` of the rows, and the digest."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    scaled = [[math.floor(1024 * Fraction(x)) for x in r[1]] for r in rows]
    width = len(scaled[0]) // 4
    cut = [[v[p * width : (p + 1) * width] for p in range(4)] for v in scaled]
    books = [[v[p] for v in cut[:entries]] for p in range(4)]

    def nearest(part, p):
        return min(
            (sum((a - b) ** 2 for a, b in zip(part, e)), n) for n, e in enumerate(books[p])
        )

    for _ in range(rounds):
        for p in range(4):
            own = {}
            for v in cut:
                own.setdefault(nearest(v[p], p)[1], []).append(v[p])
            for n, parts in own.items():
                books[p][n] = [sum(c) // len(parts) for c in zip(*parts)]
    out, totals = [], {}
    for r, v in zip(rows, cut):
        found = [nearest(v[p], p) for p in range(4)]
        error = sum(d for d, _ in found)
        totals[r[2]] = totals.get(r[2], 0) + error
        out.append((r[0], "".join(f"{n:02x}" for _, n in found), error, r[2]))
    text = ",".join(str(x) for book in books for e in book for x in e)
    cap = vector_codes.MOST
    done = [(i, c, min(e, cap), min(totals[label], cap)) for i, c, e, label in out]
    return done, hashlib.sha256(text.encode()).hexdigest()


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA)


def check(spark, rows, given=None):
    frame = table(spark, rows if given is None else given).repartition(3)
    found, books = compress(frame)
    expected, digest = plain(rows)
    got = found.select("vec_id", "code", "error", "label_error").collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(map(tuple, got), key=order) == sorted(expected, key=order)
    assert books.digest() == digest


def vectors(seed, n, size=8, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (7, size))
    return (centres[rng.integers(0, 7, n)] + spread * rng.normal(0, 0.1, (n, size))).tolist()


def test_against_plain_arithmetic(spark):
    rows = [(n * 3, v, n % 4 if n % 5 else None) for n, v in enumerate(vectors(1, 400))]
    check(spark, rows)


def test_ties_and_repeated_rows(spark):
    """Few distinct parts: entries tie all the time, and many entries are never used."""
    rng = np.random.default_rng(2)
    rows = [(n, (rng.integers(-1, 2, 8) / 1024).tolist(), 0) for n in range(300)]
    check(spark, rows + rows[:40])


def test_rows_that_take_no_part(spark):
    rows = [(n, v, 1) for n, v in enumerate(vectors(3, 30))]
    rows += [(None, rows[0][1], None), (None, vectors(4, 1)[0], None)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [nan] * 8, [0.0] * 7 + [inf], [None] + [0.0] * 7, [1.0] * 4, [1.0] * 7]
    check(spark, rows, rows + [(-9, v, 1) for v in odd])


def test_components_beyond_64_bits(spark):
    rows = [(n, v, n % 2) for n, v in enumerate(vectors(5, 20))]
    rows += [(50, [1e200] * 8, 0), (51, [-3e18, 5e-324] * 4, 1), (52, [1.5e200] * 8, 1)]
    check(spark, rows)


def test_empty_table(spark):
    found, books = compress(table(spark, []))
    assert found.collect() == [] and books is None
    assert found.columns == ["vec_id", "label", "code", "error", "label_error"]


@pytest.mark.parametrize("kind", [np.int64, object])
def test_tree_finds_what_a_scan_finds(kind):
    rng = np.random.default_rng(6)
    for _ in range(60):
        entries = rng.integers(-4, 5, (rng.integers(1, 257), rng.integers(1, 5)))
        points = rng.integers(-5, 6, (60, entries.shape[1]))
        all_squares = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        index, squares = Tree(entries.astype(kind)).nearest(points.astype(kind))
        assert (index == all_squares.argmin(axis=1)).all()
        assert (squares == all_squares.min(axis=1)).all()


def test_tree_leaves_entries_out(monkeypatch):
    rng = np.random.default_rng(7)
    entries = (rng.normal(0, 1, (256, 16)) * 3 + rng.integers(-300, 300, (16, 16))[rng.integers(0, 16, 256)]).astype(int)
    points = entries[rng.integers(0, 256, 500)] + rng.integers(-2, 3, (500, 16))
    seen = []
    monkeypatch.setattr(
        vector_codes, "squared", lambda a, b, of=vector_codes.squared: seen.append(len(a) * len(b)) or of(a, b)
    )
    tree = Tree(entries)
    seen.clear()
    tree.nearest(points)
    assert sum(seen) < 0.3 * len(points) * len(entries)


def test_roots_are_rounded_towards_keeping():
    squares = np.array([0, 1, 2, 3, 4, 2**62 - 1, (2**31 - 1) ** 2, (2**31 - 1) ** 2 + 1])
    for kind in (np.int64, object):
        below, above = root_below(squares.astype(kind)), root_above(squares.astype(kind))
        for s, low, high in zip(squares.tolist(), below.tolist(), above.tolist()):
            assert low == math.isqrt(s) and high == (low if low * low == s else low + 1)


def test_whole_numbers_round_down():
    assert whole(np.array([[-0.0001, 0.0, 0.9999, -1.0]])).tolist() == [[-1, 0, 1023, -1024]]
    assert whole(np.array([[-5e-324, 2.0**60, 1e300, 0.5]])).tolist()[0][:2] == [-1, 2**70]


def test_codebooks_travel():
    import pickle

    books = Codebooks([[[1, 2], [3, 4]]] * 4)
    books.tree(0, False)
    assert pickle.loads(pickle.dumps(books)).entries == books.entries
