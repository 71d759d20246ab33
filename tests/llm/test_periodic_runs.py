"""Runs against all periods of all stretches, and the query's fixed digests."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from spikewatch.llm import periodic_runs, queries
from spikewatch.llm.periodic_runs import collapsed, find_runs, repeating_tail, runs_of


def plain(words):
    """Every stretch of equal words ``q`` apart, for each ``q`` from the smallest on."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def digests(words):
    runs = plain(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in (lines, kept)]
    return (len(runs), *best, milli, *sha)


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def some_words(rng):
    words = [rng.choice("abcde"[: rng.choice([1, 2, 2, 3, 5])]) for _ in range(rng.randrange(60))]
    if words and rng.random() < 0.6:
        unit = words[: rng.randrange(1, 9)]
        words = words[: rng.randrange(len(words))] + (unit * 9)[: rng.randrange(70)] + words[:5]
    return words


def test_against_all_stretches():
    rng, total = random.Random(1), 0
    for _ in range(400):
        texts = [some_words(rng) for _ in range(rng.randrange(1, 6))]
        found = runs_of([[w.encode() for w in words] for words in texts])
        assert found == [plain(words) for words in texts]
        total += sum(map(len, found))
    assert total > 500


def test_long_periods_and_nested_runs():
    rng = random.Random(2)
    unit = [f"w{rng.randrange(50)}" for _ in range(700)]
    inner = (["x", "y"] * 6 + ["z"]) * 5
    texts = [unit * 4 + unit[:13], unit * 3, inner, ["a"] * 5000, ["q"] + ["a", "b"] * 999 + ["c"]]
    found = runs_of([[w.encode() for w in words] for words in texts])
    assert found[0] == [(0, 2813, 700)] and found[1] == []
    assert found[2] == plain(inner) and len(found[2]) == 6
    assert found[3] == [(0, 5000, 1)] and found[4] == [(1, 1998, 2)]


def test_equal_passages_of_different_texts_do_not_meet():
    words = [b"a", b"b", b"c"] * 3
    assert runs_of([words, words, words]) == [[], [], []]


def test_collapsed_keeps_the_first_period():
    words = [b"s", *[b"a", b"b"] * 5, b"a", b"t"]
    assert collapsed(words, [(1, 11, 2)]) == [b"s", b"a", b"b", b"t"]


def test_repeating_tail():
    rng = random.Random(3)
    changed = 0
    for n in range(300):
        words = [str(rng.randrange(99)) for _ in range(rng.randrange(40))]
        got = [w.decode() for w in repeating_tail([w.encode() for w in words], str(n))]
        assert got == planted(n, words)
        changed += got != words
    assert changed
    assert repeating_tail([b"a"], None) == [b"a"]


@pytest.fixture
def odd_rows(prose):
    rng = random.Random(4)
    rows = [(n, " ".join(some_words(rng))) for n in range(200)]
    rows += [(n, prose(n, 40)) for n in range(200, 400)]
    rows += [(1, None), (2, ""), (3, " \n\t "), (None, "a a a a a a a"), (None, None), (7, "x"), (7, "x")]
    rows += [(900, "no break   here " * 30), (901, "a\x00b " * 9), (902, prose(9, 30_000))]
    return rows


def test_query(spark, make_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(periodic_runs, "pieces", lambda sizes: [(n, n + 1) for n in range(len(sizes))])
    docs = make_docs(odd_rows).repartition(3)
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    got = sorted(map(repr, map(tuple, queries.op13_periodic_runs(spark, "").collect())))
    words = [(n, "".join(c if c not in "\t\n\x0b\x0c\r " else " " for c in t or "").split(" ")) for n, t in odd_rows]
    words = [(n, planted(n, [w for w in ws if w])) for n, ws in words]
    assert got == sorted(repr((n, *digests(ws))) for n, ws in words)


def test_empty_table(make_docs):
    docs = make_docs([])
    assert docs.select(find_runs(F.col("text")).alias("found")).select("found.runs").collect() == []
