"""Links and classes against all pairs of shingle sets."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spikewatch.llm import jaccard_forest
from spikewatch.llm.jaccard_forest import (
    DEPTH,
    LARGE,
    TREES,
    common,
    depths_by_size,
    hubs,
    labels,
    least_similar,
    near_copies,
    prefix_depth,
    shingles,
)
from spikewatch.llm.words import WordHashes


def plain(texts, threshold=0.8):
    sets = []
    for t in texts:
        words = (t or "").encode().split()
        n = min(5, len(words))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    links, root = [0] * len(texts), list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both / (len(sets[a]) + len(sets[b]) - both) >= threshold:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [(n, find(n), links[n]) for n in range(len(texts))]


def edited(text, rng, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(prose):
    rng = random.Random(5)
    texts = [None, "", " \t", "one", "one", "two words", "one two three four five"]
    texts += [prose(n, 120) for n in range(12)]
    for n in range(12):
        texts += [edited(texts[7 + n], rng, c) for c in (0, 1, 2, 3, 5, 9)]
    # A large group of near copies, and copies that differ in white space only.
    base = prose(77, 200)
    texts += [edited(base, rng, 1 + n % 3) for n in range(40)]
    texts += [texts[8].replace(" ", "\n"), base, base, base]
    return texts


def test_against_all_pairs(make_docs, prose):
    texts = corpus(prose)
    rows = near_copies(make_docs(list(enumerate(texts))).repartition(5)).orderBy("doc_id").collect()
    assert [tuple(r) for r in rows] == plain(texts)


def test_blocks_lose_no_link(make_docs, prose, monkeypatch):
    monkeypatch.setattr(jaccard_forest, "BLOCK_TEXTS", 7)
    texts = corpus(prose)
    rows = near_copies(make_docs(list(enumerate(texts)))).orderBy("doc_id").collect()
    assert [tuple(r) for r in rows] == plain(texts)


def test_repeated_rows_and_empty_table(make_docs, prose):
    rows = near_copies(make_docs([(4, prose(1, 50)), (4, prose(1, 50)), (9, "x"), (9, None)])).collect()
    assert sorted(tuple(r) for r in rows) == [(4, 4, 1), (4, 4, 1), (9, 9, 0), (9, 9, 0)]
    assert near_copies(make_docs([])).collect() == []


def test_different_texts_with_one_number(make_docs, prose):
    rng = random.Random(2)
    a, b = prose(1, 100), prose(2, 100)
    rows = [(1, a), (1, b), (1, None), (2, edited(a, rng, 1)), (3, edited(b, rng, 1))]
    got = near_copies(make_docs(rows).repartition(3)).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 0), (1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]


@pytest.mark.parametrize("rare", [1, 24])
def test_intersections(monkeypatch, rare):
    monkeypatch.setattr(jaccard_forest, "RARE", rare)
    monkeypatch.setattr(jaccard_forest, "SLAB", 5)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 40))).astype(np.uint64) for _ in range(30)]
    left, right = np.arange(0, 20), np.arange(10, 30)
    got = common(sets, left, right)
    for i, a in enumerate(left):
        for j, b in enumerate(right):
            if a != b:
                assert got[i, j] == len(np.intersect1d(sets[a], sets[b]))


def test_hubs_follow_links():
    links = np.zeros((5, 5), bool)
    for a, b in ((0, 3), (3, 4)):
        links[a, b] = links[b, a] = True
    every = np.arange(5)
    assert hubs(links, every, every, 5).tolist() == [0, 1, 2, 0, 0]


def test_prefixes_are_shortened_to_the_target():
    depths = [prefix_depth(0.8, target) for target in (0.5, 0.99, 0.9995, 0.999999)]
    assert depths == sorted(depths, reverse=True) and depths[0] == jaccard_forest.DEPTH
    assert prefix_depth(0.8, 0.9995) == 6
    assert prefix_depth(0.3, 1.0) == 1


def test_labels_meet_as_often_as_expected(prose):
    """The share of equal levels estimates the similarity."""
    rng = random.Random(1)
    text = prose(3, 400)
    other = edited(text, rng, 12)
    hashes = WordHashes()
    a, b = (shingles(hashes.of(t.encode().split())) for t in (text, other))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    same = labels(a).view(np.uint8) == labels(b).view(np.uint8)
    assert abs(same.mean() - true) < 0.12


def test_pairs_of_blocks_are_dealt_to_all_tasks(spark, monkeypatch, prose, make_docs):
    """One large group, joins that shuffle, and 36 pairs of blocks in many partitions."""
    monkeypatch.setattr(jaccard_forest, "BLOCK_TEXTS", 6)
    real, parts = jaccard_forest._verified, []

    def verified(pairs, threshold):
        links = real(pairs, threshold)
        blocks = pairs.select("group", "low", "high").distinct().count()
        parts.append((blocks, links.select(F.spark_partition_id()).distinct().count()))
        return links

    monkeypatch.setattr(jaccard_forest, "_verified", verified)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    rng, base = random.Random(3), prose(5, 150)
    rows = [(n, edited(base, rng, 1)) for n in range(48)]
    try:
        found = near_copies(make_docs(rows)).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len({r.class_id for r in found}) == 1
    blocks, used = parts[0]
    assert blocks >= 30 and used >= 10


def test_texts_without_a_number_keep_their_links(make_docs, prose):
    rng = random.Random(4)
    a, b = prose(1, 100), prose(2, 100)
    rows = [(None, a), (None, a), (5, edited(a, rng, 1)), (6, edited(a, rng, 1)), (None, b)]
    found = sorted(near_copies(make_docs(rows)).collect(), key=lambda r: (r.doc_id or 0, r.n_links))
    assert [tuple(r) for r in found] == [(None, None, 0), (None, 5, 3), (None, 5, 3), (5, 5, 3), (6, 5, 3)]


def test_keys_tell_classes_apart(make_docs, prose):
    rng = random.Random(2)
    a, b = prose(1, 100), prose(2, 100)
    rows = [(1, a), (1, b), (2, edited(a, rng, 1)), (3, edited(b, rng, 1)), (4, None)]
    found = near_copies(make_docs(rows), keys=True).collect()
    assert len({r.class_key for r in found if r.class_key}) == 2 and len({r.key for r in found}) == 5
    assert all(r.class_id == 1 for r in found if r.doc_id in (1, 2, 3))


def test_prefixes_depend_on_the_size_of_the_set():
    assert least_similar(3, 0.8) == 1.0 and least_similar(7, 0.8) == 6 / 7 and least_similar(10, 0.8) == 0.8
    depths = depths_by_size(0.8, 0.9995)
    assert depths[0] == [] and depths[1] == [8] and depths[-1] == [6] and len(depths) == LARGE + 1
    assert depths[7] == [8] and depths[11] == [7] and all(own == [6] for own in depths[14:])
    for threshold, target in ((0.8, 0.9995), (0.5, 0.99), (0.9, 0.999)):
        depths = depths_by_size(threshold, target)
        for one in range(1, LARGE):
            for two in range(one, LARGE):
                # Whatever pair of such sizes may be linked meets in time.
                shared = [s for s in range(1, one + 1) if s / (one + two - s) >= threshold]
                if shared:
                    alike = shared[0] / (one + two - shared[0])
                    depth = min(set(depths[one]) & set(depths[two]))
                    least = 1 - (1 - alike**depth) ** TREES
                    assert depth <= DEPTH and (least >= target or depth == 1)
