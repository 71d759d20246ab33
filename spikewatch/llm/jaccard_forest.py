"""Texts whose word shingles overlap, found with a forest of MinHash prefix tries.

Two texts are linked if the sets of their five-word shingles have a Jaccard similarity of
``threshold`` or more. Texts of equal words are one class from the start and are compared
once; a text of fewer than five words has one shingle, all its words.

The signature of a text is one label per tree, ``DEPTH`` levels of eight bits each, every
level from a MinHash function of its own. Sorted, the labels of a tree are a trie, and texts
that share a prefix in any tree are candidates. Prefixes start from whole labels and are
shortened, text by text, until whatever may be linked to the text is met with the target
probability in at least one tree. What may be linked depends on the size of its set: a set of
three shingles has no partner but an equal one, which shares every label; one of seven has no
partner less similar than 6/7. Larger sets have partners closer to the threshold: at 0.8 and
from 14 shingles on the expected recall asks for the shortest prefixes, ``prefix_depth``. A text enters a trie at every depth that a text of a linkable
size has, so that two texts meet at the longer of their two prefixes.

Texts joined by candidates are brought together once, whatever the number of trees that join
them, and every pair among them is verified by the true intersection of shingle sets (64-bit
hashes). Texts brought together are spread in blocks of bounded size, and every pair of blocks
is dealt to the tasks by itself, so that a large group occupies as many tasks as it has pairs.
What leaves a task is a row per text: its number of links and one link that keeps it connected.
Pairs are never written out, and none is lost: the count covers all of them.

Null and empty texts have no shingle: no links, and each row is its own class. Repeated rows
count as copies. Different texts with one number are texts of their own. Texts whose rows have
no number at all take part like others; a class of nothing else has a null ``class_id``. An
empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spikewatch.llm.components import components
from spikewatch.llm.tables import keep
from spikewatch.llm.words import mixed, window_hashes, word_hashes

SHINGLE = 5
TREES = 28
DEPTH = 8
LEVEL_BITS = 8
# Texts and bytes of text in one block.
BLOCK_TEXTS = 1500
BLOCK_BYTES = 6 << 20
# Shingles hashed at once, and shingles that fewer texts share are counted pair by pair.
SLAB = 2048
RARE = 24
FACTORS = np.random.default_rng(20).integers(1, 1 << 32, (TREES * DEPTH, 2), np.uint32) | np.uint32(1)

SIGNED = "key binary, labels array<long>, size int"
# From this size on every set has partners close to the threshold.
LARGE = 64
VERIFIED = "key binary, links long, hub binary"


def prefix_depth(threshold: float, target: float, trees: int = TREES) -> int:
    """Longest prefix at which pairs at the threshold meet with the target probability."""
    depth = DEPTH
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    return depth


def least_similar(size: int, threshold: float) -> float:
    """The smallest similarity, from the threshold on, of a set of ``size`` and any other set."""
    pairs = (
        (both, size + other - both)
        for other in range(1, int(size / threshold) + 2)
        for both in range(1, min(size, other) + 1)
    )
    return min((a / b for a, b in pairs if a / b >= threshold), default=1.0)


def depths_by_size(threshold: float, target: float) -> list[list[int]]:
    """For sets of 0, 1, ... up to ``LARGE`` shingles the depths at which they enter the tries.

    The last entry stands for all larger sets.
    """
    own = [prefix_depth(least_similar(n, threshold), target) for n in range(1, int(LARGE / threshold) + 2)]
    floor = prefix_depth(threshold, target)
    out = [[]]
    for size in range(1, LARGE):
        # Prefixes of linkable sizes; two texts meet at the longer of their prefixes.
        near = range(math.ceil(size * threshold), int(size / threshold) + 1)
        out.append(sorted({max(own[size - 1], own[n - 1]) for n in near if n >= 1}, reverse=True))
    return [*out, [floor]]


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """The set of shingle hashes, rising."""
    if not len(words):
        return words
    return np.unique(window_hashes(words, min(size, len(words))))


def labels(own: np.ndarray) -> np.ndarray:
    """One label per tree, from a set of shingles."""
    low = np.full(len(FACTORS), 0xFFFFFFFF, np.uint32)
    short = (own >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), SLAB):
        values = FACTORS[:, :1] * short[None, at : at + SLAB] ^ FACTORS[:, 1:]
        np.minimum(low, values.min(axis=1), out=low)
    levels = (low * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint64).reshape(TREES, DEPTH)
    shifts = np.arange(DEPTH - 1, -1, -1).astype(np.uint64) * np.uint64(LEVEL_BITS)
    return (levels << shifts).sum(axis=1, dtype=np.uint64).view(np.int64)


def key_of(words: np.ndarray) -> bytes:
    """128 bits that stand for a sequence of words; none for no words."""
    if not len(words):
        return b""
    parts = [window_hashes(words, len(words), n) for n in (0, 1)]
    return mixed(np.concatenate(parts) + np.uint64(len(words))).astype(">u8").tobytes()


def signed(text: Column) -> Column:
    """``key``, ``labels`` and number of shingles of a text column; null without words."""

    @F.arrow_udf(SIGNED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = word_hashes()
        for texts in batches:
            keys, rows, sizes = [], [], []
            for t in texts.cast(pa.binary()).to_pylist():
                words = hashes.of((t or b"").split())
                keys.append(key_of(words) if len(words) else None)
                own = shingles(words)
                rows.append(labels(own) if len(words) else None)
                sizes.append(len(own))
            yield pa.StructArray.from_arrays(
                [
                    pa.array(keys, pa.binary()),
                    pa.array(rows, pa.list_(pa.int64())),
                    pa.array(sizes, pa.int32()),
                ],
                names=["key", "labels", "size"],
            )

    return run(text)


def common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of ``sets[left[i]]`` and ``sets[right[j]]``."""
    lengths = np.array([len(s) for s in sets])
    every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), lengths)
    _, column, uses = np.unique(every, return_inverse=True, return_counts=True)
    order = np.argsort(column, kind="stable")
    shared = order[uses[column[order]] > 1]
    column, owner = column[shared], owner[shared]
    place = np.full(len(sets), -1)
    place[left] = np.arange(len(left))
    across = np.full(len(sets), -1)
    across[right] = np.arange(len(right))
    out = np.zeros(len(left) * len(right), np.int64)
    first = np.flatnonzero(np.r_[True, column[1:] != column[:-1]]) if len(column) else column
    sizes = np.diff(np.r_[first, len(column)])
    # Rare shingles: all pairs of their texts, by distance within the run.
    rare = np.repeat(sizes <= RARE, sizes)
    for step in range(1, min(RARE, int(sizes.max(initial=1)))):
        a = np.flatnonzero(rare[:-step] & (column[step:] == column[:-step]))
        for one, two in ((owner[a], owner[a + step]), (owner[a + step], owner[a])):
            good = (place[one] >= 0) & (across[two] >= 0)
            cell = place[one[good]] * len(right) + across[two[good]]
            out += np.bincount(cell, minlength=len(out))
    out = out.reshape(len(left), len(right))
    # Common shingles: products of slabs of the incidence matrix.
    frequent = np.flatnonzero(sizes > RARE)
    for at in range(0, len(frequent), SLAB):
        own = frequent[at : at + SLAB]
        matrix = np.zeros((len(sets), len(own)), np.float32)
        for n, c in enumerate(own.tolist()):
            matrix[owner[first[c] : first[c] + sizes[c]], n] = 1
        out += (matrix[left] @ matrix[right].T).astype(np.int64)
    return out


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Whether each of ``left`` and each of ``right`` are linked."""
    sizes = np.array([len(s) for s in sets])
    both = common(sets, left, right)
    return both / (sizes[left][:, None] + sizes[right][None, :] - both) >= threshold


def hubs(links: np.ndarray, left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` texts the first text of its connected group."""
    root = np.arange(n)
    while True:
        # Each text takes the least root of those linked to it, then roots are followed.
        big = np.iinfo(np.int64).max
        down = np.where(links, root[right][None, :], big).min(axis=1, initial=big)
        across = np.where(links, root[left][:, None], big).min(axis=0, initial=big)
        new = root.copy()
        np.minimum.at(new, left, down)
        np.minimum.at(new, right, across)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def _candidates(texts: DataFrame, depths: list[list[int]]) -> DataFrame:
    """Links ``a, b`` that join all texts with a common prefix in some tree."""
    by_size = F.array(*(F.array(*map(F.lit, own)).cast("array<int>") for own in depths))
    own = F.element_at(by_size, F.least("size", F.lit(len(depths) - 1)) + 1)
    rows = texts.select("key", own.alias("depths"), F.posexplode("labels").alias("tree", "label"))
    rows = rows.select("key", "tree", "label", F.explode("depths").alias("depth"))
    # A tree's prefixes of one length are a tree of their own.
    prefix = F.expr(f"shiftrightunsigned(label, {LEVEL_BITS} * ({DEPTH} - depth))")
    rows = rows.select((F.col("tree") * (DEPTH + 1) + F.col("depth")).alias("tree"), prefix.alias("label"), "key")
    groups = (
        rows.groupBy("tree", "label")
        .agg(F.count("*").alias("n"), F.min("key").alias("b"))
        .filter("n > 1")
        .drop("n")
    )
    return rows.join(groups, ["tree", "label"]).select(F.col("key").alias("a"), "b").distinct()


def _verified(pairs: DataFrame, threshold: float) -> DataFrame:
    """Links of the texts in each pair of blocks."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        hashes = word_hashes()
        # Another text with the same number may have come along.
        words = [hashes.of((t or "").encode().split()) for t in group["text"]]
        own = [key_of(w) == bytes(k) for w, k in zip(words, group["key"], strict=True)]
        group = group.assign(words=words)[own].drop_duplicates("key").sort_values("key")
        group = group.reset_index(drop=True)
        sets = [shingles(w) for w in group["words"]]
        low, high = int(group["low"].iloc[0]), int(group["high"].iloc[0])
        own = group["block"].to_numpy()
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        links = linked(sets, left, right, threshold)
        if low == high:
            np.fill_diagonal(links, False)
        weight = group["copies"].to_numpy()
        total = np.zeros(len(group), np.int64)
        total[left] += links @ weight[right]
        if low != high:
            total[right] += links.T @ weight[left]
        key = group["key"].to_numpy()
        out = pd.DataFrame(
            {"key": key, "links": total, "hub": key[hubs(links, left, right, len(group))]}
        )
        return out[out["links"] > 0]

    # The join before leaves a group in one partition, and that would satisfy the grouping.
    dealt = pairs.repartition("group", "low", "high")
    return dealt.groupBy("group", "low", "high").applyInPandas(run, VERIFIED)


def near_copies(
    docs: DataFrame,
    threshold: float = 0.8,
    target: float = 0.9995,
    doc_id: str = "doc_id",
    text: str = "text",
    keys: bool = False,
) -> DataFrame:
    """``doc_id, class_id, n_links`` of every row: the least number of its class, and how many
    other rows it is linked to, copies included.

    With ``keys`` also ``key``, which stands for the row's words, and ``class_key``, for its
    class; both null without words. Numbers alone do not tell rows or classes apart where
    different texts bear one number.
    """
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # A text that no number leads back to is kept with its signature.
    lost = F.when(F.col("doc_id").isNull(), F.col("text")).alias("lost")
    rows = keep(
        given.select("doc_id", lost, signed(F.col("text")).alias("signed")).select(
            "doc_id", "lost", "signed.key", "signed.labels", "signed.size"
        ),
        "signatures",
    )
    texts = keep(
        rows.filter("key IS NOT NULL")
        .groupBy("key")
        .agg(
            F.count("*").alias("copies"),
            F.min("doc_id").alias("first"),
            F.min("labels").alias("labels"),
            F.min("size").alias("size"),
            F.min("lost").alias("lost"),
        ),
        "texts",
    )
    groups = components(_candidates(texts, depths_by_size(threshold, target)))
    chosen = groups.select(F.col("node").alias("key"), F.col("component").alias("group")).join(
        texts.drop("labels", "size"), "key"
    )
    numbered = given.join(chosen.drop("lost"), F.col("doc_id") == F.col("first"))
    unnumbered = chosen.filter("first IS NULL").withColumn("text", F.col("lost"))
    brought = keep(
        numbered.select("group", "key", "copies", "text")
        .union(unnumbered.select("group", "key", "copies", "text"))
        .withColumn("size", F.octet_length("text")),
        "brought",
    )
    blocks = brought.groupBy("group").agg(
        F.greatest(
            F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("size") / BLOCK_BYTES)
        ).alias("blocks")
    )
    placed = brought.join(blocks, "group").withColumn(
        "block", F.pmod(F.xxhash64("key"), F.col("blocks"))
    )
    paired = placed.withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    ).select(
        "group",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "block",
        "key",
        "copies",
        "text",
    )
    verified = keep(_verified(paired, threshold), "verified")
    named = components(verified.select(F.col("key").alias("a"), F.col("hub").alias("b")))
    links = verified.groupBy("key").agg(F.sum("links").alias("links"))
    known = (
        texts.select("key", "copies", "first")
        .join(links, "key", "left")
        .join(named.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("component", F.coalesce("component", "key"))
    )
    known = keep(known, "known")
    classes = known.groupBy("component").agg(F.min("first").alias("class_id"))
    known = known.join(classes, "component").select(
        "key", "class_id", F.col("component").alias("class_key"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    worded = rows.filter("key IS NOT NULL").select("doc_id", "key").join(known, "key")
    none = F.lit(None).cast("binary")
    wordless = rows.filter("key IS NULL").select(
        "doc_id",
        F.col("doc_id").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"),
        none.alias("key"),
        none.alias("class_key"),
    )
    shown = ["doc_id", "class_id", "n_links", *(["key", "class_key"] if keys else [])]
    return worded.select(*shown).unionByName(wordless.select(*shown))
