"""Token counts under a unigram model, by dynamic programming on a trie.

A text's tokens are the pieces of its best segmentation: the largest sum of piece scores
over each pre-token, and of equal sums the one found with the shortest last piece. Scores
follow Zipf's law over the ranks of a public vocabulary, ``-ln(rank + OFFSET)``; nothing is
trained.

A task inserts the distinct pre-tokens it meets into a trie over bytes. The forward score of
a node is the best score of the prefix that leads to it, computed once when the node is
made, from the scores of the nodes above, so words that begin alike share that work. The
token count at a word's last node is its result.

Null and empty texts have no tokens. Rows are independent; nothing is shuffled.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from spikewatch.llm.batches import pieces, text_sizes

# Added to a rank in Zipf's law.
OFFSET = 2.7
# Trie nodes a task keeps. Beyond it the trie starts afresh; results do not change.
MOST_NODES = 500_000


def read_pieces(path: str) -> dict[bytes, float]:
    """Scores of a rank file's pieces."""
    with open(path, "rb") as file:
        pairs = (line.split() for line in file if line.strip())
        return {base64.b64decode(a): -math.log(int(b) + OFFSET) for a, b in pairs}


class Trie:
    """Pre-tokens inserted so far; nodes are numbers, the root is 0."""

    def __init__(self, scores: dict[bytes, float]):
        self.scores = scores
        self.longest = max(map(len, scores))
        self.clear()

    def clear(self) -> None:
        # A node's children hang on its number and the next byte in one table.
        self.child: dict[int, int] = {}
        self.best = [0.0]
        self.tokens = [0]

    def insert(self, word: bytes) -> int:
        """Number of tokens of a word."""
        node, path, child = 0, [0], self.child
        for end, byte in enumerate(word, 1):
            key = node << 8 | byte
            below = child.get(key)
            if below is None:
                below = child[key] = self._extend(word, end, path)
            node = below
            path.append(node)
        return self.tokens[node]

    def _extend(self, word: bytes, end: int, path: list[int]) -> int:
        """Make the node of ``word[:end]``; ``path`` holds the nodes of shorter prefixes."""
        best, tokens = -math.inf, 0
        score, above = self.scores.get, self.best
        for begin in range(end - 1, max(end - self.longest, 0) - 1, -1):
            piece = score(word[begin:end])
            if piece is not None and above[path[begin]] + piece > best:
                best, tokens = above[path[begin]] + piece, self.tokens[path[begin]] + 1
        self.best.append(best)
        self.tokens.append(tokens)
        return len(self.best) - 1


class _Counts(dict):
    """Token counts of the pre-tokens met, by way of the trie."""

    def __init__(self, trie: Trie):
        super().__init__()
        self.trie = trie

    def __missing__(self, word: str) -> int:
        count = self[word] = self.trie.insert(word.encode())
        return count


class Counter:
    def __init__(self, path: str, pattern: str):
        self.trie = Trie(read_pieces(path))
        self.cut = regex.compile(pattern).findall
        self.counts = _Counts(self.trie)

    def count(self, text: str) -> tuple[int, int]:
        """Pre-tokens and tokens of a text."""
        if len(self.trie.best) > MOST_NODES:
            self.trie.clear()
            self.counts.clear()
        words = self.cut(text)
        return len(words), sum(map(self.counts.__getitem__, words))


@lru_cache(maxsize=2)
def counter(path: str, pattern: str) -> Counter:
    return Counter(path, pattern)


def token_counts(text: Column, path: str, pattern: str) -> Column:
    """``n_pretokens`` and ``n_tokens`` of a text column as a struct."""

    @F.arrow_udf("n_pretokens long, n_tokens long")
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = counter(path, pattern)
        for texts in batches:
            rows = []
            for a, b in pieces(text_sizes(texts)):
                rows += [own.count(t or "") for t in texts[a:b].to_pylist()]
            both = np.array(rows, np.int64).reshape(-1, 2)
            yield pa.StructArray.from_arrays(
                [pa.array(both[:, 0]), pa.array(both[:, 1])], names=["n_pretokens", "n_tokens"]
            )

    return counts(text)
