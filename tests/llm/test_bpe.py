"""Coding against the tokenizers library, and the edge cases of a column."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spikewatch.llm import bpe, queries, token_counts
from spikewatch.llm.batches import offsets_of, pieces

PATH = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

ODD = [
    "",
    " \n\t ",
    "aaaaaaaaaaaaa aaa aa a",
    "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|><|endoftext|>",
    "İstanbul ΑΣ Σ's it's IT'S x'll\x1cq\x85w　z",
    "é é Ᲊ Ɤ 中文 123 ½ 😀😀 \x00a\x1f <| |>",
    "x" * 5000,
    "ab" * 3000 + "!" * 100,
    "!!! ??? ... '' 's 't",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def ids_of(encoder, texts):
    flat, lengths, _ = encoder.encode(texts)
    at = offsets_of(lengths)
    return [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]


def expected(library, texts):
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_odd_texts(library):
    assert ids_of(bpe.Encoder(PATH), ODD) == expected(library, ODD)


def test_random_texts(library):
    rng = random.Random(3)
    some = [*range(32, 127), *range(0xA0, 0x250), 0x301, 0x4E2D, 0x1F600, 0x3A3, 0x85, 0x2028]
    texts = ["".join(chr(rng.choice(some)) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += ["".join(chr(rng.randrange(1, 0xD800)) for _ in range(40)) for _ in range(300)]
    assert ids_of(bpe.Encoder(PATH), texts) == expected(library, texts)


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_CHUNKS", 20)
    encoder = bpe.Encoder(PATH)
    texts = [f"word{n} other{n % 7} thing" for n in range(60)]
    got = [row for a, b in pieces(np.ones(60), 10) for row in ids_of(encoder, texts[a:b])]
    assert got == expected(library, texts)


def test_columns(make_docs, library):
    docs = make_docs([(n, t) for n, t in enumerate([*ODD, None, ODD[3]])])
    coded = docs.select("doc_id", "text", bpe.encode(F.col("text"), PATH).alias("ids"))
    rows = coded.select(
        "*", bpe.decode(F.col("ids"), PATH).alias("back"), bpe.token_total(F.col("ids")).alias("n")
    ).collect()
    assert len(rows) == len(ODD) + 2
    for row in rows:
        ids = expected(library, [row.text or ""])[0]
        assert np.frombuffer(row.ids, "<u4").tolist() == ids
        assert row.n == len(ids) and row.back == library.decode(ids, skip_special_tokens=False)


def test_empty_table(make_docs):
    docs = make_docs([])
    assert docs.select(bpe.encode(F.col("text"), PATH)).collect() == []
    assert docs.select(bpe.encode_decode(F.col("text"), PATH)).collect() == []


def test_query_codes_in_one_worker(spark, make_docs, library, tmp_path):
    texts = [*ODD, None, ODD[3]]
    docs = make_docs([*enumerate(texts), (None, ODD[4]), (0, ODD[0])])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op1_bpe(spark, str(tmp_path))
    # Two Python workers a task, one fed from the other, once stood still for minutes.
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EvalPython") == 1
    assert plan.count("both(text") == 1

    def row(doc_id, text):
        ids = expected(library, [text or ""])[0]
        back = library.decode(ids, skip_special_tokens=False).encode()
        packed = np.array(ids, "<u4").tobytes()
        sums = (hashlib.sha256(part).hexdigest() for part in (packed, back))
        return (doc_id, len(ids), *sums)

    rows = [row(n, t) for n, t in [*enumerate(texts), (None, ODD[4]), (0, ODD[0])]]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)


def best_segmentation(scores, word):
    """Tokens of the best segmentation, by plain dynamic programming."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = []
        for begin in range(end - 1, -1, -1):
            if word[begin:end] in scores:
                options.append((best[begin][0] + scores[word[begin:end]], best[begin][1] + 1))
        top = max(score for score, _ in options)
        best.append(next(o for o in options if o[0] == top))
    return best[-1][1]


def test_unigram_counts(make_docs, prose):
    scores = token_counts.read_pieces(RANKS)
    counter = token_counts.Counter(RANKS, public_tokenizers.PATTERN)
    texts = ["", "the theme then they", prose(1, 60), "ααβγ 中文😀 12345", "x" * 300, "\n\n  a\t"]
    for text in texts:
        words = counter.cut(text)
        expected_total = sum(best_segmentation(scores, w.encode()) for w in words)
        assert counter.count(text) == (len(words), expected_total)
    docs = make_docs(list(enumerate([*texts, None, texts[1]])))
    column = token_counts.token_counts(F.col("text"), RANKS, public_tokenizers.PATTERN)
    rows = docs.select("text", column.alias("c")).collect()
    assert [tuple(r.c) for r in rows] == [counter.count(r.text or "") for r in rows]
    assert make_docs([]).select(column).collect() == []


def test_trie_shares_prefixes():
    trie = token_counts.Trie({bytes([b]): -1.0 for b in range(256)} | {b"ab": -1.0, b"abc": -1.5})
    assert [trie.insert(w) for w in (b"abc", b"abd", b"ab", b"abc", b"")] == [1, 2, 1, 1, 0]
    # One node for each distinct prefix: the empty one, a, ab, abc, abd.
    assert len(trie.best) == 5
