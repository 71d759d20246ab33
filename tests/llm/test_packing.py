"""Packing: a round trip, and cuts against a slow search for the best ones."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from spikewatch.llm import packing
from spikewatch.llm.packing import allowed_cuts, best_cuts, divide, is_power, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


def padding(length, size):
    return 0 if is_power(length) else size - length


def slow_cost(at, penalty, size):
    best = [0]
    for end in range(1, len(at)):
        best.append(
            penalty[end]
            + min(
                best[begin] + padding(at[end] - at[begin], size)
                for begin in range(end)
                if at[end] - at[begin] <= size
            )
        )
    return best[-1]


@pytest.mark.parametrize("seed", range(30))
def test_cuts_cost_least(seed):
    rng = random.Random(seed)
    size = rng.choice([8, 16, 64])
    ends = np.cumsum([rng.randrange(1, 2 * size) for _ in range(rng.randrange(1, 12))])
    inside = sorted(rng.sample(range(1, ends[-1] + 1), min(int(ends[-1]), rng.randrange(0, 25))))
    at, penalty = allowed_cuts(ends, np.array(inside, np.int64), size)
    assert np.diff(at).max() <= size
    cuts = best_cuts(at, penalty, size)
    cost_of = dict(zip(at.tolist(), penalty.tolist(), strict=True))
    lengths = np.diff([0, *cuts]).tolist()
    assert cuts[-1] == ends[-1] and max(lengths) <= size
    cost = sum(cost_of[c] for c in cuts) + sum(padding(n, size) for n in lengths)
    assert cost == slow_cost(at.tolist(), penalty.tolist(), size)


def test_divide_at_powers_of_two():
    assert divide([4096, 4096 + 3000], 4096) == [4096, 6144, 6656, 6912, 7040, 7072, 7088, 7096]
    assert divide([4095], 4096) == [4095]
    assert divide([1024], 4096) == [1024]


def pieces_of(docs, size):
    return pack(docs, PATH, size=size).orderBy("sequence_id", "offset").collect()


@pytest.mark.parametrize("horizon", [96, 8])
def test_round_trip(make_docs, prose, monkeypatch, horizon):
    monkeypatch.setattr(packing, "HORIZON", horizon)
    rng = random.Random(4)
    texts = [None, "", " \n", "<|endoftext|>", prose(1, 3000)]
    for n in range(60):
        sentences = [prose(n * 50 + i, rng.randrange(1, 12)) + "." for i in range(rng.randrange(1, 9))]
        texts.append(" ".join(sentences))
    texts.append(texts[7])
    library = Tokenizer.from_file(PATH)
    library.no_truncation()
    library.no_padding()
    want = {n: library.encode(t or "", add_special_tokens=False).ids + [2] for n, t in enumerate(texts)}
    rows = pieces_of(make_docs(list(enumerate(texts))).repartition(3, "doc_id"), 128)
    got, places = {}, {}
    for r in rows:
        ids = np.frombuffer(r.token_ids, "<u4").tolist()
        assert len(ids) == r.length > 0 and r.doc_tokens == len(want[r.doc_id])
        got.setdefault(r.doc_id, {})[r.start] = ids
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for n, ids in want.items():
        parts = [got[n][start] for start in sorted(got[n])]
        assert sorted(got[n]) == np.r_[0, np.cumsum([len(p) for p in parts])][:-1].tolist()
        assert sum(parts, []) == ids
    waste = total = 0
    for own in places.values():
        at = 0
        for offset, length in own:
            assert offset == at
            at += length
        assert at <= 128
        waste, total = waste + padding(at, 128), total + at
    assert waste < 0.08 * total


def test_order_and_empty_table(make_docs, prose):
    docs = make_docs([(n, prose(n, 20) + ".") for n in range(30)]).coalesce(1)
    assert [r.doc_id for r in pieces_of(docs, 64) if r.start == 0] == list(range(30))
    assert pieces_of(make_docs([]), 64) == []
