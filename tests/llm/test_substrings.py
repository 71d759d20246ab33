"""Removal of repeated passages against a direct count of windows."""

import re
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

from spikewatch.llm.substrings import remove_repeats
from spikewatch.session import scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(texts, window=35):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(
        tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1)
    )
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def texts_of(prose):
    shared = prose(1, 60)
    short, exact = prose(2, 34), prose(3, 35)
    return [
        None,
        "",
        " \n ",
        prose(4, 200),
        prose(5, 40) + " " + shared + " " + prose(6, 50),
        prose(7, 13) + "\n" + shared + "\x0b" + prose(8, 5),
        prose(9, 30) + " " + short + " " + prose(10, 30),
        prose(11, 31) + " " + short + " " + prose(12, 30),
        prose(13, 17) + " " + exact + " end",
        exact,
        # Repeats within one text, and of one word.
        prose(14, 50) + " " + prose(14, 50),
        "again " * 90,
        prose(15, 400),
        prose(15, 400),
        # White space other than ASCII's belongs to words.
        shared.replace(" ", " "),
    ]


def test_against_counted_windows(make_docs, prose):
    texts = texts_of(prose)
    docs = make_docs(list(enumerate(texts))).repartition(3)
    rows = remove_repeats(docs).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_removed, r.kept) for r in rows] == plain(texts)
    assert {r.c0 for r in rows} == {7} and {r.chunk for r in rows} == {"x"}


def test_other_sizes_and_many_small_chunks(make_docs, prose, monkeypatch):
    monkeypatch.setattr("spikewatch.llm.substrings.CHUNK_BYTES", 300)
    texts = texts_of(prose)
    rows = remove_repeats(make_docs(list(enumerate(texts))), window=11, block=4).orderBy("doc_id")
    assert [(r.n_words, r.n_removed, r.kept) for r in rows.collect()] == plain(texts, 11)


def test_untouched_text_stays_as_it_is(make_docs, prose):
    shared = prose(1, 40)
    texts = ["one  two\n\n three ", f"keep\tthis {shared}  and that\n", f"x {shared}"]
    rows = remove_repeats(make_docs(list(enumerate(texts))), spaced=False).orderBy("doc_id")
    assert [r.kept for r in rows.collect()] == [texts[0], "keep\tthis\nand that\n", "x"]


def test_empty_table(make_docs):
    assert remove_repeats(make_docs([])).select(F.count("*")).first()[0] == 0


def test_nothing_is_left_of_a_scope(spark, make_docs, prose):
    before = {t.name for t in spark.catalog.listTables()}
    with scratch(spark) as folder:
        assert remove_repeats(make_docs([(1, prose(1, 60)), (2, prose(1, 60))])).count() == 2
        assert {t.name for t in spark.catalog.listTables()} > before
    assert {t.name for t in spark.catalog.listTables()} == before and not Path(folder).exists()
