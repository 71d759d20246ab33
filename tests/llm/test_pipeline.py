"""The pipeline's stages on a small table with planted cases, and on an empty one."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from test_jaccard_forest import edited
from test_substrings import plain

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    def run(rows, labels):
        top = tmp_path_factory.mktemp("tables")
        data = [(i, t, "en", "s", len(t or "")) for i, t in rows]
        spark.createDataFrame(data, SCHEMA).write.parquet(f"{top}/documents.parquet")
        marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        marks.write.parquet(f"{top}/labels.parquet")
        out, docs = [], spark.read.parquet(f"{top}/documents.parquet")
        for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, str(top)).write.parquet(f"{top}/{n}")
            docs = spark.read.parquet(f"{top}/{n}")
            out.append(docs)
        return str(top), out

    return run


def test_planted_cases(run, prose, spark):
    rng = random.Random(1)
    vocabulary = prose(1, 400).split()
    good = [" ".join(rng.choice(vocabulary) for _ in range(90)) + "." for _ in range(61)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(55)) + "."
    rows = list(enumerate(good))
    junk = {
        100: None,
        101: "",
        102: "too short.",
        103: " | ".join(good[1].split()),
        104: "!! ".join(good[2].upper().split()),
    }
    copies = {200: good[5], 201: edited(good[6], rng, 1)}
    shared = {300: good[7] + "\n" + passage, 301: good[8] + "\n" + passage}
    rows += [*junk.items(), *copies.items(), *shared.items(), (9, good[9])]
    rows = [(i, t) for i, t in rows if i not in (7, 8)]
    top, out = run(rows, [(n, 1, 0) for n in range(50)])
    assert all(docs.columns == COLUMNS for docs in out[:-1])
    left = [{r.doc_id: r.text for r in docs.collect()} for docs in out[:-1]]
    clean = set(range(61)) - {7, 8}
    assert not left[0].keys() & junk.keys()
    assert clean <= left[0].keys() and len(clean - left[1].keys()) <= 1
    # One of each group of copies, of repeated rows too.
    assert not left[2].keys() & copies.keys() and left[1].keys() - copies.keys() == left[2].keys()
    assert out[2].filter("doc_id = 9").count() == 1
    # Passages found twice are gone, and only they.
    before, after = left[2], left[3]
    assert after[300] == before[300].split("\n")[0] and after[301] == before[301].split("\n")[0]
    removed = dict(zip(before, plain(before.values()), strict=True))
    assert {i for i, (n, gone, _) in removed.items() if gone < n} == after.keys()
    for i, text in after.items():
        assert text.split() == removed[i][2].split()
        assert text == before[i] or removed[i][1]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    tokens = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in after.items()}
    packed = out[-1].groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in packed} == tokens
    assert corpus_pipeline.run(spark, top).count() == out[-1].count()


def test_empty_table(run):
    _, out = run([], [])
    assert [docs.count() for docs in out] == [0] * 5


def test_rows_without_a_number_stay(run, prose):
    text = "\n".join(prose(n, 40) + "." for n in range(2))
    _, out = run([(None, text), (None, text), (1, text)], [])
    assert out[2].count() == 3


def test_no_class_is_lost_where_texts_share_a_number(spark, prose):
    rng = random.Random(6)
    a, b, c = prose(1, 100), prose(2, 100), prose(3, 100)
    rows = [(1, a), (1, b), (1, b), (2, edited(a, rng, 1)), (3, edited(b, rng, 1)), (4, c), (4, c), (None, a)]
    data = [(i, t, "en", "s", len(t), n, "x", "y") for n, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame(data, SCHEMA + ", key long, row string, signed string")
    left = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert left.columns == docs.columns
    kept = sorted((r.doc_id or 0, r.text) for r in left.collect())
    assert kept == sorted([(1, a), (1, b), (4, c), (0, a)])
