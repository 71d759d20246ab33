"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its rows are written as
Parquet and read again as the next stage's ``docs``. All but the last return the columns of
``documents``. A stage judges the rows its predecessor kept, and nothing else.

Null texts are rejected by the quality rules. Rows with the same number and text are copies,
of which the near-duplicate stage keeps one; different texts with the same number are judged
as texts of their own; rows without a number are never dropped as duplicates. An empty table passes through as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spikewatch.llm import jaccard_forest, kneser_ney, packing, quality_rules, substrings
from spikewatch.llm.queries import WORD_BPE, bound_batches, table
from spikewatch.llm.tables import keep

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _with_text(rows: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """The columns of documents, with another column as the text."""
    own = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return rows.select(*(own[c].alias(c) if c in own else F.col(f"`{c}`") for c in columns))


def follow_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that fail or lose too much."""
    judged = quality_rules.judge_documents(docs).filter("quality.kept")
    return _with_text(judged.withColumn("_text", F.col("quality.cleaned")), "_text", docs.columns)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents unlike the trusted ones go."""
    bound_batches(spark)
    judged = kneser_ney.judge_documents(docs, table(spark, sf_dir, "labels"))
    return judged.filter("accepted").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies one row stays: the one with the least number, and of
    different texts with that number the one with the least key."""
    bound_batches(spark)
    numbered = docs.filter("doc_id IS NOT NULL")
    found = jaccard_forest.near_copies(numbered.select("doc_id", "text"), keys=True)
    found = keep(found.select("doc_id", "key", "class_key"), "classes")
    # Rows without words have no class: all numbers stay.
    first = (
        found.filter("key IS NOT NULL")
        .groupBy("class_key")
        .agg(F.min(F.struct("doc_id", "key")).alias("first"))
        .select("first.doc_id", "first.key")
        .union(found.filter("key IS NULL").select("doc_id", "key").distinct())
    )
    key = F.coalesce("key", F.lit(b""))
    shared = found.groupBy("doc_id").agg((F.min(key) < F.max(key)).alias("several"))
    shared = shared.filter("several").select("doc_id")
    alone = first.join(shared, "doc_id", "left_anti").select("doc_id")
    stay = numbered.join(alone, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    # Where a number has several texts, the words decide which row it is.
    texts = numbered.join(shared, "doc_id", "left_semi")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    texts = texts.select("doc_id", row, jaccard_forest.signed(F.col("text")).alias("signed"))
    texts = texts.select("doc_id", F.coalesce("signed.key", F.lit(b"")).alias("key"), "row")
    some = texts.join(first.select("doc_id", key.alias("key")), ["doc_id", "key"], "left_semi")
    some = some.dropDuplicates(["doc_id", "key"]).select("row.*")
    return stay.select(*docs.columns).union(some).union(docs.filter("doc_id IS NULL"))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur more than once go, and documents made of nothing else."""
    bound_batches(spark)
    others = [c for c in docs.columns if c != "text"]
    cut = substrings.remove_repeats(docs, columns=others, spaced=False)
    left = cut.filter("n_removed < n_words OR n_words = 0")
    return _with_text(left, "kept", docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of at most 4096."""
    bound_batches(spark)
    packed = packing.pack(docs, public_tokenizers.path(WORD_BPE))
    return packed.withColumn("ids_crc32", F.crc32("token_ids"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", follow_quality_rules),
    ("quality classifier", classify_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", cut_repeated_passages),
    ("packing", pack_sequences),
]

# Most stages have no counterpart in SQL; the tests compare them with plain models.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
