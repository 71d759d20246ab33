"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spikewatch.llm import (
    bpe,
    host_reputation,
    jaccard_forest,
    kneser_ney,
    language,
    oracle,
    packing,
    periodic_runs,
    posting_lists,
    quality_rules,
    substrings,
    token_counts,
    toxicity,
    vector_codes,
)

Query = Callable[[SparkSession, str], DataFrame]

WORD_BPE = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"
URL_RULES = [
    host_reputation.rule("allow", "com/"),
    host_reputation.rule("block", "example.com/en/"),
    host_reputation.rule("allow", "www.example.com/en/"),
    host_reputation.rule("block", "net/es/"),
    host_reputation.rule("block", "net/fr/"),
]


def bound_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of bounded size, however long they are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document and decode it again."""
    path = public_tokenizers.path(WORD_BPE)
    docs = table(spark, sf_dir, "documents")
    coded = docs.select("doc_id", bpe.encode_decode(F.col("text"), path).alias("coded"))
    return coded.select(
        "doc_id",
        bpe.token_total(F.col("coded.ids")).alias("n_tokens"),
        F.sha2("coded.ids", 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"),
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-tokens and unigram tokens of every document."""
    path = public_tokenizers.path(BYTE_RANKS)
    counts = token_counts.token_counts(F.col("text"), path, public_tokenizers.PATTERN)
    docs = table(spark, sf_dir, "documents").select("doc_id", counts.alias("counts"))
    return docs.select("doc_id", "counts.n_pretokens", "counts.n_tokens")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words that lie in repeated 35-word windows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the quality rules for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules.judge_documents(docs)
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept n_lost_words"
    return judged.select("doc_id", *(f"quality.{name}" for name in names.split()))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of every document under a model of the trusted ones."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    given = docs.select("doc_id", "text", "lang")
    judged = kneser_ney.judge_documents(given, labels, ["doc_id", "lang"])
    return judged.withColumnRenamed("accepted", "kept")


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest found to every fiftieth vector."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return posting_lists.neighbours(rows, F.col("vec_id") % 50 == 0)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of at most 4096 tokens."""
    path = public_tokenizers.path(WORD_BPE)
    packed = packing.pack(table(spark, sf_dir, "documents"), path)
    return packed.select(
        "doc_id",
        "start",
        "length",
        F.crc32("token_ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of rules and host reputation for every page."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    judged = host_reputation.judge_urls(pages, labels, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document at a similarity of 0.8 or more."""
    return jaccard_forest.near_copies(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from three quarters of them.

    A row without a number is predicted, not learned from, and its ``held_out`` is null.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = language.fit(docs.filter(~held_out))
    found = docs.select(
        "doc_id", held_out.alias("held_out"), language.predict(F.col("text"), model).alias("found")
    )
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector, with the error of all that share its label."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    codes, books = vector_codes.compress(rows)
    digest = F.lit("" if books is None else books.digest())
    return codes.select(
        "vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256")
    )


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from four fifths of the labels.

    A row without a number is scored, not learned from, and its ``held_out`` is null.
    """
    number = F.col("doc_id").cast("string").cast("binary")
    held_out = F.crc32(number) % 5 == 0
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs.filter(~held_out), labels.filter(~held_out))
    found = docs.select(
        "doc_id", held_out.alias("held_out"), toxicity.toxicity(F.col("text"), model).alias("found")
    )
    return found.select("doc_id", "held_out", "found.score", "found.predicted")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, some documents being given a repeating tail."""
    docs = table(spark, sf_dir, "documents")
    text = periodic_runs.with_repeating_tails(F.col("text"), F.col("doc_id"))
    found = docs.select("doc_id", periodic_runs.find_runs(text).alias("found"))
    rows = found.select("doc_id", "found.runs", "found.collapsed")
    longest = F.array_min(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"]))
    )
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return rows.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        (-F.col("longest.less")).alias("length"),
        F.col("longest.period").alias("period"),
        F.expr("(1000 * -longest.less) div longest.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_bpe": op1_bpe,
    "op2_token_counts": op2_token_counts,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_nearest": op6_nearest,
    "op7_packing": op7_packing,
    "op8_url_filter": op8_url_filter,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_language": op10_language,
    "op11_vector_codes": op11_vector_codes,
    "op12_toxicity": op12_toxicity,
    "op13_periodic_runs": op13_periodic_runs,
}

# Token ids, language models, packing and approximate search are beyond SQL; the tests compare
# them with plain models.
SQL: dict[str, str] = {
    "op3_substring_dedup": oracle.SUBSTRINGS,
    "op4_quality_rules": oracle.QUALITY,
    "op8_url_filter": oracle.urls(URL_RULES),
    "op9_jaccard_join": oracle.JACCARD,
    "op11_vector_codes": oracle.vector_codes(),
}
