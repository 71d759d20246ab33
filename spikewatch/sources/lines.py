"""Newline-delimited text, bounded or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spikewatch.functions.jsontext import not_blank
from spikewatch.sources import growing


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines of text files, column ``value``."""
    return spark.read.text(path).filter(not_blank(F.col("value")))


def stream_lines(spark: SparkSession, fmt: str = "text", **options: str) -> DataFrame:
    """Non-blank lines of a stream, column ``value``.

    ``fmt`` is any streaming source: ``text`` (with ``path``; takes each file once),
    ``growing_lines`` (with ``path``; files that grow by appending), ``kafka`` (its message
    value is decoded) or, for a demonstration, ``socket`` with ``host`` and ``port``.
    """
    if fmt == growing.NAME:
        spark.dataSource.register(growing.GrowingLines)
    if fmt == "socket" and int(options.get("port", 0)) <= 0:
        raise ValueError("port must be positive")
    source = spark.readStream.format(fmt).options(**options).load()
    return source.select(F.col("value").cast("string").alias("value")).filter(
        not_blank(F.col("value"))
    )
