"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from spikewatch.llm.batches import text_sizes
from spikewatch.session import shared_dir

# Chunks a task can number.
CHUNKS = 1 << 33


def keep(df: DataFrame, purpose: str) -> DataFrame:
    """Write the rows to the shared folder and go on from there.

    Later steps then neither recompute what came before nor depend on an executor's disk.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def chunked(docs: DataFrame, size: int, text: str = "text") -> DataFrame:
    """The rows with ``chunk``, the same for neighbours of about ``size`` bytes of text in
    all, and ``place``, their order in it; written to a table bucketed by chunk.

    Steps that group by chunk then read whole chunks without moving texts. The table is
    registered under a name of its own and lives in the shared folder.
    """
    spark, at = docs.sparkSession, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, total, rows = TaskContext.get().partitionId() * CHUNKS, 0, 0
        for batch in batches:
            sizes = text_sizes(batch.column(at)) + 64
            chunk = first + (total + np.cumsum(sizes) - sizes) // size
            place = np.arange(rows, rows + len(chunk))
            total, rows = total + int(sizes.sum()), rows + len(chunk)
            names = [*batch.schema.names, "chunk", "place"]
            columns = [*batch.columns, pa.array(chunk), pa.array(place)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    long = T.LongType()
    own = [T.StructField("chunk", long), T.StructField("place", long)]
    name = f"chunks_{uuid.uuid4().hex}"
    (
        docs.mapInArrow(run, T.StructType([*docs.schema.fields, *own]))
        .write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk")
        .option("path", shared_dir(spark, "chunks"))
        .option("compression", "zstd")
        .saveAsTable(name)
    )
    return spark.table(name)
