"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from spikewatch.config import SurgeConfig

# Runtime settings; all of them can be set on a running session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Upload changes per micro-batch instead of whole state snapshots.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession, cfg: SurgeConfig | None = None) -> SparkSession:
    """Apply the settings above; event times are only right under a UTC session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    if cfg is not None and cfg.parallelism is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(cfg.parallelism))
    return spark


# The folder of the innermost ``scratch`` block.
SCRATCH = "spikewatch.scratch"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A scope for what operators write in between: tables and folders go when it ends.

    Results that read them must be written or collected inside::

        with scratch(spark):
            query(spark).write.parquet(target)
    """
    folder = shared_dir(spark, "scratch")
    outer = spark.conf.get(SCRATCH, None)
    spark.conf.set(SCRATCH, folder)
    try:
        yield folder
    finally:
        if outer is None:
            spark.conf.unset(SCRATCH)
        else:
            spark.conf.set(SCRATCH, outer)
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = at.getFileSystem(spark._jsc.hadoopConfiguration())
        inside = files.makeQualified(at).toUri().getPath() + "/"
        for table in spark.catalog.listTables():
            if table.tableType == "EXTERNAL" and inside in _location(spark, table.name):
                spark.sql(f"DROP TABLE IF EXISTS `{table.name}`")
        files.delete(at, True)


def _location(spark: SparkSession, table: str) -> str:
    told = spark.sql(f"DESCRIBE TABLE EXTENDED `{table}`").filter("col_name = 'Location'").first()
    return told["data_type"] if told else ""


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, visible to every executor.

    A machine-local folder is only used where that setting is absent and the
    session runs in local mode, as in tests.
    """
    root = spark.conf.get(SCRATCH, None) or spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="spikewatch-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
