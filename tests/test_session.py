"""Scopes for what is written in between."""

from pathlib import Path

import pytest

from spikewatch.session import scratch, shared_dir


def test_scratch_leaves_nothing(spark, tmp_path):
    kept = shared_dir(spark, "kept")
    spark.range(3).write.parquet(kept)
    before = {t.name for t in spark.catalog.listTables()}
    with pytest.raises(ZeroDivisionError), scratch(spark) as outer:
        with scratch(spark) as inner:
            assert inner.startswith(outer)
            path = shared_dir(spark, "chunks")
            assert path.startswith(inner)
            spark.range(5).write.option("path", path).saveAsTable("scratch_chunks")
            target = str(tmp_path / "result")
            spark.table("scratch_chunks").write.parquet(target)
        assert {t.name for t in spark.catalog.listTables()} == before
        assert Path(outer).exists() is Path(inner).parent.exists() and not Path(inner).exists()
        spark.range(5).write.parquet(shared_dir(spark, "more"))
        1 / 0
    assert not Path(outer).exists() and spark.read.parquet(target).count() == 5
    assert spark.read.parquet(kept).count() == 3
    assert not shared_dir(spark, "after").startswith(outer)
