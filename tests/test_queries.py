"""Every query against its SQL counterpart on the smallest tables, and plan checks."""

import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from spikewatch.config import SurgeConfig
from spikewatch.operators.history import detect_long
from spikewatch.plans.catalog import BY_TYPE, events
from spikewatch.plans.detect import detect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")
SQL = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return con


@pytest.mark.parametrize("name", sorted(entry_point.queries()))
def test_query(spark, duck, name):
    df = entry_point.queries()[name](spark, SF)
    rows = sorted(repr(tuple(r)) for r in df.select(*(f"`{c}`" for c in sorted(df.columns))).collect())
    if name not in SQL:
        assert rows
        return
    result = duck.sql(SQL[name])
    order = sorted(result.columns)
    assert order == sorted(df.columns)
    at = [result.columns.index(c) for c in order]
    assert rows == sorted(repr(tuple(r[i] for i in at)) for r in result.fetchall())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_detection_plan(spark):
    """Two columns read, null filters pushed down, and only pane rows shuffled."""
    text = plan(detect(events(spark, SF), BY_TYPE)).split("== Physical Plan ==")[1]
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text
    assert "IsNotNull(event_type)" in text
    assert text.count("Exchange hashpartitioning") == 2
    assert text.index("partial_count") > text.rindex("Exchange hashpartitioning")


def test_long_history_shuffles_panes_once(spark):
    df = detect_long(events(spark, SF).filter(F.col("value") >= 0), SurgeConfig())
    final = executed(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


def test_zone_report_reduces_before_shuffling(spark):
    """One row per zone leaves a task; the log is neither shuffled whole nor sorted by struct."""
    df = entry_point.queries()["report_zone_status"](spark, SF)
    text = plan(df).split("== Physical Plan ==")[1]
    assert "WindowGroupLimit" in text and "SortAggregate" not in text


def test_no_window_over_all_arrivals(spark):
    """Only chunks of chunks of chunks of arrivals meet in one task."""
    df = entry_point.queries()["arrival_audit"](spark, SF)
    text = plan(df).split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    by_chunk = [line for line in text.splitlines() if "Window" in line and "], [at" in line]
    assert len(by_chunk) >= 3


def test_audit_scans_twice_only(spark):
    """Once for the events, once for the arrivals they are compared with."""
    df = entry_point.queries()["arrival_audit"](spark, SF)
    final = executed(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 2


@pytest.mark.parametrize("missing", ["spikewatch.llm", "a_package_it_needs"])
def test_entry_without_the_optional_queries(missing):
    """The other queries are there whatever the optional subpackage lacks."""
    finder = f"""
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("spikewatch.llm"):
            raise ModuleNotFoundError(name, name={missing!r})
sys.meta_path.insert(0, Gone())
import __spark_entry__
print(sorted(__spark_entry__.queries()) == sorted(__spark_entry__.catalog.QUERIES))
"""
    root = Path(entry_point.__file__).parent
    done = subprocess.run([sys.executable, "-c", finder], cwd=root, capture_output=True, text=True)
    assert done.stdout.strip() == "True", done.stderr
