"""Every registered query: same rows as its SQL on the smallest tables, and a plan fit for large ones."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from placeweave.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are absent")


def _compare_tool():
    import importlib.util
    path = Path(__file__).resolve().parents[1] / "tools" / "compare.py"
    spec = importlib.util.spec_from_file_location("compare_tool", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


@pytest.fixture(scope="module")
def tool():
    return _compare_tool()


@pytest.fixture(scope="module")
def connection(tool):
    con = duckdb.connect()
    for name in tool.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tool, connection, name):
    verdict, _, df = tool.compare(spark, connection, name, SF_DIR)
    assert verdict.startswith("ok"), verdict
    plan = df._jdf.queryExecution().toString()
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert banned not in plan, banned
    for window in windows_over_everything(plan):
        # One row per file or per partition is numbered in one task: the listing is all there is.
        assert "__file" in window or "__part" in window, window


def windows_over_everything(plan):
    """Window operators that gather their input in one partition (window, sort, exchange)."""
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            yield from (above for above in lines[max(0, i - 2):i] if " Window [" in above)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_contract(spark):
    assert contract.entry(spark).count() > 0
    # Optional queries may go without SQL where it cannot express them.
    assert set(QUERIES) <= contract.oracle_sql().keys() <= contract.queries().keys()
