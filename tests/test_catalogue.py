"""Every registered query against its SQL, and the rules every plan must keep."""

import re

import pytest
from compare import compare, connect
from pyspark.sql.readwriter import DataFrameWriter

from __spark_entry__ import entry
from tallyloom.plans.catalogue import QUERIES
from tallyloom.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_entry(spark):
    assert entry(spark).count() == 6


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, con, name, monkeypatch):
    """The result equals the SQL; no plan, of the result or of a table written on the way, has a cross join or leaves the JVM."""
    plans, write = [], DataFrameWriter.parquet

    def watched(writer, *args, **options):
        plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
        return write(writer, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    df = QUERIES[name](spark, folder)
    for plan in [*plans, df._jdf.queryExecution().executedPlan().toString()]:
        for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
            assert banned not in plan, banned
    assert compare(df, con, ORACLES[name]) is None


def test_scans_read_only_used_columns(spark, folder):
    plan = QUERIES["site_domain_matrix"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and all(set(c.split(":")[0] for c in s.split(",")) == {"l_orderkey", "l_suppkey", "l_returnflag"} for s in lineitem)


def test_filters_reach_the_scan(spark, folder):
    plan = QUERIES["headline_counts"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(o_totalprice,490000", plan)
