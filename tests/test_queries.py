"""Every registered query against its SQL, and the shape of its plan."""

import os

import pytest

from everkey.catalog import full_catalog
import oracle

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
CATALOG = full_catalog()
# Nothing pairs all rows with all rows, and no row leaves the JVM.
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"]


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")
@pytest.mark.parametrize("name", CATALOG.queries)
def test_query(spark, con, name):
    df = CATALOG.queries[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [node for node in UNWANTED if node in plan] == []
    if name in CATALOG.sql:
        assert oracle.compare(df, con, CATALOG.sql[name])[1] is None
    else:
        assert df.count() > 0


def test_no_query_goes_without_sql():
    assert set(CATALOG.queries) == set(CATALOG.sql)
