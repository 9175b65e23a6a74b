"""Every registered query of the subpackage against its SQL."""

import os

import pytest

from everkey.llm.queries import catalog
import oracle

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
#: Operators that must stay in the JVM.
NATIVE = ["op1_pseudonyms", "op4_mix", "op9_url_filter", "op10_licenses"]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")
@pytest.mark.parametrize("name", catalog.queries)
def test_query(spark, name):
    df = catalog.queries[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in NATIVE:
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    if name in catalog.sql:
        assert oracle.compare(df, oracle.connect(SF_DIR), catalog.sql[name])[1] is None
    else:
        assert df.count() > 0


def test_pipeline(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert rows and all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in rows)
    assert len(corpus_pipeline.STAGES) == 5
