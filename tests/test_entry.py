"""The entry module with and without the training-data operators."""

import sys

import __spark_entry__ as entry


def test_queries_without_what_the_operators_need(monkeypatch):
    core = {name for name, query in entry.queries().items() if ".llm" not in query.__module__ and query.__module__ != "corpus_pipeline"}
    assert len(core) >= 95
    for name in [m for m in sys.modules if m.startswith("everkey.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "xxhash", None)
    assert set(entry.queries()) == core and set(entry.oracle_sql()) == core
