"""The contract without the separate subpackage, or without what it needs."""

import sys

import __spark_entry__ as contract


def without(monkeypatch, *modules):
    for name in list(sys.modules):
        if name.startswith("relaydesk.llm") or name == "corpus_pipeline":
            monkeypatch.delitem(sys.modules, name)
    import relaydesk

    monkeypatch.delattr(relaydesk, "llm", raising=False)
    for name in modules:
        monkeypatch.setitem(sys.modules, name, None)  # importing it fails
    return set(contract.queries()), set(contract.oracle_sql())


def test_a_missing_dependency_loses_no_other_query(monkeypatch):
    for missing in ("ahocorasick", "relaydesk.llm"):
        with monkeypatch.context() as patch:
            queries, sql = without(patch, missing)
        assert "triage" in queries and "triage" in sql
        assert not any(name.startswith("op") and name[2].isdigit() or name == "pipeline" for name in queries)


def test_sql_belongs_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())
