"""The driver contract in __spark_entry__.py."""

import __spark_entry__ as entry_module
from dealspark.plans.registry import registry


def test_entry_runs_the_flagship_query(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert {"deal_id", "team_id", "roster_team_id", "agent_split", "company_split", "ending_year"} <= set(df.columns)


def test_queries_and_oracle_sql():
    q, o = entry_module.queries(), entry_module.oracle_sql()
    own = set(registry())
    assert own <= set(q) and own <= set(o) <= set(q) and len(own) >= 35
    assert all(callable(f) for f in q.values()) and all(isinstance(s, str) and s.strip() for s in o.values())


def test_optional_queries_may_be_absent(monkeypatch):
    import sys
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("dealspark.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "dealspark.llm", None)  # importing it now fails
    assert set(entry_module.queries()) == set(registry()) == set(entry_module.oracle_sql())
