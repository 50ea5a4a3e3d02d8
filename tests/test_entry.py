import __spark_entry__ as entry


def test_queries_and_sql_fit_together():
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q) and "answer_frequency_top" in q


def test_rest_works_without_the_subpackage(monkeypatch):
    import sys

    for m in [m for m in sys.modules if m.startswith("grainmill.llm")]:
        monkeypatch.delitem(sys.modules, m)
    monkeypatch.setitem(sys.modules, "grainmill.llm", None)
    assert "answer_frequency_top" in entry.queries() and not any(k[:2] in ("p1", "p5") for k in entry.queries())
