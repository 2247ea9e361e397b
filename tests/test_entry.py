"""The entry file stands without the training-data queries."""

import sys

import __spark_entry__ as E
from metricfold.plans import catalog


def test_entry_without_training_data_queries(monkeypatch):
    for name in [m for m in sys.modules if m == "metricfold.llm" or m.startswith("metricfold.llm.") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "metricfold.llm", None)  # importing it raises ImportError
    assert set(E.queries()) == set(catalog.queries()) and set(E.oracle_sql()) == set(catalog.oracle_sql())
