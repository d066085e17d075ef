"""The driver's entry with and without the corpus operators."""

import sys

import __spark_entry__ as entry
from tickweave import catalog_queries, file_queries, storage_queries

MODULES = (catalog_queries, file_queries, storage_queries)
CAPTURE = {name for m in MODULES for name in m.QUERIES}


def test_capture_queries_need_no_corpus_operators(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert set(entry.queries()) == set(entry.oracle_sql()) == CAPTURE


def test_names_are_told_apart():
    assert CAPTURE <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert len(CAPTURE) == sum(len(m.QUERIES) for m in MODULES)
