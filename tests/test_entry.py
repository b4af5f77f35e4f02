"""The driver contract with and without the training-data subpackage."""

import importlib.util

import pytest

import __spark_entry__ as entry


def test_entry_without_the_subpackage(monkeypatch):
    find = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name in ("marquee.llm", "corpus_pipeline") else find(name, *a))
    assert not [k for k in entry.queries() if k.startswith("op") and k[2:3].isdigit()] and "pipeline" not in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_survives_a_broken_subpackage(monkeypatch):
    import builtins

    real = builtins.__import__

    def broken(name, *a, **b):
        if name == "corpus_pipeline":
            raise ImportError("broken")
        return real(name, *a, **b)
    monkeypatch.setattr(builtins, "__import__", broken)
    with pytest.warns(UserWarning, match="broken"):
        assert len(entry.queries()) > 250
