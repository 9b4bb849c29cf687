"""All registered queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

from importlib import import_module

from kerbside.session import configure

MODULES = ("trips", "ingest", "models", "operations", "messages", "live")


def _modules():
    return [import_module(f"kerbside.catalog.{name}") for name in MODULES]


def _configured(query):
    def run(spark, folder):
        return query(configure(spark), folder)

    return run


def queries():
    return {name: _configured(query) for m in _modules() for name, query in m.QUERIES.items()}


def oracles():
    return {name: sql for m in _modules() for name, sql in m.ORACLES.items()}
