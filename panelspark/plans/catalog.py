"""All registered queries and their DuckDB oracles, merged by area."""

from __future__ import annotations

import importlib

AREAS = ["q_holdings", "q_misc", "q_panel", "q_corpus"]


def _load():
    queries, oracle = {}, {}
    for area in AREAS:
        m = importlib.import_module(f"panelspark.plans.{area}")
        for k in m.QUERIES:
            if k in queries:
                raise ValueError(f"duplicate query {k}")
        queries.update(m.QUERIES)
        oracle.update(m.ORACLE)
    return queries, oracle


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
