"""All queries of the engine's own operators, with the SQL they are held against."""

from __future__ import annotations

from weft.plans import files, graph, ledgers, overlaps, relational, review, rules, senses, texts, views

_MODULES = (relational, graph, texts, review, rules, views, ledgers, files, overlaps, senses)
QUERIES = {name: q for m in _MODULES for name, q in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in _MODULES for name, sql in m.ORACLE_SQL.items()}


def entry(spark, sf_dir):
    return QUERIES["cousin_inference"](spark, sf_dir)
