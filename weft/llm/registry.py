"""Queries and SQL of this subpackage."""

from . import bpe, chosen_path, decontamination, filter_audit, katz, ordinal, pii, quality_rules, sharding, token_files, toxicity, url_filters, variants

_MODULES = (bpe, chosen_path, decontamination, filter_audit, katz, ordinal, pii, quality_rules, sharding, token_files, toxicity, url_filters, variants)

QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in _MODULES for name, sql in m.ORACLE_SQL.items()}
