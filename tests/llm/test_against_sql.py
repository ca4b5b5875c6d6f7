import pytest

from weft.llm import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_against_sql(name, same):
    same(registry.QUERIES[name], registry.ORACLE_SQL[name])
