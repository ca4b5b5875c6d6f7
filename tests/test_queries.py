import pytest

from weft import registry


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_against_sql(name, same):
    same(registry.QUERIES[name], registry.ORACLE_SQL[name])


def test_entry_has_rows(spark, sf_dir):
    assert registry.entry(spark, sf_dir).count() > 0
