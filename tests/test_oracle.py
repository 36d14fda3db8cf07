"""Every registered query against its DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as E
from ledgerline.compare import compare, duck_connect
from ledgerline.oracle import oracle_queries
from ledgerline.plans.catalog import queries
from conftest import SF_SMALL

QUERIES = queries()
ORACLE = oracle_queries()


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


def test_every_query_has_an_oracle_and_is_registered():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_works_without_the_optional_operators(monkeypatch):
    monkeypatch.setattr(E, "_has_llm", lambda: False)
    assert set(E.queries()) == set(QUERIES) and set(E.oracle_sql()) == set(ORACLE)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["ano", "mes", "uf", "total_beneficios", "total_valor_brl", "media_valor_brl"]


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    ok, msg = compare(QUERIES[key](spark, SF_SMALL), con, ORACLE[key])
    assert ok, msg
