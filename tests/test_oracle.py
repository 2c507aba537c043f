"""Every registered query against its SQL, with the normal (compiled) execution."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from ledgersieve.plans import registry
from oracle import catalog

SF_DIR = "/root/testdata/sf0.001"
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def compiled(spark):
    keys = {"spark.sql.codegen.wholeStage": "true", "spark.sql.codegen.factoryMode": "FALLBACK"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def test_every_query_has_sql():
    assert sorted(registry.queries()) == sorted(SQL)
    assert set(SQL) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal(compiled, name):
    ok, note = compare(compiled, connect(SF_DIR), name, entry.queries()[name], SQL[name], SF_DIR)
    assert ok, note


def test_entry(compiled):
    assert entry.entry(compiled).count() > 0
