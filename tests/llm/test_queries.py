"""Registered queries against their SQL, over whole small tables."""

from __future__ import annotations

import inspect

import duckdb
import pytest

import __spark_entry__ as entry
from ledgersieve.llm import chat, pii, queries, winnow

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = entry.queries()
    assert set(queries.queries()) | {"pipeline"} <= set(names)
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in names)] == []


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equal_to_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = connection.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    found = queries.queries()[name](spark, SF).select(*columns).collect()
    assert sorted(map(tuple, found)) == sorted(expected.fetchall())


@pytest.mark.parametrize("module", [winnow, chat, pii])
def test_native_operators_have_no_python_in_tasks(module):
    source = inspect.getsource(module)
    for word in ("mapIn", "applyIn", "udf", "rdd", "toPandas", "numpy", "pyarrow", "createDataFrame"):
        assert word not in source, word
