"""Every query of the document jobs against its SQL."""

from __future__ import annotations

import pytest

from docsync.jobs import oracles, queries
from tests.conftest import DATA, same_rows

SQL = oracles.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    same_rows(spark, duck, queries.queries()[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert queries.queries()[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
