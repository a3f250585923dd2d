"""Every named query against its DuckDB text on the smallest data set."""

from __future__ import annotations

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.compare import compare


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, folder, name):
    if name == "error_count_alert":
        folder = "/root/testdata/sf0.01"  # the smallest data set has no such window
    assert compare(spark, folder, name, queries()[name], oracle_sql().get(name)) is None


def test_every_check_has_a_query():
    assert set(oracle_sql()) <= set(queries())
