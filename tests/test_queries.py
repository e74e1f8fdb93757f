"""Every registered query with SQL against DuckDB on the same tables."""

import pytest
from conftest import DATA, same_rows

from countloom.plans.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(name, spark, duck):
    same_rows(QUERIES[name](spark, DATA), duck.sql(ORACLES[name]).df())
