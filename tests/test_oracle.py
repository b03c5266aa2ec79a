"""Every registered query against its SQL, and the driver contract."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from quotepanel.plans.catalog import ORACLES, QUERIES
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_entry_has_rows_and_columns(spark):
    result = entry(spark)
    assert result.columns == ["result_date", "cur_unit", "rate", "prev_rate", "change_pct", "ma_5"]
    assert result.count() > 0
