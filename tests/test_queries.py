"""Every query with SQL agrees with DuckDB; the others give rows."""

import pytest
from compare import connect, difference

from driftwarden.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
# Whole training jobs; run by tests/compare.py and covered in smaller pieces by test_models.py.
SLOW = {"train_job", "evaluate_job", "monitor_job", "predict_job", "tune", "cross_validate"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_agrees_with_sql(spark, duck, name):
    assert difference(spark, duck, SF, QUERIES[name], ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - SLOW))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
