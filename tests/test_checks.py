"""Every registered plan against its SQL check; the others must give rows."""

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries

PLANS, CHECKS = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_equals_its_check(spark, con, folder, name):
    assert differences(spark, con, PLANS[name], CHECKS[name], folder) == []


@pytest.mark.parametrize("name", sorted(set(PLANS) - set(CHECKS)))
def test_gives_rows(spark, folder, name):
    rows = PLANS[name](spark, folder)
    assert len(set(rows.columns)) == len(rows.columns)
    assert rows.count() > 0


def test_entry_gives_rows(spark):
    assert entry(spark).count() > 0


def test_every_check_has_a_plan():
    assert set(CHECKS) <= set(PLANS)
