"""Every registered query equals its SQL; those without SQL run and have a schema."""

import pytest

from pagemill.plans import registry
from tests.conftest import SMALL, same_as_sql

#: these queries name quotas that the smallest data do not have
OTHER_SIZE = {"gold_batch": "/root/testdata/sf0.01", "gold_batch_summary": "/root/testdata/sf0.01", "gold_task_fields": "/root/testdata/sf0.01"}


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_equals_sql(spark, name):
    same_as_sql(spark, registry.QUERIES[name], registry.SQL[name], OTHER_SIZE.get(name, SMALL))


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
