"""Every query that SQL can express gives the rows that another engine gives for its SQL."""

import harness
import pytest

from kinelake.plans import core


@pytest.mark.parametrize("name", sorted(core.sql))
def test_same_as_sql(spark, small, con, name):
    assert harness.difference(core.queries[name](spark, small), con, core.sql[name]) == ""


@pytest.mark.parametrize("name", sorted(set(core.queries) - set(core.sql)))
def test_runs(spark, small, name):
    df = core.queries[name](spark, small)
    assert df.columns and df.count() >= 0


def test_entry_and_names(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["global_index", "field", "dim"]
