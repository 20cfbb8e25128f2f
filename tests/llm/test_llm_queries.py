import harness
import pytest

from kinelake.llm.queries import llm


@pytest.mark.parametrize("name", sorted(llm.sql))
def test_same_as_sql(spark, small, con, name):
    assert harness.difference(llm.queries[name](spark, small), con, llm.sql[name]) == ""


@pytest.mark.parametrize("name", sorted(set(llm.queries) - set(llm.sql)))
def test_runs(spark, small, name):
    assert llm.queries[name](spark, small).count() > 0
