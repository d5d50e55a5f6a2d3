"""Every catalog query against its SQL, on whole tables."""

import os

import pytest
from compare import connect, differences, duck_rows, spark_rows

from termspace.plans import catalog, oracle

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.SQL)


@pytest.mark.parametrize("name", catalog.QUERIES)
def test_query(spark, duck, name):
    ours = spark_rows(catalog.QUERIES[name](spark, SF))
    assert ours[1], "no rows"
    assert differences(ours, duck_rows(duck, oracle.SQL[name])) == []


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["concat_columns", "list_concat", "regex_tokens", "sentence_split", "explode_tokens"])
def test_text_queries_stay_out_of_python(spark, name):
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
