"""Registered queries of this package that have SQL, against it, on the smallest tables."""

import pytest
from run_queries import compare, duck

from tidemark.llm.queries import QUERIES
from tidemark.llm.sql import SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SF)
    cur = duck(SF).execute(SQL[name])
    assert compare(df.columns, df.collect(), [d[0] for d in cur.description], cur.fetchall()) == ""
