"""Queries whose results SQL can express, against it."""

import pytest

import __spark_entry__
from tidelog.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_gives_the_rows_of_its_sql(name, same_rows):
    same_rows(queries.QUERIES[name], queries.ORACLE_SQL[name])


def test_all_are_registered():
    found = __spark_entry__.queries()
    assert "pipeline" in found
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in found) == 1
