"""Operator ids whose query is a whole composite job: its SQL and its rows, on tables of their own."""

import pytest

import __spark_entry__ as E
from ceasekit.catalog import base
from tests.oracle_check import compare
from tests.study_rows import write_study


@pytest.fixture(scope="module")
def sf(tmp_path_factory):
    return write_study(tmp_path_factory.mktemp("study"))


@pytest.mark.parametrize("name", sorted(base.WHOLE))
def test_whole_job_under_the_operators_id(spark, sf, name):
    sql = E.oracle_sql()
    assert sql[name] == sql[base.WHOLE[name]] and "customer_info AS (" in sql[name]
    got = compare(spark, sf, [name], verbose=False)
    assert got and all(v == "OK" for v in got.values()), got
