"""Driver contract: entry(), queries() and oracle_sql() agree; oracles match at sf0.001."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "top_bikes" in df.columns


OWN = sorted(set(E.queries()) - set(E._llm()[0]))          # those of the llm subpackage have their own tests


def test_every_query_has_an_oracle():
    assert set(OWN) == set(E.oracle_sql()) - set(E._llm()[1])


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, sf_small, name):
    from check_oracles import compare, duck
    got = E.queries()[name](spark, sf_small).toArrow()
    want = duck(sf_small).sql(E.oracle_sql()[name]).to_arrow_table()
    assert compare(got, want) is None
