"""Queries with a SQL form against DuckDB, and the registry."""

import oracle
import pytest

from thermoweave.llm.queries import oracles, registered

SF = f"{oracle.TESTDATA}/sf0.001"


@pytest.mark.parametrize("name", sorted(oracles()))
def test_query_matches_oracle(spark, name):
    assert oracle.compare(registered()[name](spark, SF), oracle.connect(SF), oracles()[name]) is None


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in registered()) == list(range(1, 14))
