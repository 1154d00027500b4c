"""Every named query against its SQL oracle on the smallest tables."""

import oracle
import pytest

from thermoweave.plans.oracles import oracles
from thermoweave.plans.queries import registered

SF = f"{oracle.TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_every_query_has_an_oracle():
    assert set(registered()) == set(oracles())


@pytest.mark.parametrize("name", sorted(registered()))
def test_query_matches_oracle(spark, con, name):
    assert oracle.compare(registered()[name](spark, SF), con, oracles()[name]) is None
