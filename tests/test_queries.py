"""Every query of the core runs, and equals its SQL where it has one."""

import pytest

import oracle
from driftmark.plans import registry


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf_dir, con, name):
    assert oracle.compare(spark, sf_dir, name, registry.QUERIES[name], registry.ORACLES.get(name), con) == ""
