"""Every registered query gives what its SQL twin gives."""

import os

import pytest

import twins
from logweave.plans import catalog


def test_every_query_has_a_twin():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.skipif(not os.path.exists(twins.SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_twins(spark, name):
    twins.assert_equal(spark, catalog.queries()[name], catalog.oracle_sql()[name])
