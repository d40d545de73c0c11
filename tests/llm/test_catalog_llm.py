"""Corpus queries against their SQL twins."""

import os

import pytest

import twins
from logweave.llm import catalog


def test_all_ten_are_registered():
    assert [int(name[2:].split("_")[0]) for name in catalog.queries()] == list(range(1, 11))


@pytest.mark.skipif(not os.path.exists(twins.SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_twins(spark, name):
    twins.assert_equal(spark, catalog.queries()[name], catalog.oracle_sql()[name])
