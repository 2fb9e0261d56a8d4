"""Every registered query against its SQL."""

import os

import pytest

from daymark.catalog import REGISTRY
from daymark.catalog.base import Tables
from daymark.operators import features
from daymark.operators.serving import mart_from_wide
from tests.oracle import ROOT, compare, connect


@pytest.fixture(scope="session")
def small():
    return connect(f"{ROOT}/sf0.001")


@pytest.mark.skipif(not os.path.isdir(ROOT), reason="needs the given tables")
@pytest.mark.parametrize("name", list(REGISTRY))
def test_same_rows_as_sql(spark, small, name):
    assert compare(spark, small, f"{ROOT}/sf0.001", name, empty_ok=True) is None


@pytest.mark.skipif(not os.path.isdir(ROOT), reason="needs the given tables")
def test_features_fail_on_gaps(spark):
    with pytest.raises(Exception, match="continuous"):
        features.delayed_lags(mart_from_wide(Tables(spark, f"{ROOT}/sf0.001").w1)).collect()
