"""Every registered query against its DuckDB oracle on sf0.001."""

import os
import sys

import pytest

import __spark_entry__ as E
from shoplens.plans import registry
from tests.conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from compare import compare_one  # noqa: E402


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, duck, name):
    ok, msg = compare_one(spark, duck, name, registry.queries()[name], registry.oracle_sql().get(name), SF_SMALL)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns == ["area", "area_level", "product_id", "product_name", "click_count",
                                               "city_infos", "product_status"]
