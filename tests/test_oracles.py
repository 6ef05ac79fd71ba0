"""The driver's correctness gate in miniature: every query with an oracle vs DuckDB at sf0.001."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

from conftest import SF_SMALL  # noqa: E402

ORACLES = E.oracle_sql()
QUANTILE_HEAVY = ["customer_features", "mean_median_by_response", "boxplot_summary", "iqr_filter_sequential",
                  "model_bins", "model_prep", "recode_total_spending"]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    line, ok = compare(spark, con, name, E.queries()[name], ORACLES[name], SF_SMALL)
    assert ok, line


@pytest.mark.parametrize("name", QUANTILE_HEAVY)
def test_narrowing_quantiles_match_oracle(spark, con, name, monkeypatch):
    from basketlens.operators import quantiles as Q
    monkeypatch.setattr(Q, "FINISH_ROWS", 8)
    monkeypatch.setattr(Q, "BUCKETS", 4)
    from basketlens.plans import catalog
    catalog.reset_cache()  # rebuild the shared feature tables on the forced path
    try:
        line, ok = compare(spark, con, name, E.queries()[name], ORACLES[name], SF_SMALL)
    finally:
        catalog.reset_cache()
    assert ok, line
