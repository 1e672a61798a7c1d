"""Every registered query against its SQL on the smallest data set."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from liftlens.plans.oracle import ORACLE
from liftlens.plans.queries import QUERIES
from tests.compare import difference, duck

SF = "/root/testdata/sf0.001"
FITTED = {"propensity_scores", "kpi_predictions", "feature_importance", "tuned_propensity",
          "effect_forest"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_only_fitted_models_lack_sql():
    assert set(QUERIES) - set(ORACLE) == FITTED
    assert set(QUERIES) <= set(entry_module.queries())


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    df = entry_module.queries()[name](spark, SF)
    assert difference(df, con, entry_module.oracle_sql()[name]) is None
