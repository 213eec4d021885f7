"""Every registered query against its SQL oracle."""

import pytest

import __spark_entry__ as entry
from marketloom.plans.registered import all_oracles, all_queries
from tests import oracle

SF = "/root/testdata/sf0.01"
# Fitted models have no oracle and are tested on their own below.
FITTED = {"model_cv", "model_holdout", "feature_importance"}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_but_fitted_models_has_an_oracle():
    assert set(all_queries()) - set(all_oracles()) == FITTED
    assert set(all_queries()) <= set(entry.queries()) and set(all_oracles()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_same_as_oracle(spark, con, name):
    problem, _ = oracle.compare(spark, name, all_queries()[name], all_oracles()[name], SF, con)
    assert not problem
