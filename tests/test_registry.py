from __future__ import annotations

import contextlib

import pytest

import __spark_entry__ as entry
from seriesloom.plans import registry
from tests.oracle import compare, connection
from seriesloom.operators import forecast
from seriesloom.plans import queries


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["series_id", "step", "date", "prediction_raw", "prediction"]
    assert df.count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.ORACLES) <= set(registry.QUERIES)


@pytest.fixture(scope="module")
def con(sf):
    return connection(sf)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, sf, con, name):
    compare(spark, con, sf, registry.QUERIES[name], registry.ORACLES[name])


@pytest.mark.parametrize("name", ["forecast_recursive", "feature_importance", "forecast_slice", "hourly_forecast"])
def test_model_queries_have_rows(spark, sf, name):
    assert registry.QUERIES[name](spark, sf).count() > 0


def test_chains_read_their_lines_once(spark, sf, monkeypatch):
    """Forecasts and models that read features several times read them as a table, not from the order lines again."""
    seen = []
    for place, name in ((forecast, "train_boosted"), (forecast, "train"), (forecast, "direct_boosted"), (forecast, "recursive")):
        monkeypatch.setattr(place, name, lambda feat, *_, **__: seen.append(feat.inputFiles()) or feat.limit(0))
    for name in ("_boosted", "_models", "forecast_boosted", "forecast_recursive", "forecast_recursive_boosted"):
        with contextlib.suppress(Exception):  # what follows the fit has nothing to work on
            getattr(queries, name)(spark, sf)
    assert len(seen) == 5 and not any("lineitem" in file for files in seen for file in files)
