from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest

from seriesloom.learners import squares
from seriesloom.operators import features, forecast, frames, gates
from seriesloom.operators.schema import DAILY, FORECAST
from seriesloom.plans import pipeline
from seriesloom.sources import readers, writers


def series(spark, values, name="a", start=date(2024, 1, 1)):
    rows = [(name, start + timedelta(days=i), float(v), 1.0, f"{name}-item") for i, v in enumerate(values)]
    return spark.createDataFrame(rows, DAILY)


def test_least_squares_equal_numpy(spark):
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(300, 3)) * [1, 100, 0.01] + [5, -3, 1]
    y = x @ [2.0, -0.5, 30.0] + rnd.normal(size=300)
    group = np.arange(300) % 3
    rows = [(int(g), *map(float, r), 7.0, float(v)) for g, r, v in zip(group, x, y)]
    frame = spark.createDataFrame([*rows, (0, None, 1.0, 1.0, 7.0, 5.0), (9, None, 1.0, 1.0, 7.0, 5.0)], "g long, a double, b double, c double, d double, y double")
    for r in squares.fit(frame, ["g"], ["a", "b", "c", "d"]).collect():
        if r["g"] == 9:
            assert r["mean"] == 5 and r["coef"] == [0, 0, 0, 0]
            continue
        own = group == r["g"]
        want = np.linalg.lstsq(np.c_[x[own], np.ones(own.sum())], y[own], rcond=None)[0]
        assert r["coef"][:3] == pytest.approx(want[:3], rel=1e-6) and r["coef"][3] == 0
        assert r["mean"] - np.dot(r["coef"][:3], r["center"][:3]) == pytest.approx(want[3], rel=1e-6)


def test_direct_forecast(spark):
    feat = features.add_features(series(spark, [5 + (i % 7) for i in range(80)]).union(series(spark, [3] * 80, "b")))
    found = forecast.direct(feat, "2024-03-20", 7).orderBy("series_id", "step").collect()
    assert len(found) == 14 and found[0]["date"] == date(2024, 3, 21) and found[0]["item_ref"] == "a-item"
    assert {r["prediction"] for r in found if r["series_id"] == "b"} == {3}


def test_one_failing_series_does_not_stop_the_others(spark):
    feat = features.add_features(series(spark, [5] * 60).union(series(spark, [1] * 3, "b")))
    found = forecast.direct(feat, "2024-03-20", 7)
    assert {(r["series_id"], r["status"]) for r in found.collect()} == {("a", "ok"), ("b", "failed")}
    assert writers.forecast_rows(found).count() == 7


def test_recursive_and_models(spark):
    feat = features.add_features(series(spark, [4 + (i % 2) for i in range(120)]), include_current=False)
    rows = forecast.recursive(feat, "2024-04-30", 4).orderBy("step").collect()
    assert [r["status"] for r in rows] == ["ok"] * 4
    assert {r["prediction"] for r in rows} <= {4, 5}
    models = forecast.train(feat).cache()
    assert models.first()["status"] == "ok" and models.first()["holdout_rmse"] < 1
    assert forecast.score(feat, models).count() == 120
    assert [r["series_id"] for r in forecast.available_series(models).collect()] == ["a"]
    assert forecast.model_of(models, "a").count() == 1
    with pytest.raises(KeyError):
        forecast.model_of(models, "zzz")
    shares = forecast.feature_importance(models).collect()
    assert sum(r["importance"] for r in shares) == pytest.approx(1)


def test_linear_falls_back_to_the_mean(spark):
    feat = features.add_features(series(spark, [3] * 40))
    assert {r["prediction"] for r in forecast.direct_linear(feat, "2024-02-10", 5).collect()} == {3}


def test_sinks_and_snapshots(spark, tmp_path):
    rows = spark.createDataFrame([(date(2024, 1, 1), 3, "a", "x")], FORECAST)
    none = spark.createDataFrame([], FORECAST)
    path = str(tmp_path / "forecasts")
    assert readers.forecasts(spark, path).count() == 0
    assert writers.replace_forecasts(rows, path)
    assert not writers.replace_forecasts(none, path)
    assert readers.forecasts(spark, path).count() == 1
    writers.save_forecasts(rows, path, "append")
    assert readers.forecasts(spark, path).count() == 2
    with pytest.raises(Exception, match="(?i)exists"):
        writers.save_forecasts(rows, path, "fail")
    writers.save_forecasts(none, path, "replace")
    assert readers.forecasts(spark, path).count() == 0
    made = []

    def load():
        made.append(1)
        return rows

    for _ in range(2):
        assert readers.snapshot(spark, str(tmp_path / "snap"), load).count() == 1
    assert len(made) == 1
    assert pipeline.stored_forecasts(spark, str(tmp_path / "kept"), load).count() == 1
    assert pipeline.stored_forecasts(spark, str(tmp_path / "kept"), lambda: none).count() == 1


def test_csv_round_trip(spark, tmp_path):
    rows = series(spark, [1, 2, 3])
    writers.to_csv(rows, str(tmp_path / "csv"))
    assert sorted(readers.csv(spark, str(tmp_path / "csv"), DAILY).collect()) == sorted(rows.collect())
    (tmp_path / "hourly.csv").write_text("Datetime,MW\n2024-01-01 01:00:00,5.5\nbad,1\n")
    hours = readers.hourly_csv(spark, str(tmp_path / "hourly.csv"), "Datetime", "MW").collect()
    assert [r["value"] for r in hours] == [5.5, 1.0] and hours[1]["ts"] is None


def test_model_table_is_stored_by_bucket(spark, tmp_path):
    feat = features.add_features(series(spark, [4] * 60), include_current=False)
    writers.save_models(forecast.train(feat), str(tmp_path / "models"))
    assert spark.read.parquet(str(tmp_path / "models")).where("series_id = 'a'").count() == 1


def test_production_chain(spark, sf):
    raw = readers.raw_order_lines(spark, sf)
    as_of = pipeline.newest_day(raw, "date_created")
    found = pipeline.production(raw, as_of, 3)
    assert found.count() > 0 and set(r["status"] for r in found.collect()) == {"ok"}


def test_jdbc_round_trip(spark, tmp_path):
    """Source and sink against the Derby driver that Spark brings."""
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    options = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = spark.createDataFrame([(date(2024, 1, d), d, "a", "x") for d in range(1, 11)], FORECAST)
    assert writers.forecasts_to_jdbc(rows, url, "stored", options)
    assert not writers.forecasts_to_jdbc(rows.limit(0), url, "stored", options)
    assert writers.forecasts_to_jdbc(rows, url, "stored", options, "append")
    whole = readers.jdbc(spark, url, "stored", options)
    split = readers.jdbc(spark, url, "stored", options, '"prediction"', ("1", "10"), 4)
    assert whole.count() == split.count() == 20 and split.rdd.getNumPartitions() == 4
    assert writers.forecasts_to_jdbc(rows, url, "stored", options, "replace")
    assert sorted(readers.jdbc(spark, url, "stored", options).collect()) == sorted(rows.collect())


@pytest.mark.parametrize("n", [50, 365, 1000, 2557])
@pytest.mark.parametrize("price", [0.1, 0.2, 19.99, 123.45, 333333.33])
def test_constant_features_have_no_slope(n, price):
    """Products of a constant's distances from itself are zero, whatever its digits."""
    assert np.sum(np.full(n, price) - price) == 0
    y = np.arange(n, dtype=float) % 7
    low = [float(n), y.sum(), 0.0, 0.0, 0.0, price, 0.0]
    found = squares._solution(pd.Series([low]), 1, 1)
    assert found["coef"][0] == [[0.0]] and found["center"][0] == [price]


def test_constant_price_on_spark(spark):
    rows = [(g, float(i % 9), p, float(i % 9) * 2 + 5) for g, p in enumerate([0.1, 19.99, 123.45, 333333.33]) for i in range(1000)]
    frame = spark.createDataFrame(rows, "g long, a double, price double, y double").repartition(7)
    for r in squares.fit(frame, ["g"], ["a", "price"]).collect():
        assert r["coef"] == pytest.approx([2.0, 0.0]) and r["coef"][1] == 0 and r["share"] == [1.0, 0.0]


def test_all_steps_from_one_pass_equal_fits_of_each(spark):
    rnd = np.random.default_rng(3)
    values = rnd.integers(0, 50, 90).tolist()
    feat = features.add_features(series(spark, values).union(series(spark, values[::-1], "b")))
    names = ["lag_1", "rolling_mean_3", "day_of_week"]
    long = frames.direct_frame(feat, "series_id", 5, names, long=True)
    want = {(r["series_id"], r["step"]): r for r in squares.fit(long, ["series_id", "step"], names).collect()}
    rows = squares.shifted(feat, ["series_id"], names, frames.ahead("series_id", 5))
    for r in squares.solved(rows.groupBy("series_id").agg(*squares.sums(3, 5)), 3, 5).collect():
        for step in range(1, 6):
            w = want[r["series_id"], step]
            assert r["mean"][step - 1] == pytest.approx(w["mean"]) and r["coef"][step - 1] == pytest.approx(w["coef"])
            assert r["train_rows"] == w["train_rows"]
