"""Registered queries over the given tables."""

from __future__ import annotations

from datetime import timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.functions.scalar import half_even, lenient_date
from seriesloom.learners.boosted import Options
from seriesloom.operators import clean, evaluate, features, forecast, frames, gates, profile, quality
from seriesloom.plans.pipeline import newest_day
from seriesloom.plans.scratch import shared_dir
from seriesloom.plans.sizing import sized
from seriesloom.sources import readers, writers

HORIZON = 30
YEAR_PART = 90
CUTOFF = "2001-01-01"
SPAN = ("1999-01-01", "1999-12-31")
BRAND = "Brand#11"
Spark, Frame = SparkSession, DataFrame


#: Where ``rounded`` goes up. Money over whole quantities often ends in an exact half, never in this.
OFFSET = 0.3


def rounded(df: Frame, digits: int = 6) -> Frame:
    """Doubles rounded for comparison: sums depend on the order of their terms in the last digits."""
    scale = F.lit(10.0**digits)
    value = lambda c: F.floor(F.col(c) * scale + F.lit(OFFSET)) / scale
    return df.select(*[value(c).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


def _raw(spark: Spark, d: str, key: str = "p_brand") -> Frame:
    return readers.raw_order_lines(sized(spark, f"{d}/lineitem.parquet"), d, key)


def _lines(spark: Spark, d: str, key: str = "p_brand") -> Frame:
    return clean.normalise_date(clean.canonicalise(_raw(spark, d, key)))


def _daily(spark: Spark, d: str, key: str = "p_brand") -> Frame:
    return clean.daily_collapse(_lines(spark, d, key))


def _clean(spark: Spark, d: str, key: str = "p_brand") -> Frame:
    return clean.clean_sparse(_daily(spark, d, key))


def _features(spark: Spark, d: str, key: str = "p_brand", include_current: bool = True) -> Frame:
    return features.add_features(_clean(spark, d, key), include_current=include_current)


def _stored_features(spark: Spark, d: str, include_current: bool = True) -> Frame:
    """Features that are read several times, as a table: the lines are read and joined once, whatever follows."""
    path = f"{shared_dir(spark)}/features-{uuid4().hex}"
    made = _features(spark, d, include_current=include_current)
    made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def _as_of(spark: Spark, d: str):
    return newest_day(readers.table(spark, d, "lineitem"), "l_shipdate")


def order_lines(spark: Spark, d: str) -> Frame:
    return rounded(clean.canonicalise(_raw(spark, d)))


def normalized_dates(spark: Spark, d: str) -> Frame:
    """Event times written as text at an offset of -03:00, read back in both modes."""
    events = readers.table(spark, d, "events")
    text = events.select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("-03:00")).alias("t"))
    return text.select("event_id", lenient_date("t").alias("wall_clock"), lenient_date("t", "utc").alias("utc"))


def daily_collapse(spark: Spark, d: str) -> Frame:
    return rounded(_daily(spark, d))


def daily_collapse_sku(spark: Spark, d: str) -> Frame:
    lines = _lines(spark, d).withColumnRenamed("item_ref", "sku")
    return rounded(clean.daily_collapse(lines, "sku", carry=None))


def dedup_daily(spark: Spark, d: str) -> Frame:
    first = clean.dedup_daily(_lines(spark, d, "l_suppkey"))
    return rounded(first.select("series_id", "date", "order_id", "quant", "price"))


def dense_daily(spark: Spark, d: str) -> Frame:
    return rounded(clean.densify(_daily(spark, d)))


def zero_runs_marked(spark: Spark, d: str) -> Frame:
    return rounded(clean.mark_zero_runs(clean.densify(_daily(spark, d, "l_suppkey"))))


def clean_daily(spark: Spark, d: str) -> Frame:
    return rounded(_clean(spark, d))


def clean_daily_parts(spark: Spark, d: str) -> Frame:
    return rounded(_clean(spark, d, "l_partkey"))


def features_(spark: Spark, d: str) -> Frame:
    return rounded(_features(spark, d))


def complete_features(spark: Spark, d: str) -> Frame:
    wanted = ["lag_1", "rolling_mean_3", "price_per_unit"]
    return rounded(features.complete(_features(spark, d, "l_suppkey"), wanted).select("series_id", "date", "quant", *wanted))


def calendar_features(spark: Spark, d: str) -> Frame:
    return rounded(features.add_calendar(readers.hourly_series(spark, d), "ts"))


def hourly_series(spark: Spark, d: str) -> Frame:
    return rounded(readers.hourly_series(spark, d))


def legacy_sales(spark: Spark, d: str) -> Frame:
    return readers.legacy_sales(spark, d)


def rounding(spark: Spark, d: str) -> Frame:
    daily = _daily(spark, d, "l_suppkey")
    return daily.select("series_id", "date", half_even(F.col("quant") / 4).alias("units"))


def series_slice(spark: Spark, d: str) -> Frame:
    return rounded(profile.forecast_slice(_daily(spark, d), BRAND, *SPAN))


def open_range(spark: Spark, d: str) -> Frame:
    daily = _daily(spark, d)
    return rounded(daily.where((F.col("date") > F.lit(SPAN[0]).cast("date")) & (F.col("date") < F.lit(SPAN[1]).cast("date"))))


def outlier_filter(spark: Spark, d: str) -> Frame:
    return rounded(profile.below(_daily(spark, d), 250.0))


def series_calendar(spark: Spark, d: str) -> Frame:
    return rounded(frames.series_calendar(_daily(spark, d), BRAND, *SPAN))


def weekday_profile(spark: Spark, d: str) -> Frame:
    return rounded(profile.weekday_profile(_daily(spark, d)))


def series_count(spark: Spark, d: str) -> Frame:
    return profile.series_count(_daily(spark, d, "l_partkey"))


def series_list(spark: Spark, d: str) -> Frame:
    return profile.series_list(_daily(spark, d, "l_partkey"))


def series_date_range(spark: Spark, d: str) -> Frame:
    return profile.series_date_range(_daily(spark, d, "l_partkey"))


def box_weekday(spark: Spark, d: str) -> Frame:
    daily = _daily(spark, d).withColumn("weekday", F.weekday("date"))
    return rounded(profile.box_summary(daily, "weekday"))


def box_day(spark: Spark, d: str) -> Frame:
    return rounded(profile.box_summary(_daily(spark, d).withColumn("day", F.dayofmonth("date")), "day"))


def box_month(spark: Spark, d: str) -> Frame:
    return rounded(profile.box_summary(_daily(spark, d).withColumn("month", F.month("date")), "month"))


def date_range(spark: Spark, d: str) -> Frame:
    """Of a known series, of an unknown one (the range of all), and of no rows at all (the day itself)."""
    daily = _daily(spark, d)
    asked = [(BRAND, daily), ("no such series", daily), (BRAND, daily.limit(0))]
    found = [profile.date_range_of(df, name, "2024-05-06").withColumn("case", F.lit(i)) for i, (name, df) in enumerate(asked)]
    return found[0].union(found[1]).union(found[2])


def box_hour(spark: Spark, d: str) -> Frame:
    hours = features.add_calendar(readers.hourly_series(spark, d), "ts", ["hour"])
    return rounded(profile.box_summary(hours, "hour", "value"), 4)


def quantity_histogram(spark: Spark, d: str) -> Frame:
    return profile.histogram(_daily(spark, d), "quant", 100)


def sku_contract(spark: Spark, d: str) -> Frame:
    return quality.sku_contract(_lines(spark, d))


def freshness(spark: Spark, d: str) -> Frame:
    return quality.freshness(_daily(spark, d), _as_of(spark, d) + timedelta(days=10))


def freshness_levels(spark: Spark, d: str) -> Frame:
    return quality.freshness_levels(_raw(spark, d), _as_of(spark, d))


def series_profile(spark: Spark, d: str) -> Frame:
    return gates.series_profile(_clean(spark, d, "l_partkey"))


def _gate(spark: Spark, d: str) -> Frame:
    return gates.gate_direct(gates.series_profile(_clean(spark, d, "l_partkey")), _as_of(spark, d), HORIZON)


def series_gate(spark: Spark, d: str) -> Frame:
    return _gate(spark, d)


def gate_summary(spark: Spark, d: str) -> Frame:
    return gates.summary(_gate(spark, d))


def series_gate_recursive(spark: Spark, d: str) -> Frame:
    daily = _clean(spark, d, "l_partkey")
    return gates.gate_recursive(gates.series_profile(daily), gates.train_rows(daily), _as_of(spark, d))


def series_gate_train(spark: Spark, d: str) -> Frame:
    return gates.gate_train(gates.train_rows(_clean(spark, d, "l_partkey")))


def holdout_split(spark: Spark, d: str) -> Frame:
    return rounded(frames.holdout_split(_clean(spark, d)).select("series_id", "date", "quant", "split"))


def fixed_split(spark: Spark, d: str) -> Frame:
    return rounded(frames.fixed_split(_clean(spark, d), CUTOFF).select("series_id", "date", "quant", "split"))


def direct_frame(spark: Spark, d: str) -> Frame:
    wide = frames.direct_frame(_features(spark, d), horizon=HORIZON, features=["lag_1"])
    return rounded(wide.select("series_id", "date", "lag_1", *[F.col("y")[i].alias(f"y_{i + 1}") for i in range(HORIZON)]))


def last_features(spark: Spark, d: str) -> Frame:
    return rounded(frames.last_features(_features(spark, d, "l_partkey")))


def last_values(spark: Spark, d: str) -> Frame:
    values = frames.last_values(_clean(spark, d, "l_partkey"))
    return values.select("series_id", *[F.col("last_values")[i].alias(f"v{i + 1}") for i in range(3)])


def future_calendar(spark: Spark, d: str) -> Frame:
    last = _daily(spark, d).groupBy("series_id").agg(F.max("date").alias("last_date"))
    return frames.future_calendar(last, "series_id", _as_of(spark, d), HORIZON)


def _linear(spark: Spark, d: str, horizon: int = HORIZON) -> Frame:
    return forecast.direct_linear(_features(spark, d), _as_of(spark, d), horizon)


def forecast_direct_linear(spark: Spark, d: str) -> Frame:
    return rounded(_linear(spark, d), 4)


def forecast_direct_linear_90(spark: Spark, d: str) -> Frame:
    return rounded(_linear(spark, d, YEAR_PART), 4)


def running_totals(spark: Spark, d: str) -> Frame:
    return rounded(evaluate.running_totals(_linear(spark, d), value="prediction_raw").select("series_id", "date", "running_total"), 3)


def horizon_totals(spark: Spark, d: str) -> Frame:
    until = _as_of(spark, d) + timedelta(days=10)
    return rounded(evaluate.horizon_totals(_linear(spark, d), until, value="prediction_raw"), 3)


def _holdout(spark: Spark, d: str) -> Frame:
    feat = _features(spark, d)
    return evaluate.actual_vs_pred(feat.select("series_id", "date", "quant"), forecast.holdout_linear(feat))


def actual_vs_pred(spark: Spark, d: str) -> Frame:
    return rounded(_holdout(spark, d), 4)


def forecast_rmse(spark: Spark, d: str) -> Frame:
    return rounded(evaluate.rmse(_holdout(spark, d)), 4)


def worst_days(spark: Spark, d: str) -> Frame:
    return rounded(evaluate.worst_days(_holdout(spark, d)), 4)


def forecast_direct(spark: Spark, d: str) -> Frame:
    as_of = _as_of(spark, d)
    gate = lambda series: gates.gate_direct(series, as_of, HORIZON)
    return writers.forecast_rows(forecast.direct(_features(spark, d), as_of, HORIZON, gate=gate))


def forecast_recursive(spark: Spark, d: str) -> Frame:
    as_of = _as_of(spark, d)
    feat = _stored_features(spark, d, include_current=False)
    gated = gates.gate_recursive(gates.series_profile(feat), gates.train_rows(feat), as_of)
    return writers.forecast_rows(forecast.recursive(gates.passing(feat, gated), as_of, HORIZON))


def _models(spark: Spark, d: str) -> Frame:
    return forecast.train(_stored_features(spark, d, include_current=False))


def series_models(spark: Spark, d: str) -> Frame:
    return _models(spark, d)


#: Boosted queries run these rounds instead of 1000 at a rate of 0.01; README has figures for more.
TREES = Options(rounds=12, rate=0.3, patience=4)
#: The same where every one of 30 steps has trees of its own.
STEP_TREES = Options(rounds=6, rate=0.5, patience=None)


def forecast_boosted(spark: Spark, d: str) -> Frame:
    """Trees for each series and each of 30 steps, as ``forecast_direct`` otherwise."""
    as_of = _as_of(spark, d)
    gate = lambda series: gates.gate_direct(series, as_of, HORIZON)
    return writers.forecast_rows(forecast.direct_boosted(_stored_features(spark, d), as_of, HORIZON, STEP_TREES, gate=gate))


def _boosted(spark: Spark, d: str) -> tuple[Frame, Frame]:
    """The features, and the model table as it is stored and read again."""
    feat = _stored_features(spark, d, include_current=False)
    path = f"{shared_dir(spark)}/boosted-models-{uuid4().hex}"
    writers.save_models(forecast.train_boosted(feat, TREES), path)
    return feat, spark.read.parquet(path)


def boosted_models(spark: Spark, d: str) -> Frame:
    _, models = _boosted(spark, d)
    first = F.round(F.col("trees")[0]["value"][0], 6).alias("first_value")
    return models.select("series_id", "features", "train_rows", "best_round", F.round("holdout_rmse", 6).alias("holdout_rmse"), F.size("trees").alias("trees"), first, "status", "error")


def boosted_importance(spark: Spark, d: str) -> Frame:
    return forecast.feature_importance(_boosted(spark, d)[1])


def boosted_predictions(spark: Spark, d: str) -> Frame:
    feat, models = _boosted(spark, d)
    test = frames.holdout_split(feat).where("split = 'test'")
    return evaluate.actual_vs_pred(feat.select("series_id", "date", "quant"), forecast.score_boosted(test, models))


def forecast_recursive_boosted(spark: Spark, d: str) -> Frame:
    """The recursive form on the month as well, with rounds that the holdout stops."""
    as_of = _as_of(spark, d)
    feat = _stored_features(spark, d, include_current=False).withColumn("month", F.month("date"))
    gated = gates.gate_recursive(gates.series_profile(feat), gates.train_rows(feat), as_of)
    names = ["lag_1", "rolling_mean_3", "day_of_week", "day_of_month", "month"]
    return writers.forecast_rows(forecast.recursive(gates.passing(feat, gated), as_of, HORIZON, features=names, trees=TREES))


def available_series(spark: Spark, d: str) -> Frame:
    return forecast.available_series(_models(spark, d))


def feature_importance(spark: Spark, d: str) -> Frame:
    return forecast.feature_importance(_models(spark, d))


def holdout_predictions(spark: Spark, d: str) -> Frame:
    feat = _stored_features(spark, d, include_current=False)
    models = forecast.train(feat)
    test = frames.holdout_split(feat).where("split = 'test'")
    return evaluate.actual_vs_pred(feat.select("series_id", "date", "quant"), forecast.score(test, models))


def _stored(spark: Spark, d: str) -> Frame:
    """The flat forecast table of the linear learner, whose forecasts SQL can tell."""
    items = _daily(spark, d).groupBy("series_id").agg(F.max_by("item_ref", "date").alias("item_ref"))
    return writers.forecast_rows(_linear(spark, d).join(items, "series_id"))


def forecast_scan(spark: Spark, d: str) -> Frame:
    return _stored(spark, d).orderBy("series_id", "date")


def forecast_slice(spark: Spark, d: str) -> Frame:
    sliced = profile.forecast_slice(_stored(spark, d), BRAND, _as_of(spark, d), "2100-01-01")
    return profile.page_after(sliced, ["date", "series_id", "item_ref", "prediction"], ["date", "series_id"], 100)


def forecast_page(spark: Spark, d: str) -> Frame:
    """The 100 records after one series' tenth day, by day and series."""
    after = (_as_of(spark, d) + timedelta(days=10), BRAND)
    return profile.page_after(_stored(spark, d), ["date", "series_id", "item_ref", "prediction"], ["date", "series_id"], 100, after)


def forecast_pooled(spark: Spark, d: str) -> Frame:
    return forecast.direct_pooled(_features(spark, d), _as_of(spark, d), HORIZON)


def hourly_forecast(spark: Spark, d: str) -> Frame:
    parts = ["hour", "day_of_week", "day_of_month", "week_of_year"]
    series = features.add_calendar(readers.hourly_series(spark, d), "ts", parts)
    return forecast.hourly(series, "2024-01-25", parts)


_ALL = [
    order_lines, normalized_dates, daily_collapse, daily_collapse_sku, dedup_daily, dense_daily, zero_runs_marked,
    clean_daily, clean_daily_parts, complete_features, calendar_features, hourly_series, legacy_sales, rounding,
    series_slice, open_range, outlier_filter, series_calendar, weekday_profile, series_count, series_list,
    series_date_range, date_range, box_weekday, box_day, box_month, box_hour, quantity_histogram, sku_contract, freshness, freshness_levels,
    series_profile, series_gate, gate_summary, series_gate_recursive, series_gate_train, holdout_split, fixed_split,
    direct_frame, last_features, last_values, future_calendar, forecast_direct_linear,
    forecast_direct_linear_90, running_totals, horizon_totals, actual_vs_pred,
    forecast_rmse, worst_days, forecast_direct, forecast_recursive, series_models, available_series,
    feature_importance, holdout_predictions, forecast_boosted, boosted_models, boosted_importance,
    boosted_predictions, forecast_recursive_boosted, forecast_scan, forecast_slice, forecast_page, forecast_pooled, hourly_forecast,
]
QUERIES = {f.__name__: f for f in _ALL} | {"features": features_}
