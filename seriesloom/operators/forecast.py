"""Forecasts and models of many series as Spark jobs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.scalar import half_even
from seriesloom.learners import boosted, linear, pooled, squares
from seriesloom.operators import frames, gates
from seriesloom.operators.schema import FEATURES, FEATURES_WITH_PRICE


def direct_linear(feat: DataFrame, as_of: str | date, horizon: int, key: str = "series_id", anchor: str = "as_of") -> DataFrame:
    """``key, step, date, prediction_raw, prediction`` from one line per series and step on ``lag_1``."""
    long = frames.direct_frame(feat, key, horizon, ["lag_1"], long=True)
    lines = linear.fit(long, [key, "step"])
    last = frames.last_features(feat, key, ["lag_1"]).withColumnRenamed("date", "last_date")
    days = frames.future_calendar(last.select(key, "last_date"), key, as_of, horizon, anchor)
    raw = linear.value()
    out = lines.join(last, key).join(days, [key, "step"])
    return out.select(key, "step", "date", raw.alias("prediction_raw"), half_even(raw).alias("prediction"))


def holdout_linear(feat: DataFrame, key: str = "series_id", months: int = 1) -> DataFrame:
    """Test rows of each series with a prediction from its training rows."""
    split = frames.holdout_split(feat, key, months)
    lines = linear.fit(split.where("split = 'train'"), [key], target="quant")
    test = split.where("split = 'test'").select(key, "date", "lag_1")
    return test.join(lines, key).select(key, "date", linear.value().alias("prediction"))


def _known(features: Sequence[str]) -> Column:
    return F.array(*[F.col(f).cast("double") for f in features])


def _fitted(features: Sequence[str]) -> Column:
    return squares.value(_known(features), F.col("mean"), F.col("center"), F.col("coef"))


def _item(feat: DataFrame, key: str) -> DataFrame:
    """Each series with its newest item."""
    item = F.max_by("item_ref", "date") if "item_ref" in feat.columns else F.lit(None).cast("string")
    return feat.groupBy(key).agg(F.max("date").alias("last_date"), item.alias("item_ref"))


def _told(rows: DataFrame, key: str, sound: Column) -> DataFrame:
    """Sound rows; of a series that has none, one row that says so."""
    keep = rows.where(sound | (F.col("step") == 1))
    only = lambda c: F.when(sound, F.col(c)).alias(c)
    status = F.when(sound, "ok").otherwise("failed").alias("status")
    error = F.when(~sound, F.lit("no training rows")).alias("error")
    return keep.select(only("date"), only("prediction"), F.col(key).cast("string").alias(key), "item_ref", only("step"), status, error)


Gate = Callable[[DataFrame], DataFrame]


def _gated(series: DataFrame, gate: Gate | None) -> DataFrame:
    return gate(series).where("gate_reason = 'ok'") if gate else series


def _series(rows: DataFrame, key: str, features: Sequence[str], more: Sequence[Column]) -> DataFrame:
    """One pass over the rows: each series' profile, newest item, features of its last row, and ``more`` aggregates."""
    item = F.max_by("item_ref", "date") if "item_ref" in rows.columns else F.lit(None).cast("string")
    last = F.max_by(_known(features), "date").alias("known")
    return rows.groupBy(key).agg(*gates.profile_columns(), item.alias("item_ref"), last, *more)


def direct(
    feat: DataFrame,
    as_of: str | date,
    horizon: int,
    key: str = "series_id",
    features: Sequence[str] = FEATURES,
    anchor: str = "as_of",
    gate: Gate | None = None,
) -> DataFrame:
    """``date, prediction, key, item_ref, step, status, error``: least squares for each series and step.

    All of it is one aggregation of the rows: the sums of every step, the last row, and the profile that ``gate`` judges
    (it adds ``gate_reason``; only series that are ``ok`` are forecast). A series without training rows gives one row with
    its error and leaves the others alone.
    """
    rows = squares.shifted(feat, [key], features, frames.ahead(key, horizon))
    series = _gated(_series(rows, key, features, squares.sums(len(features), horizon)), gate)
    models = squares.solved(series, len(features), horizon)
    steps = models.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    start = {"as_of": F.lit(as_of).cast("date"), "last_date": F.col("last_date")}[anchor]
    at = lambda c: F.get(c, F.col("step") - 1)
    raw = squares.value(F.col("known"), at("mean"), F.col("center"), at("coef"))
    found = steps.withColumns({"date": F.date_add(start, F.col("step")), "prediction": half_even(raw)})
    return _told(found, key, F.col("mean").isNotNull())


def direct_boosted(
    feat: DataFrame,
    as_of: str | date,
    horizon: int,
    options: boosted.Options,
    key: str = "series_id",
    features: Sequence[str] = FEATURES,
    anchor: str = "as_of",
    gate: Gate | None = None,
) -> DataFrame:
    """The same from boosted trees for each series and step, all grown together; every step runs all rounds."""
    series = _gated(_series(feat, key, features, []), gate)
    y = frames.ahead(key, horizon)
    rows = feat.select(key, F.col(key).cast("string").alias("series"), "date", _known(features).alias("x"), y.alias("y"), F.lit(False).alias("test"))
    rows = rows.where("y is not null").join(series.select(key), key, "left_semi")
    models = boosted.fit(rows, len(features), horizon, replace(options, patience=None))
    by_step = models.select(F.col("series").alias("_s"), (F.col("step") + 1).alias("_n"), "base", "trees")
    steps = series.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    found = steps.join(by_step, (F.col(key).cast("string") == F.col("_s")) & (F.col("step") == F.col("_n")), "left")
    start = {"as_of": F.lit(as_of).cast("date"), "last_date": F.col("last_date")}[anchor]
    raw = boosted.value(F.col("known"), F.col("base"), F.col("trees"), options.depth)
    found = found.withColumns({"date": F.date_add(start, F.col("step")), "prediction": half_even(raw)})
    return _told(found, key, F.col("trees").isNotNull())


#: What a recursive forecast knows about a day: the last values and the day itself.
STATE = {
    "lag_1": lambda tail, day: tail[2],
    "rolling_mean_3": lambda tail, day: (tail[0] + tail[1] + tail[2]) / 3,
    "day_of_week": lambda tail, day: F.weekday(day),
    "day_of_month": lambda tail, day: F.dayofmonth(day),
    "month": lambda tail, day: F.month(day),
}


def recursive(
    feat: DataFrame,
    as_of: str | date,
    horizon: int,
    key: str = "series_id",
    months: int = 1,
    features: Sequence[str] = ("lag_1", "rolling_mean_3", "day_of_week", "day_of_month"),
    trees: boosted.Options | None = None,
) -> DataFrame:
    """``date, prediction, key, item_ref, step, status, error``: one model per series, fed with its own predictions.

    ``rolling_mean_3`` should be built with ``include_current=False``, since the mean at a forecast day cannot hold that
    day. A series' state is its last three values; the steps are folded over it inside one row. Models are least squares,
    or with ``trees`` boosted trees whose rounds the holdout stops.
    """
    start = F.lit(as_of).cast("date")
    series = _item(feat, key).join(frames.last_values(feat, key), key)
    if trees:
        models = train_boosted(feat, trees, key, months, features).where("status = 'ok'").select(F.col("series_id").alias("_s"), "base", "trees")
        rows = series.join(models, F.col(key).cast("string") == F.col("_s"), "left")
        fitted = lambda known: boosted.value(known, F.col("base"), F.col("trees"), trees.depth)
        sound = F.col("trees").isNotNull()
    else:
        train = frames.holdout_split(feat, key, months).where("split = 'train'")
        rows = series.join(squares.fit(train, [key], features, "quant"), key, "left")
        fitted = lambda known: squares.value(known, F.col("mean"), F.col("center"), F.col("coef"))
        sound = F.col("mean").isNotNull()

    def step(state: Column, n: Column) -> Column:
        tail = state["tail"]
        known = F.array(*[STATE[f](tail, F.date_add(start, n)).cast("double") for f in features])
        new = F.rint(fitted(known))
        return F.struct(F.array(tail[1], tail[2], new).alias("tail"), F.concat(state["out"], F.array(new)).alias("out"))

    first = F.struct(F.col("last_values").alias("tail"), F.array().cast("array<double>").alias("out"))
    path = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), first, step, lambda state: state["out"])
    each = rows.withColumn("_p", path).select("*", F.posexplode("_p").alias("_n", "_v"))
    each = each.withColumn("step", F.col("_n") + 1).withColumn("prediction", F.col("_v").cast("long"))
    return _told(each.withColumn("date", F.date_add(start, F.col("step"))), key, sound)


def train(feat: DataFrame, key: str = "series_id", months: int = 1, features: Sequence[str] = FEATURES_WITH_PRICE) -> DataFrame:
    """The model table: one row per series with its features, parameters, holdout error, shares, status and error."""
    split = frames.holdout_split(feat, key, months).withColumnRenamed(key, "series_id")
    models = squares.fit(split.where("split = 'train'"), ["series_id"], features, "quant")
    test = split.where("split = 'test'").join(models, "series_id").select("series_id", F.col("quant"), _fitted(features).alias("p"))
    off = test.groupBy("series_id").agg(F.sqrt(F.avg((F.col("quant") - F.col("p")) ** 2)).alias("holdout_rmse"))
    rows = split.select("series_id").distinct().join(models, "series_id", "left").join(off, "series_id", "left")
    sound = F.col("mean").isNotNull()
    return rows.select(
        F.col("series_id").cast("string").alias("series_id"),
        F.array(*[F.lit(f) for f in features]).alias("features"),
        F.when(sound, F.to_json(F.struct("mean", "center", "coef"))).alias("params"),
        F.coalesce("train_rows", F.lit(0)).cast("long").alias("train_rows"),
        "holdout_rmse",
        F.col("share").alias("importance"),
        F.when(sound, "ok").otherwise("failed").alias("status"),
        F.when(~sound, F.lit("no training rows")).alias("error"),
    )


def score(feat: DataFrame, models: DataFrame, key: str = "series_id") -> DataFrame:
    """``key, date, prediction`` of all rows of ``feat`` whose series has a sound model; the model's own features."""
    wanted = sorted({*FEATURES_WITH_PRICE} & {*feat.columns})
    named = F.map_from_arrays(F.array(*[F.lit(f) for f in wanted]), _known(wanted)).alias("_known")
    params = F.from_json("params", "mean double, center array<double>, coef array<double>").alias("_m")
    sound = models.where("status = 'ok'").select("series_id", "features", params)
    rows = feat.select(F.col(key).cast("string").alias("series_id"), "date", named).join(sound, "series_id")
    known = F.transform("features", lambda f: F.try_element_at("_known", f))
    found = squares.value(known, F.col("_m.mean"), F.col("_m.center"), F.col("_m.coef"))
    return rows.select("series_id", "date", found.alias("prediction"))


def train_boosted(
    feat: DataFrame, options: boosted.Options = boosted.Options(), key: str = "series_id", months: int = 1, features: Sequence[str] = FEATURES_WITH_PRICE
) -> DataFrame:
    """The model table of boosted trees: one row per series, with its trees as arrays.

    The holdout of ``months`` decides how many rounds a series keeps (``best_round``); ``importance`` is each feature's
    share of the mean gain of its splits, ``gain_share`` that of the summed gain.
    """
    split = frames.holdout_split(feat, key, months)
    test = (F.col("split") == "test").alias("test")
    series = F.col(key).cast("string").alias("series")
    rows = split.where("quant is not null and not isnan(quant)").select(series, "date", _known(features).alias("x"), F.array("quant").alias("y"), test)
    models = boosted.fit(rows, len(features), 1, options)
    found = feat.select(F.col(key).cast("string").alias("series_id")).distinct().join(models, F.col("series_id") == F.col("series"), "left")
    mean = F.zip_with("gains", "splits", lambda g, n: F.when(n > 0, g / n).otherwise(0.0))

    def share(c: Column) -> Column:
        total = F.aggregate(c, F.lit(0.0), lambda a, b: a + b)
        return F.transform(c, lambda v: F.when(total > 0, v / total).otherwise(0.0))

    sound = F.col("trees").isNotNull()
    return found.select(
        "series_id",
        F.array(*[F.lit(f) for f in features]).alias("features"),
        "base",
        "trees",
        F.coalesce("train_rows", F.lit(0)).cast("long").alias("train_rows"),
        "best_round",
        F.col("best_loss").alias("holdout_rmse"),
        share(mean).alias("importance"),
        share(F.col("gains")).alias("gain_share"),
        F.when(sound, "ok").otherwise("failed").alias("status"),
        F.when(~sound, F.lit("no training rows")).alias("error"),
    )


def score_boosted(feat: DataFrame, models: DataFrame, key: str = "series_id", depth: int = 3) -> DataFrame:
    """``key, date, prediction`` of all rows whose series has stored trees, walked by column functions."""
    wanted = sorted({*FEATURES_WITH_PRICE} & {*feat.columns})
    named = F.map_from_arrays(F.array(*[F.lit(f) for f in wanted]), _known(wanted)).alias("_known")
    sound = models.where("status = 'ok'").select("series_id", "features", "base", "trees")
    rows = feat.select(F.col(key).cast("string").alias("series_id"), "date", named).join(sound, "series_id")
    known = F.transform("features", lambda f: F.try_element_at("_known", f))
    return rows.select("series_id", "date", boosted.value(known, F.col("base"), F.col("trees"), depth).alias("prediction"))


def feature_importance(models: DataFrame) -> DataFrame:
    """Each feature's share in its series' model, largest first."""
    zipped = F.explode(F.arrays_zip("features", "importance")).alias("z")
    rows = models.where("status = 'ok'").select("series_id", zipped)
    return rows.select("series_id", F.col("z.features").alias("feature"), F.col("z.importance").alias("importance")).orderBy(
        "series_id", F.col("importance").desc(), "feature"
    )


def model_of(models: DataFrame, series_id: str) -> DataFrame:
    """The model row of one series; a ``KeyError`` if there is none."""
    row = models.where(F.col("series_id") == series_id)
    if row.isEmpty():
        raise KeyError(f"no model for series {series_id}")
    return row


def available_series(models: DataFrame) -> DataFrame:
    return models.select("series_id").distinct().orderBy("series_id")


def direct_pooled(
    feat: DataFrame, as_of: str | date, horizon: int, key: str = "series_id", features: Sequence[str] = ("lag_1", "rolling_mean_3", "day_of_week", "day_of_month"), **options
) -> DataFrame:
    """``key, step, date, prediction``: one distributed fit over all series and steps, with the step and the series'
    mean as features."""
    means = feat.groupBy(key).agg(F.avg("quant").alias("series_mean"))
    names = [*features, "step", "series_mean"]
    long = frames.direct_frame(feat, key, horizon, features, long=True).join(means, key)
    model = pooled.fit(long, names, **options)
    last = frames.last_features(feat, key, features).withColumnRenamed("date", "last_date").join(means, key)
    days = frames.future_calendar(last.select(key, "last_date"), key, as_of, horizon)
    found = pooled.predict(model, last.join(days, key), names)
    return found.select(key, "step", "date", half_even(F.col("prediction")).alias("prediction"))


def hourly(series: DataFrame, cutoff: str, parts: Sequence[str], rounds: int = 20) -> DataFrame:
    """``ts, value, prediction``: one model on calendar features; hours from ``cutoff`` on only decide when to stop."""
    frame = series.withColumn("held_out", F.col("ts") >= F.lit(cutoff).cast("timestamp_ntz"))
    model = pooled.fit(frame, parts, "value", rounds, validation="held_out")
    return pooled.predict(model, frame, parts).select("ts", "value", "held_out", "prediction")
