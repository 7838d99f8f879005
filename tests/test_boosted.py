"""Boosted trees by Spark aggregations against a booster that grows one tree after the other, row by row."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.learners import boosted
from seriesloom.learners.boosted import Options
from seriesloom.operators import features, forecast
from seriesloom.operators.schema import DAILY

FRAME = "series string, date date, x array<double>, y array<double>, test boolean"


def tree(x, residual, edges, o, depth=0):
    """A tree of nested tuples: leaf value, or (feature, threshold, missing left, left, right, gain)."""
    n, total = len(residual), residual.sum()
    value = o.rate * total / (n + o.ridge)
    if depth == o.depth:
        return value
    best = None
    for f in range(x.shape[1]):
        missing = np.isnan(x[:, f])
        for cut in [-np.inf, *edges[f]]:
            below = ~missing & (x[:, f] < cut)
            for left_too in (False, True):
                left = below | missing if left_too else below
                if min(left.sum(), n - left.sum()) < o.least_rows:
                    continue
                part = lambda mask: residual[mask].sum() ** 2 / (mask.sum() + o.ridge)
                gain = part(left) + part(~left) - total**2 / (n + o.ridge)
                if gain > 1e-6 and (best is None or gain > best[0] * (1 + 1e-9)):
                    best = (gain, f, cut, left_too, left)
    if best is None:
        return value
    gain, f, cut, left_too, left = best
    return (f, cut, left_too, tree(x[left], residual[left], edges, o, depth + 1), tree(x[~left], residual[~left], edges, o, depth + 1), gain)


def walk(t, row):
    while isinstance(t, tuple):
        f, cut, left_too, left, right, _ = t
        t = left if (left_too if np.isnan(row[f]) else row[f] < cut) else right
    return t


def gains_of(t, out):
    if isinstance(t, tuple):
        out[t[0]] += t[5]
        gains_of(t[3], out), gains_of(t[4], out)


def booster(x, y, test, edges, o):
    """Trees up to the best round, the best round from 1, its holdout error, and gains by feature."""
    pred, trees, losses = np.full(len(y), o.base), [], []
    for _ in range(o.rounds):
        t = tree(x[~test], (y - pred)[~test], edges, o)
        pred = pred + np.array([walk(t, r) for r in x])
        trees.append(t)
        if o.patience is not None and test.any():
            losses.append(np.sqrt(np.mean((y - pred)[test] ** 2)))
            if len(losses) - 1 - int(np.argmin(losses)) >= o.patience:
                break
    kept = int(np.argmin(losses)) + 1 if losses else len(trees)
    gains = np.zeros(x.shape[1])
    for t in trees[:kept]:
        gains_of(t, gains)
    return trees[:kept], kept, min(losses, default=None), gains


def made(seed, n, steps, holdout=0):
    rnd = np.random.default_rng(seed)
    x = np.column_stack([rnd.normal(size=n), rnd.integers(0, 7, n), np.full(n, 19.99), rnd.normal(size=n) * 100])
    x[rnd.random(x.shape) < 0.1] = np.nan
    y = np.column_stack([np.nan_to_num(x[:, 0]) * (3 + h) + (x[:, 1] > 3) * 10 + np.isnan(x[:, 3]) * 7 + rnd.normal(size=n) for h in range(steps)])
    return x, y, np.arange(n) >= n - holdout


def frame(spark, data):
    rows = []
    for name, (x, y, test) in data.items():
        rows += [(name, date(2020, 1, 1) + timedelta(days=i), [None if np.isnan(v) else float(v) for v in x[i]], y[i].tolist(), bool(test[i])) for i in range(len(x))]
    return spark.createDataFrame(rows, FRAME).repartition(5)


def scored(spark, models, data, depth):
    rows = [(name, i, [float(v) for v in r]) for name, (x, _, _) in data.items() for i, r in enumerate(x)]
    asked = spark.createDataFrame(rows, "series string, i int, known array<double>")
    found = asked.join(models, "series").select("series", "step", "i", boosted.value(F.col("known"), F.col("base"), F.col("trees"), depth).alias("p"))
    return {(r["series"], r["step"], r["i"]): r["p"] for r in found.collect()}


def check(spark, data, o, steps):
    models = boosted.fit(frame(spark, data), 4, steps, o)
    rows = {(r["series"], r["step"]): r for r in models.collect()}
    found = scored(spark, models, data, o.depth)
    assert len(rows) == len(data) * steps
    for name, (x, y, test) in data.items():
        for step in range(steps):
            edges = [np.unique(np.quantile(c[~np.isnan(c)], np.arange(o.bins - 1) / (o.bins - 1), method="inverted_cdf")) for c in x[~test].T]
            trees, kept, loss, gains = booster(x, y[:, step], test, edges, o)
            r = rows[name, step]
            assert r["best_round"] == kept and r["train_rows"] == (~test).sum()
            assert r["gains"] == pytest.approx(gains, rel=1e-6, abs=1e-3)
            if loss is not None:
                assert r["best_loss"] == pytest.approx(loss, rel=1e-6)
            want = [o.base + sum(walk(t, row) for t in trees) for row in x]
            assert [found[name, step, i] for i in range(len(x))] == pytest.approx(want, rel=1e-6, abs=1e-6)
    return rows


def test_three_series_and_two_steps_equal_row_by_row_growth(spark, monkeypatch):
    """Several blocks a series, and several tables of residuals."""
    monkeypatch.setattr(boosted, "BLOCK_DAYS", 64)
    monkeypatch.setattr(boosted, "EVERY", 2)
    data = {name: made(i, n, 2) for i, (name, n) in enumerate({"a": 200, "b": 90, "c": 25}.items())}
    check(spark, data, Options(rounds=5, rate=0.3, patience=None, bins=16), 2)


@pytest.mark.parametrize("broadcast", [0, 1 << 20])
def test_holdout_stops_a_series_that_overfits(spark, monkeypatch, broadcast):
    monkeypatch.setattr(boosted, "EVERY", 3)
    monkeypatch.setattr(boosted, "BROADCAST", broadcast)
    rnd = np.random.default_rng(5)
    x, y, test = made(9, 120, 1, 30)
    noise = (x, rnd.normal(size=(120, 1)) * 50, test)
    o = Options(rounds=14, rate=0.5, patience=3, bins=16)
    rows = check(spark, {"signal": (x, y, test), "noise": noise}, o, 1)
    assert rows["noise", 0]["best_round"] < rows["signal", 0]["best_round"]


def test_trees_do_not_depend_on_the_partitions(spark):
    data = {"a": made(1, 150, 1)}
    o = Options(rounds=3, rate=0.3, patience=None)
    one, other = (boosted.fit(frame(spark, data).repartition(n), 4, 1, o).first() for n in (1, 7))
    assert one["trees"] == other["trees"] and one["gains"] == other["gains"]


def test_odd_frames(spark):
    """A constant target, a single row, a series of holdout rows only, no rows."""
    flat = (np.full((40, 4), 1.0), np.full((40, 1), 3.0), np.zeros(40, bool))
    single = (np.full((1, 4), np.nan), np.full((1, 1), 8.0), np.zeros(1, bool))
    held = (np.full((5, 4), 1.0), np.full((5, 1), 3.0), np.ones(5, bool))
    o = Options(rounds=2, rate=0.5, patience=None)
    rows = {r["series"]: r for r in boosted.fit(frame(spark, {"flat": flat, "single": single, "held": held}), 4, 1, o).collect()}
    assert set(rows) == {"flat", "single"} and rows["flat"]["gains"] == [0.0] * 4
    assert boosted.fit(frame(spark, {}), 4, 1, o).count() == 0


def daily(spark, values, name):
    rows = [(name, date(2024, 1, 1) + timedelta(days=i), float(v), 1.0, f"{name}-item") for i, v in enumerate(values)]
    return spark.createDataFrame(rows, DAILY)


def test_forecasts_and_stored_models(spark):
    weekly = [20 + 10 * (i % 7 == 0) for i in range(150)]
    feat = features.add_features(daily(spark, weekly, "w").union(daily(spark, [3] * 150, "c")).union(daily(spark, [1] * 3, "short")), include_current=False)
    o = Options(rounds=12, rate=0.5, patience=4)
    rows = forecast.direct_boosted(feat, "2024-05-29", 7, o).collect()
    by = {(r["series_id"], r["step"]): r["prediction"] for r in rows if r["status"] == "ok"}
    assert [by["c", s] for s in range(1, 8)] == [3] * 7
    assert [by["w", s] for s in range(1, 8)] == [20 + 10 * ((149 + s) % 7 == 0) for s in range(1, 8)]
    assert [(r["series_id"], r["error"]) for r in rows if r["status"] != "ok"] == [("short", "no training rows")]
    models = forecast.train_boosted(feat, o).cache()
    known = {r["series_id"]: r for r in models.collect()}
    assert known["w"]["status"] == "ok" and 1 <= known["w"]["best_round"] <= 12 and known["short"]["status"] == "failed"
    assert sum(known["w"]["importance"]) == pytest.approx(1) and sum(known["w"]["gain_share"]) == pytest.approx(1)
    told = {r["feature"]: r["importance"] for r in forecast.feature_importance(models).where("series_id = 'w'").collect()}
    assert max(told, key=told.get) == "day_of_week"
    scores = {(r["series_id"], r["date"]): r["prediction"] for r in forecast.score_boosted(feat, models).collect()}
    assert scores["w", date(2024, 5, 27)] == pytest.approx(30, abs=1.5) and len(scores) == 300
    plan = forecast.score_boosted(feat, models)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    ahead = forecast.recursive(feat, "2024-05-29", 7, trees=o).where("series_id = 'w'").orderBy("step").collect()
    assert [r["prediction"] for r in ahead] == [by["w", s] for s in range(1, 8)]
