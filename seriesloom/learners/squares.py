"""Least squares on several features for each group and step, from sums that Spark combines before its shuffle.

No group is ever held whole: a group is its counts and sums of products. The rows of all steps share their features, so
one set of products of features serves every step, and each step adds its sums with the target alone. Only the small
system of each group is solved outside the JVM, one row per group.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Directions in which the standardised features vary less than this are left out of a solution.
TOLERANCE = 1e-9

SOLVED = "mean array<double>, center array<double>, coef array<array<double>>, share array<array<double>>"


def _solution(moments: pd.Series, size: int, steps: int) -> pd.DataFrame:
    """Means, centres, slopes and shares of each group from ``n``, sums of y, x, x y and x x, and the least x and y."""
    pairs = list(combinations_with_replacement(range(size), 2))
    widths = np.cumsum([1, steps, size, size * steps, len(pairs), size])
    rows = []
    for m in moments:
        n, y, x, xy, xx, low, floor = np.split(np.asarray(m, float), widths)
        n, xy = n[0], xy.reshape(size, steps)
        square = np.zeros((size, size))
        for (i, j), value in zip(pairs, xx, strict=True):
            square[i, j] = square[j, i] = value
        spread = square - np.outer(x, x) / n
        scale = np.sqrt(np.maximum(np.diag(spread), 0))
        live = scale > TOLERANCE * np.sqrt(np.maximum(np.diag(square), 1e-300))
        coef = np.zeros((steps, size))
        if live.any():
            s = scale[live]
            inverse = np.linalg.pinv(spread[np.ix_(live, live)] / np.outer(s, s), rcond=TOLERANCE, hermitian=True)
            coef[:, live] = (inverse @ ((xy - np.outer(x, y) / n)[live] / s[:, None]) / s[:, None]).T
        weight = np.abs(coef) * scale
        total = weight.sum(axis=1, keepdims=True)
        share = np.where(total > 0, weight / np.where(total > 0, total, 1), 1 / size)
        rows.append(((floor[0] + y / n).tolist(), (low + x / n).tolist(), coef.tolist(), share.tolist()))
    return pd.DataFrame(rows, columns=["mean", "center", "coef", "share"])


def shifted(frame: DataFrame, by: Sequence[str], features: Sequence[str], y: Column) -> DataFrame:
    """``frame`` with ``_y`` (targets of all steps, null: not a training row), ``_w`` (all features known), and both less
    their least value in the group, so that sums of products lose no digits and a constant feature is exactly zero."""
    group = W.partitionBy(*by)
    x = [F.col(f).cast("double") for f in features]
    whole = F.col("_y").isNotNull()
    for c in x:
        whole = whole & c.isNotNull()
    rows = frame.withColumn("_y", y).withColumn("_w", whole)
    low = {f"_l{i}": F.min(F.when(F.col("_w"), c)).over(group) for i, c in enumerate(x)}
    rows = rows.withColumns(low | {"_floor": F.min(F.array_min("_y")).over(group)})
    away = {f"_x{i}": F.when(F.col("_w"), c - F.col(f"_l{i}")) for i, c in enumerate(x)}
    return rows.withColumns(away | {"_d": F.transform("_y", lambda v: v - F.col("_floor"))})


def sums(size: int, steps: int) -> list[Column]:
    """Aggregates of ``shifted`` rows: ``train_rows``, ``_m``, and the steps' plain means ``_all``."""
    x, y = [F.col(f"_x{i}") for i in range(size)], [F.get("_d", F.lit(h)) for h in range(steps)]
    own = lambda c: F.when(F.col("_w"), c)
    m = [F.count_if("_w").cast("double"), *[F.sum(own(v)) for v in y], *map(F.sum, x)]
    m += [F.sum(c * v) for c in x for v in y]
    m += [F.sum(a * b) for a, b in combinations_with_replacement(x, 2)]
    m += [*[F.max(f"_l{i}") for i in range(size)], F.max("_floor")]
    plain = [F.avg(v) + F.max("_floor") for v in y]
    return [F.count("_y").alias("train_rows"), F.array(*m).alias("_m"), F.array(*plain).alias("_all")]


def solved(groups: DataFrame, size: int, steps: int) -> DataFrame:
    """``mean, center, coef, share`` of groups with ``sums``: arrays by step, null where there is no training row."""
    some = F.col("_m")[0] > 0
    width = 1 + steps + size + size * steps + size * (size + 1) // 2 + size + 1
    safe = F.when(some, F.col("_m")).otherwise(F.array(F.lit(1.0), *[F.lit(0.0)] * (width - 1)))
    solve = F.pandas_udf(lambda m: _solution(m, size, steps), SOLVED)
    rows = groups.withColumn("_s", solve(safe))
    trained = F.col("train_rows") > 0
    mean = F.when(some, F.col("_s.mean")).when(trained, F.col("_all"))
    found = {"mean": mean, **{c: F.when(trained, F.col(f"_s.{c}")) for c in ("center", "coef", "share")}}
    return rows.withColumns(found).drop("_m", "_s", "_all")


def fit(frame: DataFrame, by: Sequence[str], features: Sequence[str], target: str = "y") -> DataFrame:
    """``by, train_rows, mean, center, coef, share``: the target's mean, the features' means, slopes, shares of the spread.

    Rows without a target are left out, and those without all features count for ``mean`` only if there are no others.
    Constant features, and what others say already, get a slope of zero.
    """
    own = F.col(target).cast("double")
    rows = shifted(frame.where(own.isNotNull()), by, features, F.array(own))
    groups = solved(rows.groupBy(*by).agg(*sums(len(features), 1)), len(features), 1)
    return groups.withColumns({c: F.col(c)[0] for c in ("mean", "coef", "share")}).select(*by, "train_rows", "mean", "center", "coef", "share")


def value(known: Column, mean: Column, center: Column, coef: Column) -> Column:
    """The fitted value at an array of features; one that is null counts as its mean."""
    parts = F.zip_with(known, center, lambda a, b: F.coalesce(a - b, F.lit(0.0)))
    terms = F.zip_with(parts, coef, lambda a, b: a * b)
    return F.aggregate(terms, mean, lambda total, term: total + term)
