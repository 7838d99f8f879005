"""Mixing sources to target weights along a curriculum that changes over training time.

Every source has a base weight and a weight schedule over training time 0..1. The base weights share the word budget
between the sources; a target stops at ``max_repeat`` times what its source holds and the excess goes to the others by
weight. Within a source, documents follow one another in a pseudo-random order, again and again until the target is
reached. The integral of the source's schedule says how many of its words are due by any time; inverting it gives each
document its training position, and sorting by position gives the training order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesloom.llm.common import WORD, Aside

#: Base weights, repeating over the sources in code-point order.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEAT = 2.0
#: Knots of the schedule: time, and the factors on the base weight, repeating over the sources like the weights.
SCHEDULE = ((0.0, (1.0, 0.5, 1.5)), (0.5, (1.0, 1.0, 1.0)), (1.0, (1.0, 1.5, 0.5)))
#: A source's documents are summed in so many hash ranges first, so that no window holds a whole source.
RANGE_DIGITS = 3
ADDED = ("size", "source_size", "target", "taken", "positions")


def _cycled(values: Sequence[float], rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.pmod(rank, F.lit(len(values))) + 1).cast("int"))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MAX_REPEAT) -> DataFrame:
    """``source, source_size`` -> the same with ``rank`` (0-based, code-point order, null last) and ``target``.

    Sources are sorted by the level at which they fill up; below the first that does not, all are full, and what is
    left of the budget goes to the rest by weight. There is one row per source here, so one task holds them.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("_w", _cycled(weights, F.col("rank"))).withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    full = W.orderBy(F.col("_cap") / F.col("_w"), "rank")
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing).orderBy(F.lit(0))
    before = F.coalesce(F.sum("_cap").over(full.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("_w").over(full.rowsBetween(W.currentRow, W.unboundedFollowing))
    leveled = ranked.withColumn("_budget", F.sum("source_size").over(every) * F.lit(float(share)))
    leveled = leveled.withColumn("_level", (F.col("_budget") - before) / rest)
    open_ = F.when(F.col("_cap") > F.col("_level") * F.col("_w"), F.col("_level"))
    level = F.first(open_, ignorenulls=True).over(full.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    target = F.when(level.isNull(), F.col("_cap")).otherwise(F.least("_cap", level * F.col("_w")))
    return leveled.select("source", "source_size", "rank", target.alias("target"))


def due_time(share: Column, rank: Column, schedule=SCHEDULE) -> Column:
    """Time by which ``share`` (0..1) of a source's words is due: the schedule's integral, inverted.

    Between two knots the weight is linear, so the integral is quadratic; the root is taken in the form that also
    holds where the weight is constant.
    """
    factors = [_cycled(f, rank) for _, f in schedule]
    areas = [
        (factors[i] + factors[i + 1]) * F.lit((schedule[i + 1][0] - schedule[i][0]) / 2) for i in range(len(schedule) - 1)
    ]
    want = share * sum(areas[1:], areas[0])
    pieces, start = [], F.lit(0.0)
    for i, area in enumerate(areas):
        t0, t1 = schedule[i][0], schedule[i + 1][0]
        left, slope = want - start, (factors[i + 1] - factors[i]) / F.lit(t1 - t0)
        root = F.sqrt(F.greatest(factors[i] * factors[i] + F.lit(2.0) * slope * left, F.lit(0.0)))
        step = F.try_divide(F.lit(2.0) * left, factors[i] + root)
        pieces.append((want <= start + area, F.lit(t0) + F.coalesce(step, F.lit(0.0))))
        start = start + area
    out = F.lit(float(schedule[-1][0]))
    for inside, at in reversed(pieces):
        out = F.when(inside, at).otherwise(out)
    return F.least(F.greatest(out, F.lit(0.0)), F.lit(1.0))


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_repeat: float = MAX_REPEAT,
    schedule=SCHEDULE,
) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target``, ``taken`` (words, repeats counted) and ``positions``
    (training time of each use of the document, ascending; empty if the mix leaves it out).

    A document is used in a pass over its source if its middle lies before the target, so a source misses its target
    by half a document at most. An empty table gives an empty one; texts may be of any length. Null texts have no
    words; they and empty texts are never used. Null sources are one source, weighed last. The order within a source
    is by a digest of the key, so reruns agree; repeated keys are ordered by size. Columns of the given names are
    replaced. No shuffle holds a source in one task: sums go over hash ranges of a source first.
    """
    aside = Aside(docs)
    docs, key, text, source, keep = aside.docs, aside[key], aside[text], aside[source], aside.kept(ADDED)
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    sized = docs.select(
        *keep,
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        digest.alias("_order"),
        F.col(source).alias("_source"),
    )
    sized = sized.withColumn("_range", F.substring("_order", 1, RANGE_DIGITS))
    ranges = sized.groupBy("_source", "_range").agg(F.sum("size").alias("_sum"))
    earlier = W.partitionBy("_source").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("_source")
    offsets = ranges.select(
        "_source",
        "_range",
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"),
        F.sum("_sum").over(whole).alias("source_size"),
    )
    sources = ranges.groupBy(F.col("_source").alias("source")).agg(F.sum("_sum").alias("source_size"))
    goals = targets(sources, weights, share, max_repeat)
    offsets = offsets.join(
        goals.select(F.col("source").alias("_s"), "rank", "target"), F.col("_source").eqNullSafe(F.col("_s"))
    ).drop("_s")
    offsets = offsets.select(F.col("_source").alias("_s"), F.col("_range").alias("_r"), "_base", "source_size", "target", "rank")
    here = W.partitionBy("_source", "_range").orderBy("_order", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = sized.withColumn("_upto", F.sum("size").over(here))
    placed = placed.join(offsets, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r")))
    middle = F.col("_base") + F.col("_upto") - F.col("size") / F.lit(2.0)
    passes = F.sequence(F.lit(0), F.lit(max(0, int(-(-max_repeat // 1)) - 1)))
    at = lambda p: middle + p * F.col("source_size")
    used = F.filter(passes, lambda p: (F.col("size") > 0) & (at(p) < F.col("target")))
    out = placed.select(
        *keep,
        "size",
        "source_size",
        "target",
        (F.size(used) * F.col("size")).cast("long").alias("taken"),
        F.transform(used, lambda p: due_time(at(p) / F.col("target"), F.col("rank"), schedule)).alias("positions"),
    )
    return aside.back(out, ADDED)


def training_order(mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per use of a document, range-sorted by training ``position`` (ties by key)."""
    return mixed.withColumn("position", F.explode("positions")).drop("positions").orderBy("position", key)
