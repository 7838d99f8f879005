"""From order lines to clean daily series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesloom.functions.scalar import lenient_date
from seriesloom.operators.schema import RAW_COLUMNS, require_columns

MAX_ZERO_RUN = 7


def canonicalise(raw: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Canonical column names; other columns go."""
    mapping = mapping or RAW_COLUMNS
    require_columns(raw, mapping, "order lines")
    return raw.select(*[F.col(old).alias(new) for old, new in mapping.items()])


def normalise_date(lines: DataFrame, column: str = "ts", mode: str = "wall_clock") -> DataFrame:
    return lines.withColumn("date", lenient_date(column, mode))


def daily_collapse(lines: DataFrame, key: str = "series_id", carry: str | None = "item_ref") -> DataFrame:
    """One row per series and day: summed quantity and unit price, and the day's newest non-null ``carry``.

    Rows without a key or a date drop out; an all-null quantity sums to zero. Sums combine before the shuffle.
    """
    require_columns(lines, [key, "date", "quant", "price"], "order lines")
    sums = [F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("quant", "price")]
    if carry:
        newest = F.when(F.col(carry).isNotNull(), F.struct("ts", "order_id", carry))
        sums.append(F.max(newest)[carry].alias(carry))
    return lines.where(F.col(key).isNotNull() & F.col("date").isNotNull()).groupBy(key, "date").agg(*sums)


def dedup_daily(rows: DataFrame, key: str = "series_id", order: tuple[str, ...] = ("ts", "order_id", "quant", "price")) -> DataFrame:
    """The first row of each series and day by ``order``."""
    first = F.row_number().over(W.partitionBy(key, "date").orderBy(*order))
    return rows.withColumn("_n", first).where("_n = 1").drop("_n")


def _spread(rows: DataFrame, daily: DataFrame, key: str) -> DataFrame:
    """``rows`` with the series' earliest ``item_ref`` on every row."""
    if "item_ref" not in daily.columns:
        return rows
    whole = W.partitionBy(key).orderBy("date").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return rows.withColumn("item_ref", F.first("item_ref", ignorenulls=True).over(whole))


def densify(daily: DataFrame, key: str = "series_id", fill: float = 0.0) -> DataFrame:
    """Every day between a series' first and last; missing days get ``fill`` as quantity and price."""
    spans = daily.groupBy(key).agg(F.min("date").alias("_a"), F.max("date").alias("_b"))
    days = spans.select(key, F.explode(F.sequence("_a", "_b")).alias("date"))
    filled = days.join(daily, [key, "date"], "left").fillna(fill, ["quant", "price"])
    return _spread(filled, daily, key)


def mark_zero_runs(dense: DataFrame, key: str = "series_id", max_zero_run: int = MAX_ZERO_RUN) -> DataFrame:
    """``dense`` with the quantity null in runs of more than ``max_zero_run`` zero days.

    Days of a run differ from their rank among the zero days by the same amount.
    """
    zero = F.col("quant") == 0
    rank = F.row_number().over(W.partitionBy(key, zero).orderBy("date"))
    island = F.date_sub("date", rank)
    marked = dense.withColumn("_zero", zero).withColumn("_island", island)
    length = F.count("*").over(W.partitionBy(key, "_zero", "_island"))
    marked = marked.withColumn("_long", F.col("_zero") & (length > max_zero_run))
    return marked.withColumn("quant", F.when(~F.col("_long"), F.col("quant"))).drop("_zero", "_island", "_long")


def clean_dense(daily: DataFrame, key: str = "series_id", max_zero_run: int = MAX_ZERO_RUN) -> DataFrame:
    return mark_zero_runs(densify(daily, key), key, max_zero_run).dropna(subset=["quant"])


def clean_sparse(daily: DataFrame, key: str = "series_id", max_zero_run: int = MAX_ZERO_RUN) -> DataFrame:
    """What ``clean_dense`` gives, without making the days that it would remove.

    A zero run is what lies between consecutive days with sales (or a series' ends), so only gaps of up to
    ``max_zero_run`` days are filled. Zero days of the input keep their price. One shuffle by series serves all windows;
    each row then makes the missing days that follow it.
    """
    ordered, backward, whole = W.partitionBy(key).orderBy("date"), W.partitionBy(key).orderBy(F.col("date").desc()), W.partitionBy(key)
    sold = F.when(F.coalesce(F.col("quant"), F.lit(0.0)) != 0, F.col("date"))
    marks = {
        "_next": F.lead("date").over(ordered),
        "_a": F.coalesce(F.last(sold, ignorenulls=True).over(ordered.rowsBetween(W.unboundedPreceding, 0)), F.date_sub(F.min("date").over(whole), 1)),
        "_b": F.coalesce(F.last(sold, ignorenulls=True).over(backward.rowsBetween(W.unboundedPreceding, -1)), F.date_add(F.max("date").over(whole), 1)),
    }
    if "item_ref" in daily.columns:
        named = F.struct("date", "item_ref")
        marks["_item"] = F.min(F.when(F.col("item_ref").isNotNull(), named)).over(whole)["item_ref"]
    rows = daily.withColumns(marks)
    # Between the last sale up to this row and the first one after it lies the zero run that this row or the days after it belong to.
    short = F.datediff("_b", "_a") - 1 <= max_zero_run
    zero = F.coalesce(F.col("quant"), F.lit(0.0)) == 0
    own = F.when(~zero | short, F.array(F.struct(F.col("date").alias("date"), F.lit(True).alias("own")))).otherwise(F.array())
    missing = F.when(short & (F.datediff("_next", "date") > 1), F.sequence(F.date_add("date", 1), F.date_sub("_next", 1))).otherwise(F.array().cast("array<date>"))
    later = F.transform(missing, lambda d: F.struct(d.alias("date"), F.lit(False).alias("own")))
    made = rows.select("*", F.explode(F.concat(own, later)).alias("_day"))

    def column(c: str):
        if c == key:
            return F.col(c)
        if c == "date":
            return F.col("_day.date").alias(c)
        if c == "item_ref":
            return F.col("_item").alias(c)
        known = F.when(F.col("_day.own"), F.col(c))
        return (F.coalesce(known, F.lit(0.0)) if c in ("quant", "price") else known).alias(c)

    return made.select(*[column(c) for c in daily.columns])


def process(raw: DataFrame, date_mode: str = "wall_clock", max_zero_run: int = MAX_ZERO_RUN, mapping: dict[str, str] | None = None) -> DataFrame:
    """Raw order lines to clean daily series."""
    lines = normalise_date(canonicalise(raw, mapping), "ts", date_mode)
    return clean_sparse(daily_collapse(lines), "series_id", max_zero_run)
