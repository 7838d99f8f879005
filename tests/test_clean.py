from __future__ import annotations

import random
from datetime import date, timedelta

import pytest

from seriesloom.functions.scalar import half_even
from seriesloom.operators import clean, features, frames, gates, profile, quality
from seriesloom.operators.schema import DAILY, RAW, require_columns, require_dated, require_raw
from pyspark.sql import functions as F


def day(month: int, n: int) -> date:
    return date(2024, month, n)


def daily(spark, rows, series="a"):
    return spark.createDataFrame([(series, d, float(q), float(p), "s") for d, q, p in rows], DAILY)


def lines(spark, rows):
    """(series, date text, quantity, price, item) with order ids in order."""
    raw = [(str(i), d, "T", item, q, p, s) for i, (s, d, q, p, item) in enumerate(rows)]
    return clean.normalise_date(clean.canonicalise(spark.createDataFrame(raw, RAW)))


def cleaned(spark, rows, **options):
    found = clean.clean_sparse(daily(spark, rows), **options).orderBy("date").collect()
    return [(r["date"], r["quant"], r["price"]) for r in found]


def test_run_of_seven_stays_and_of_eight_goes(spark):
    assert len(cleaned(spark, [(day(1, 1), 5, 1), (day(1, 9), 3, 1)])) == 9
    assert [r[0] for r in cleaned(spark, [(day(1, 1), 5, 1), (day(1, 10), 3, 1)])] == [day(1, 1), day(1, 10)]


def test_lag_skips_a_removed_run(spark):
    rows = features.add_features(clean.clean_sparse(daily(spark, [(day(1, 1), 5, 1), (day(1, 10), 3, 1)])))
    assert rows.where(F.col("date") == day(1, 10)).first()["lag_1"] == 5


def test_real_zero_days(spark):
    assert len(cleaned(spark, [(day(1, 1), 2, 1), (day(1, 5), 0, 10), (day(1, 10), 1, 1)])) == 2
    kept = cleaned(spark, [(day(1, 1), 2, 1), (day(1, 5), 0, 10), (day(1, 9), 1, 1)])
    assert len(kept) == 9
    assert {d: p for d, _, p in kept}[day(1, 5)] == 10
    assert cleaned(spark, [(day(1, n), 0, 1) for n in range(1, 9)] + [(day(1, 9), 4, 1)]) == [(day(1, 9), 4.0, 1.0)]


@pytest.mark.parametrize("seed", range(6))
def test_sparse_equals_dense(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for s in "abc":
        at = date(2024, 1, 1)
        for _ in range(rnd.randint(1, 25)):
            rows.append((s, at, float(rnd.choice([0, 0, 1, 5])), float(rnd.randint(1, 9)), rnd.choice(["x", "y", None])))
            at += timedelta(days=rnd.choice([1, 1, 2, 7, 8, 9, 20]))
    df = spark.createDataFrame(rows, DAILY)
    columns = ["series_id", "date", "quant", "price", "item_ref"]
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, clean.clean_sparse(df).select(columns).collect()), key=key) == sorted(
        map(tuple, clean.clean_dense(df).select(columns).collect()), key=key
    )


def test_collapse_sums_and_newest_item(spark):
    rows = clean.daily_collapse(lines(spark, [("a", "2024-01-01", 2.0, 10.0, "A"), ("a", "2024-01-01 10:00:00", 3.0, 12.0, "B")])).collect()
    assert [(r["quant"], r["price"], r["item_ref"]) for r in rows] == [(5.0, 22.0, "B")]
    with_price = features.add_features(clean.daily_collapse(lines(spark, [("a", "2024-01-01", 5.0, 22.0, "A")])))
    assert with_price.first()["price_per_unit"] == pytest.approx(4.4)


def test_bad_keys_and_dates_drop_out(spark):
    rows = [(None, "2024-01-01", 1.0, 1.0, "A"), ("a", None, 1.0, 1.0, "A"), ("a", "garbage", 1.0, 1.0, "A"), ("a", "2024-01-02", None, 1.0, None)]
    found = clean.daily_collapse(lines(spark, rows)).collect()
    assert [(r["series_id"], r["date"], r["quant"], r["item_ref"]) for r in found] == [("a", day(1, 2), 0.0, None)]


def test_date_modes(spark):
    df = spark.createDataFrame([("2024-01-01 23:30:00-03:00",)], "ts string")
    assert clean.normalise_date(df).first()["date"] == day(1, 1)
    assert clean.normalise_date(df, mode="utc").first()["date"] == day(1, 2)


def test_features(spark):
    rows = features.add_features(daily(spark, [(day(1, n + 1), q, 1) for n, q in enumerate([1, 2, 6, 3])])).orderBy("date").collect()
    assert [r["lag_1"] for r in rows] == [None, 1, 2, 6]
    assert [r["rolling_mean_3"] for r in rows] == [None, None, 3, pytest.approx(11 / 3)]
    shifted = features.add_features(daily(spark, [(day(1, n + 1), q, 1) for n, q in enumerate([1, 2, 6, 3])]), include_current=False)
    assert [r["rolling_mean_3"] for r in shifted.orderBy("date").collect()] == [None, None, None, 3]
    assert features.add_features(daily(spark, [(day(1, 1), 0, 7)])).first()["price_per_unit"] is None
    weekdays = features.add_features(daily(spark, [(day(1, 1), 1, 1), (day(1, 7), 1, 1)])).orderBy("date").collect()
    assert [r["day_of_week"] for r in weekdays] == [0, 6]


def test_series_do_not_mix(spark):
    both = daily(spark, [(day(1, 1), 1, 1), (day(1, 3), 2, 1)]).union(daily(spark, [(day(1, 2), 9, 1)], "b"))
    assert {(r["series_id"], r["date"]): r["lag_1"] for r in features.add_features(both).collect()} == {
        ("a", day(1, 1)): None, ("a", day(1, 3)): 1.0, ("b", day(1, 2)): None,
    }


def test_direct_frame_and_tails(spark):
    series = daily(spark, [(day(1, n), n, 1) for n in range(1, 6)])
    wide = frames.direct_frame(series, horizon=2, features=["quant"]).orderBy("date").collect()
    assert [r["y"] for r in wide] == [[2, 3], [3, 4], [4, 5]]
    for values, want in (([4], [4, 4, 4]), ([1, 2], [2, 2, 2]), ([1, 2, 3, 4], [2, 3, 4])):
        tail = frames.last_values(daily(spark, [(day(1, n + 1), v, 1) for n, v in enumerate(values)]))
        assert tail.first()["last_values"] == want


def test_splits_and_future(spark):
    series = daily(spark, [(day(2, 28), 1, 1), (day(2, 29), 1, 1), (day(3, 31), 1, 1)])
    assert [r["split"] for r in frames.holdout_split(series).orderBy("date").collect()] == ["train", "test", "test"]
    last = spark.createDataFrame([("a", day(6, 10))], "series_id string, last_date date")
    by = lambda anchor: [r["date"] for r in frames.future_calendar(last, "series_id", "2024-06-30", 3, anchor).orderBy("step").collect()]
    assert by("as_of") == [day(7, 1), day(7, 2), day(7, 3)]
    assert by("last_date") == [day(6, 11), day(6, 12), day(6, 13)]


def test_gates(spark):
    def reason(last, rows):
        p = spark.createDataFrame([("a", day(1, 1), last, rows, 100, 0)], "series_id string, first_date date, last_date date, rows long, span_days int, missing_target long")
        return gates.gate_direct(p, "2024-06-30", 30).first()["gate_reason"]

    assert reason(day(5, 31), 45) == "ok"
    assert reason(day(5, 30), 45) == "inactive"
    assert reason(day(5, 31), 44) == "insufficient"
    gated = spark.createDataFrame([("a", "ok"), ("b", "inactive"), ("c", "ok")], "series_id string, gate_reason string")
    assert {r["gate_reason"]: r["series"] for r in gates.summary(gated).collect()} == {"ok": 2, "inactive": 1, "total": 3}
    assert gates.passing(gated.select("series_id"), gated).count() == 2


def test_recursive_gate_order(spark):
    profile_ = spark.createDataFrame(
        [("short", day(1, 1), day(6, 30), 100, 181, 0), ("old", date(2022, 1, 1), day(1, 1), 100, 730, 0), ("few", date(2023, 1, 1), day(6, 30), 9, 546, 0), ("ok", date(2023, 1, 1), day(6, 30), 50, 546, 0)],
        "series_id string, first_date date, last_date date, rows long, span_days int, missing_target long",
    )
    trains = spark.createDataFrame([("short", 50, 5), ("old", 50, 5), ("few", 9, 0), ("ok", 40, 10)], "series_id string, train_rows long, test_rows long")
    found = {r["series_id"]: r["gate_reason"] for r in gates.gate_recursive(profile_, trains, "2024-06-30").collect()}
    assert found == {"short": "short_span", "old": "inactive", "few": "insufficient", "ok": "ok"}


def test_rounding(spark):
    df = spark.createDataFrame([(5.4,), (5.6,), (2.5,), (3.5,), (float("nan"),), (None,)], "x double")
    assert [r[0] for r in df.select(half_even(F.col("x"))).collect()] == [5, 6, 2, 4, None, None]


@pytest.mark.parametrize("age, status", [(2, "fresh"), (3, "aging"), (7, "aging"), (8, "stale")])
def test_freshness_levels(spark, age, status):
    df = spark.createDataFrame([("2024-06-01",), ("garbage",)], "date string")
    assert quality.freshness_levels(df, date(2024, 6, 1) + timedelta(days=age)).first()["status"] == status


def test_freshness_edges(spark):
    assert quality.freshness_levels(spark.createDataFrame([("x",)], "date string"), "2024-06-01").first()["status"] == "unparseable"
    assert quality.freshness_levels(spark.createDataFrame([("x",)], "y string"), "2024-06-01").first()["status"] == "no_date"
    assert quality.freshness(daily(spark, [(day(6, 1), 1, 1)]), "2024-07-01").first()["status"] == "fresh"
    assert quality.freshness(daily(spark, [(day(6, 1), 1, 1)]), "2024-07-02").first()["status"] == "stale"
    assert quality.freshness(daily(spark, []), "2024-07-02").first()["status"] == "empty"


def test_sku_contract(spark):
    rows = lines(spark, [("a", "2024-01-01", 1.0, 1.0, "A"), ("a", "2024-01-01 09:00:00", 1.0, 1.0, "B"), ("b", "2024-01-01", 1.0, 1.0, "A")])
    assert [tuple(r) for r in quality.sku_contract(rows).collect()] == [("a", 2)]


def test_date_range_fallbacks(spark):
    df = daily(spark, [(day(1, 1), 1, 1)]).union(daily(spark, [(day(3, 1), 1, 1)], "b"))
    assert tuple(profile.date_range_of(df, "b", "2024-09-09").first()) == (day(3, 1), day(3, 1))
    assert tuple(profile.date_range_of(df, "zzz", "2024-09-09").first()) == (day(1, 1), day(3, 1))
    assert tuple(profile.date_range_of(df.limit(0), "b", "2024-09-09").first()) == (day(9, 9), day(9, 9))


def test_box_summary(spark):
    df = spark.createDataFrame([(1, float(v)) for v in (1, 2, 3, 10)], "g int, v double")
    r = profile.box_summary(df, "g", "v").first()
    assert (r["q1"], r["median"], r["q3"], r["whisker_low"], r["whisker_high"], r["outliers"], r["n"]) == (1.75, 2.5, 4.75, 1, 3, 1, 4)


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (None,)], "quant double")
    assert [tuple(r) for r in profile.histogram(df).collect()] == [(1, 2)]


def test_slices_and_pages(spark):
    df = daily(spark, [(day(1, n), n, 1) for n in range(1, 11)])
    assert profile.forecast_slice(df, "a", "2024-01-03", "2024-01-05").count() == 3
    assert profile.forecast_slice(df, "a", "2024-01-03").count() == 10
    assert [r["quant"] for r in profile.page(df, ["date", "quant"], ["date"], 3, 1).collect()] == [4, 5, 6]


def test_checks(spark):
    df = daily(spark, [])
    with pytest.raises(ValueError, match="date_created"):
        require_raw(df)
    with pytest.raises(ValueError, match="nope"):
        require_columns(df, ["nope"])
    with pytest.raises(TypeError):
        require_columns([], ["a"])
    with pytest.raises(ValueError, match="DATE"):
        require_dated(spark.createDataFrame([("x",)], "date string"))
    assert require_dated(df) is df


def test_empty_input_gives_empty_output(spark):
    raw = spark.createDataFrame([], RAW)
    assert clean.process(raw).count() == 0
    assert features.add_features(clean.process(raw)).count() == 0
