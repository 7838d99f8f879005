"""Stores that are replaced as a whole, parallel JDBC reads by rank, pages by key, and selection among counts."""

from __future__ import annotations

import random
import threading
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.operators import profile
from seriesloom.operators.schema import FORECAST
from seriesloom.sources import readers, versions, writers

DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def rows(spark, n, name="a"):
    return spark.createDataFrame([(date(2024, 1, 1 + i % 28), i, name, "x") for i in range(n)], FORECAST)


def broken(df):
    """Fails in one of its tasks, after others have written."""
    bad = F.when(F.col("prediction") == 7, F.raise_error("half way")).otherwise(F.col("item_ref"))
    return df.repartition(4).withColumn("item_ref", bad)


def test_failed_replace_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "f")
    assert writers.replace_forecasts(rows(spark, 5), path)
    with pytest.raises(Exception, match="half way"):
        writers.replace_forecasts(broken(rows(spark, 50)), path)
    assert readers.forecasts(spark, path).count() == 5
    assert writers.replace_forecasts(rows(spark, 9, "b"), path)
    assert {r["series_id"] for r in readers.forecasts(spark, path).collect()} == {"b"}


def test_open_readers_keep_their_version(spark, tmp_path):
    path = str(tmp_path / "f")
    writers.replace_forecasts(rows(spark, 5), path)
    before = readers.forecasts(spark, path)
    for n in (6, 7):
        writers.replace_forecasts(rows(spark, n), path)
    assert before.count() == 5 and readers.forecasts(spark, path).count() == 7
    writers.replace_forecasts(rows(spark, 8), path)
    assert len([p for p in (tmp_path / "f").iterdir() if p.name.startswith("v-")]) == 1 + versions.KEPT


def test_two_writers_and_a_reader(spark, tmp_path):
    path, seen, stop = str(tmp_path / "s"), [], threading.Event()
    versions.publish(rows(spark, 10, "old"), path)
    writers_ = [threading.Thread(target=lambda n=n: readers.snapshot(spark, path, lambda: rows(spark, 300, n), refresh=True)) for n in ("one", "two")]

    def read():
        while not stop.is_set():
            seen.append({(r["series_id"], r["n"]) for r in readers.snapshot(spark, path, None).groupBy("series_id").agg(F.count("*").alias("n")).collect()})

    reader = threading.Thread(target=read)
    reader.start()
    for t in writers_:
        t.start()
    for t in writers_:
        t.join()
    stop.set()
    reader.join()
    assert seen and all(s in ({("old", 10)}, {("one", 300)}, {("two", 300)}) for s in seen)
    assert readers.snapshot(spark, path, None).count() == 300


def test_failed_jdbc_replace_leaves_the_old_table(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    assert writers.forecasts_to_jdbc(rows(spark, 5), url, "stored", DRIVER)
    with pytest.raises(Exception, match="half way"):
        writers.forecasts_to_jdbc(broken(rows(spark, 50)), url, "stored", DRIVER)
    assert readers.jdbc(spark, url, "stored", DRIVER).count() == 5
    with pytest.raises(FileExistsError):
        writers.forecasts_to_jdbc(rows(spark, 1), url, "stored", DRIVER, "fail")
    assert writers.forecasts_to_jdbc(rows(spark, 9), url, "stored", DRIVER)
    assert not writers.forecasts_to_jdbc(rows(spark, 9).limit(0), url, "stored", DRIVER)
    assert readers.jdbc(spark, url, "stored", DRIVER).count() == 9
    left = readers.jdbc(spark, url, "SYS.SYSTABLES", DRIVER).where("tabletype = 'T'")
    assert [r["TABLENAME"] for r in left.select("TABLENAME").collect()] == ["STORED"]


@pytest.mark.parametrize("column", ["k", "day", "name"])
def test_even_parts_of_a_skewed_key(spark, tmp_path, column):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    rnd = random.Random(2)
    keys = [None] * 20 + [int(rnd.expovariate(1) ** 4 * 1000) for _ in range(400)]
    table = spark.createDataFrame([(k, None if k is None else date.fromordinal(700_000 + k % 3000), f"o'{(k or 0) % 977:03}", i) for i, k in enumerate(keys)], "k long, day date, name string, i int")
    table.write.format("jdbc").option("url", url).option("dbtable", "t").option("createTableColumnTypes", "name varchar(20)").options(**DRIVER).save()
    found = readers.jdbc_even(spark, url, "t", f'"{column}"', 8, DRIVER)
    assert sorted(r["i"] for r in found.collect()) == list(range(420))
    sizes = [r["n"] for r in found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert 7 <= len(sizes) <= 8 and max(sizes) <= 2 * 420 / 8  # equal values stay together
    assert readers.jdbc_even(spark, url, "(SELECT * FROM t WHERE \"i\" < 20) s", f'"{column}"', 8, DRIVER).count() == 20


def test_pages_by_key(spark, tmp_path):
    rnd = random.Random(3)
    data = [(date(2024, 1, 1 + i % 9), rnd.randint(0, 9), f"s{i // 9:03}", "x") for i in range(270)]
    rnd.shuffle(data)
    spark.createDataFrame(data, FORECAST).repartition(4).write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    order, after, seen = ["date", "series_id"], None, []
    while page := profile.page_after(stored, FORECAST.names, order, 40, after).collect():
        seen += [tuple(r) for r in page]
        after = tuple(page[-1][c] for c in order)
    assert seen == sorted(data, key=lambda r: (r[0], r[2]))
    late = profile.page_after(stored, FORECAST.names, order, 40, (date(2024, 1, 9), "s020"))
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" in plan and "PushedFilters" in plan and "GreaterThanOrEqual(date" in plan and "Exchange" not in plan


@pytest.mark.parametrize("parts", [1, 16])
def test_quartiles_by_selection(spark, parts):
    """Few groups over many ranges, null groups, ties, single values, against numpy."""
    rnd = np.random.default_rng(4)
    groups = {"big": rnd.normal(size=900).round(2), "ties": rnd.integers(0, 3, 400).astype(float), "one": np.array([5.0]), None: rnd.random(7)}
    data = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("big", None)]
    df = spark.createDataFrame(data, "g string, quant double").repartition(6)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        found = {r["g"]: r for r in profile.box_summary(df, "g").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    for g, vs in groups.items():
        q1, median, q3 = np.quantile(vs, [0.25, 0.5, 0.75])
        inside = vs[(vs >= q1 - 1.5 * (q3 - q1)) & (vs <= q3 + 1.5 * (q3 - q1))]
        r = found[g]
        assert [r["q1"], r["median"], r["q3"]] == pytest.approx([q1, median, q3])
        assert (r["whisker_low"], r["whisker_high"], r["outliers"], r["n"]) == (inside.min(), inside.max(), len(vs) - len(inside), len(vs))
