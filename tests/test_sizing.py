from __future__ import annotations

import pytest

from seriesloom.plans import queries, sizing


@pytest.mark.parametrize("name", ["complete_features", "zero_runs_marked", "last_values", "series_gate_train", "last_features"])
def test_tasks_follow_the_table(spark, sf, monkeypatch, name):
    """A table larger than a task's share gets partitions by its size, whatever the session's setting, and the same rows."""
    want = sorted(map(str, queries.QUERIES[name](spark, sf).collect()))
    total = sizing.table_bytes(spark, f"{sf}/lineitem.parquet")
    monkeypatch.setattr(sizing, "SHARE", -(-total // 7))
    monkeypatch.setattr(sizing, "TASK", total // 2)
    found = queries.QUERIES[name](spark, sf)
    own = found.sparkSession.conf
    assert own.get("spark.sql.shuffle.partitions") == "7" and spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert int(own.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) == int(own.get("spark.sql.files.maxPartitionBytes")) == total // 2
    assert own.get("spark.sql.session.timeZone") == "UTC"
    assert sorted(map(str, found.collect())) == want


def test_settings_of_the_session_stay(spark, sf, monkeypatch):
    monkeypatch.setattr(sizing, "TASK", 1)
    spark.conf.set("spark.sizing.test", "kept")
    own = sizing.sized(spark, f"{sf}/lineitem.parquet")
    spark.conf.unset("spark.sizing.test")
    assert own is not spark and own.conf.get("spark.sizing.test") == "kept"
    assert sizing._bytes("8m") == 8 << 20 and sizing._bytes("134217728b") == 128 << 20 and sizing._bytes("64MB") == 64 << 20 and sizing._bytes("5") == 5


def test_small_tables_keep_the_session(spark, sf):
    assert sizing.sized(spark, f"{sf}/lineitem.parquet") is spark


def test_small_partitions_alone_are_merged():
    """Dense days of a partition compress to few bytes: merged up to many shares of the table they would fill a task."""
    assert sizing.TASK <= 2 * sizing.SHARE
