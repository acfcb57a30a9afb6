"""The ledger of loads, facts that follow them, re-linking, and windows with late rows."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tributary.operators import increments
from tributary.plans import jobs as stages
from tributary.streaming import jobs

FACT = "k string, v int, y int, m int"


def load(spark, lake, day, *ids):
    df = spark.createDataFrame([(i, day, f"0000000000{day[-2:]}") for i in ids], "id int, dt string, load_id string")
    lake.overwrite_partitions(df, "bronze", "s", "t", partition_by=["dt", "load_id"])


def test_ledger_hands_out_each_load_once(spark, lake):
    assert increments.new_loads(lake, "fact", "s", "t") == []
    load(spark, lake, "2024-01-01", 1, 2)
    load(spark, lake, "2024-01-02", 3)
    first = increments.new_loads(lake, "fact", "s", "t")
    assert first == [("2024-01-01", "000000000001"), ("2024-01-02", "000000000002")]
    increments.take(lake, "fact", "s", "t", first[:1], "r1")
    assert increments.new_loads(lake, "fact", "s", "t") == first[1:]
    assert increments.new_loads(lake, "other", "s", "t") == first
    assert rows(increments.rows_of(lake, "s", "t", first[1:])) == [(3, "2024-01-02", "000000000002")]
    increments.take(lake, "fact", "s", "t", first[1:], "r2")
    assert increments.new_loads(lake, "fact", "s", "t") == []


def fact(spark, lake):
    data = [("a", 1, 2024, 1), ("b", 1, 2024, 1), ("c", 1, 2024, 2), ("d", 1, 2024, 3), ("e", 1, None, None)]
    lake.write_snapshot(spark.createDataFrame(data, FACT), "gold", "f", partition_by=["y", "m"])
    return data


def follow(spark, lake, fresh, *changed, run_id="r1"):
    keys = spark.createDataFrame([(c,) for c in changed], "k string")
    return increments.follow(lake, "f", ["k"], keys, spark.createDataFrame(fresh, FACT), ["y", "m"], run_id)


def test_only_touched_periods_are_rebuilt(spark, lake):
    fact(spark, lake)
    before = {p: t for p, _, t in lake.files.data_files(lake.path("gold", "f"))}
    # c moves out of its month, which then is empty; e gets a date; x is new; b is gone at the source.
    assert follow(spark, lake, [("c", 2, 2024, 1), ("e", 2, 2025, 1), ("x", 2, 2025, 1)], "b", "c", "e", "x") == 4
    got = [("a", 1, 2024, 1), ("c", 2, 2024, 1), ("d", 1, 2024, 3), ("e", 2, 2025, 1), ("x", 2, 2025, 1)]
    assert rows(lake.read("gold", "f").select("k", "v", "y", "m")) == got
    after = {p: t for p, _, t in lake.files.data_files(lake.path("gold", "f"))}
    assert {p: t for p, t in before.items() if "m=3" in p} == {p: t for p, t in after.items() if "m=3" in p}
    assert follow(spark, lake, [], run_id="r2") == 0
    assert rows(lake.read("gold", "f").select("k", "v", "y", "m")) == got


@pytest.mark.parametrize("step", ["overwrite_partitions", "unstage"])
def test_following_that_died_is_finished(spark, lake, monkeypatch, step):
    fact(spark, lake)
    monkeypatch.setattr(lake, step, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
    fresh = [("c", 2, 2024, 1)]
    with pytest.raises(RuntimeError):
        follow(spark, lake, fresh, "c")
    monkeypatch.undo()
    follow(spark, lake, fresh, "c")
    assert sorted((r.k, r.v) for r in lake.read("gold", "f").collect()) == [("a", 1), ("b", 1), ("c", 2), ("d", 1), ("e", 1)]


def test_a_full_rebuild_leaves_no_stale_period(spark, lake):
    data = fact(spark, lake)
    lake.write_snapshot(spark.createDataFrame(data[:2], FACT), "gold", "f", partition_by=["y", "m"])
    assert lake.read("gold", "f").count() == 2


def test_later_runs_read_only_new_loads(spark, lake, monkeypatch):
    from tributary.plans import registry
    from tributary.plans.workspace import Workspace

    seen = []
    real = increments.rows_of

    def watched(lake_, source, table, loads):
        seen.append((table, [d for d, _ in loads]))
        return real(lake_, source, table, loads)

    monkeypatch.setattr(increments, "rows_of", watched)
    result = registry.QUERIES["incremental_facts"](Workspace(spark, "/root/testdata/sf0.001"))
    assert seen == [
        ("paysim_transactions", ["2024-02-01"]), ("transaction", ["2024-02-01"]), ("paysim_transactions", ["2024-02-02"]),
        ("transaction", ["2024-02-02"]), ("paysim_transactions", ["2024-02-03"]),
    ]
    assert result.where("txn_year = 2023").count() == 0


def test_accounts_go_when_all_holders_go(spark):
    bridge = spark.createDataFrame([("a", "1"), ("b", "1"), ("a", "2"), (None, "3"), ("a", "3"), ("a", "4"), ("a", "4")], "customer_id string, account_id string")
    assert rows(stages.accounts_left(bridge, spark.createDataFrame([("a",)], "customer_id string"))) == [("2",), ("4",)]


def test_windows_and_late_rows_hold_every_row(spark, lake):
    def add(*times):
        df = spark.createDataFrame([(t, i % 2 == 0) for i, t in enumerate(times)], "t string, is_fraud boolean")
        lake.append(df.coalesce(1).select(F.col("t").cast("timestamp").alias("updated_at"), "is_fraud"), "silver", "c")

    def run():
        source = spark.readStream.schema("updated_at timestamp, is_fraud boolean").parquet(lake.path("silver", "c"))
        jobs.stream_windows_with_late(lake, source, "w", "updated_at", "1 hour").awaitTermination()
        return rows(jobs.window_counts(lake, "w").select(F.hour("window_start"), "txn_count", "fraud_count", "closed"))

    add("2024-01-01 00:10:00", "2024-01-01 00:50:00", "2024-01-01 01:30:00")
    assert run() == [(0, 2, 1, True), (1, 1, 1, False)]
    assert jobs.late_table(lake, "w").count() == 0
    add("2024-01-01 00:20:00", "2024-01-01 01:26:00", "2024-01-01 05:00:00")  # the mark is 01:25
    assert run() == [(0, 2, 1, True), (1, 2, 1, True), (5, 1, 1, False)]
    assert rows(jobs.late_table(lake, "w").select(F.date_format("updated_at", "HH:mm"), "batch_id")) == [("00:20", 1)]
    assert run() == [(0, 2, 1, True), (1, 2, 1, True), (5, 1, 1, False)]
