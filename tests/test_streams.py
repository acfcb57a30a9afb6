from pyspark.sql import functions as F

from conftest import rows
from tributary.schemas import schema
from tributary.sources import landing
from tributary.streaming import jobs

CHANGES = schema(seq="long", op="string", pk_value="string", label="string", changed_at="string")
DDL = "seq bigint, op string, pk_value string, label string, changed_at string, dt string"


def land(spark, lake, data, at="2024-02-01 00:00:00"):
    landing.land(lake, spark.createDataFrame(data, DDL), "s", "t", at, "json", seq="seq")


def event(seq, op, key, label, dt="2024-01-01"):
    return (seq, op, key, label, f"2024-01-01 00:00:{seq:02d}", dt)


def stream(lake):
    return jobs.landing_stream(lake, "s", "t", CHANGES, files_per_trigger=1)


def test_promote_stream_is_exactly_once_over_restarts(spark, lake):
    land(spark, lake, [event(1, "I", "a", "x"), event(2, "U", "a", "y"), event(2, "U", "a", "y")])
    jobs.stream_promote(lake, stream(lake), "b").awaitTermination()
    land(spark, lake, [event(2, "U", "a", "y", "2024-01-02"), event(3, "D", "a", "z", "2024-01-02")])
    for _ in range(2):
        jobs.stream_promote(lake, stream(lake), "b").awaitTermination()
    assert rows(lake.read("bronze", "b").select("seq", "op")) == [(1, "I"), (2, "U"), (3, "D")]


def test_state_ignores_older_events_and_keeps_tombstones(spark, lake):
    land(spark, lake, [event(5, "U", "a", "new"), event(6, "D", "b", "gone")])
    jobs.stream_latest_state(lake, stream(lake), "st", buckets=4).awaitTermination()
    land(spark, lake, [event(4, "U", "a", "late", "2024-01-02"), event(3, "U", "b", "late", "2024-01-02"), event(7, "I", "c", "c", "2024-01-02")])
    jobs.stream_latest_state(lake, stream(lake), "st", buckets=4).awaitTermination()
    assert rows(jobs.current_state(lake, "st").select("pk_value", "label")) == [("a", "new"), ("c", "c")]


def test_folding_the_same_events_again_changes_nothing(spark, lake):
    events = spark.createDataFrame([event(1, "I", "a", "x"), event(2, "U", "b", "y")], DDL)
    for run in ("r1", "r2"):
        jobs.apply_changes(lake, events, "st", run, buckets=2)
    assert rows(jobs.current_state(lake, "st").select("pk_value", "label")) == [("a", "x"), ("b", "y")]


def test_dedup_stream(spark, lake):
    land(spark, lake, [event(1, "I", "a", "x"), event(1, "I", "a", "x"), event(2, "U", "a", "y")])
    land(spark, lake, [event(2, "U", "a", "y", "2024-01-02")])
    timed = stream(lake).withColumn("changed_at", F.col("changed_at").cast("timestamp"))
    jobs.stream_dedup(lake, timed, "b", "changed_at", "1 day").awaitTermination()
    assert rows(lake.read("bronze", "b").select("seq")) == [(1,), (2,)]


def test_only_closed_windows_are_written(spark, lake):
    data = spark.createDataFrame([("2024-01-01 00:10:00", True), ("2024-01-01 00:50:00", False), ("2024-01-01 01:10:00", True), ("2024-01-01 02:04:00", True)], "t string, is_fraud boolean")
    lake.write_snapshot(data.select(F.col("t").cast("timestamp").alias("updated_at"), "is_fraud"), "silver", "c")
    source = spark.readStream.schema("updated_at timestamp, is_fraud boolean").parquet(lake.path("silver", "c"))
    jobs.stream_fraud_window(lake, source, "w", "updated_at", "1 hour").awaitTermination()
    got = lake.read("gold", "w").select(F.hour("window_start"), "txn_count", "fraud_count")
    assert rows(got) == [(0, 2, 1)]  # 01:00-02:00 stays open: the mark is 01:59


def test_late_rows_are_counted(spark, lake):
    def add(*times):
        df = spark.createDataFrame([(t, True) for t in times], "t string, is_fraud boolean")
        lake.append(df.coalesce(1).select(F.col("t").cast("timestamp").alias("updated_at"), "is_fraud"), "silver", "c")

    def run():
        source = spark.readStream.schema("updated_at timestamp, is_fraud boolean").parquet(lake.path("silver", "c"))
        query = jobs.stream_fraud_window(lake, source, "w", "updated_at", "1 hour")
        query.awaitTermination()
        return query

    add("2024-01-01 00:10:00", "2024-01-01 05:00:00")
    assert jobs.late_rows(run()) == 0
    add("2024-01-01 00:20:00", "2024-01-01 09:00:00")
    assert jobs.late_rows(run()) == 1
    assert rows(lake.read("gold", "w").select(F.hour("window_start"), "txn_count")) == [(0, 1), (5, 1)]


def test_redelivered_events_without_a_number_are_appended_once(spark, lake):
    for day in ("2024-01-01", "2024-01-02"):
        land(spark, lake, [event(1, "I", "a", "x", day)[:0] + (None, "I", "n", "x", "2024-01-01 00:00:00", day), event(2, "U", "a", "y", day)])
        jobs.stream_promote(lake, stream(lake), "b").awaitTermination()
    assert rows(lake.read("bronze", "b").select("pk_value", "seq")) == [("a", 2), ("n", None)]


def test_state_table_grows(spark, lake):
    for run, buckets in (("r1", 4), ("r2", 7), ("r3", 3)):
        events = spark.createDataFrame([event(1, "I", str(i), run) for i in range(20)], DDL).withColumn("seq", F.lit(int(run[1])))
        jobs.apply_changes(lake, events, "st", run, buckets=buckets)
    assert sorted(int(r.pk_value) for r in jobs.current_state(lake, "st").collect()) == list(range(20))
    assert {r.label for r in jobs.current_state(lake, "st").collect()} == {"r3"}
