import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tributary.lake import Lake
from tributary.operators import control, prepare
from tributary.schemas import FX_RATE, conform_to, schema, schema_drift
from tributary.sources import files, pulls

START, END = "2020-01-15T00:00:00+00:00", "2020-01-16T00:00:00+00:00"


def test_run_interval():
    both = {"DATA_INTERVAL_START": START, "DATA_INTERVAL_END": END}
    assert pulls.run_interval(both) == (dt.datetime.fromisoformat("2020-01-14T23:55:00+00:00"), dt.datetime.fromisoformat(END))
    assert pulls.run_interval({"DATA_INTERVAL_START": START}) is None
    assert pulls.run_interval({}) is None
    assert pulls.logical_date(both, dt.date(2024, 5, 5)) == "2020-01-15"
    assert pulls.logical_date({}, dt.date(2024, 5, 5)) == "2024-05-05"


@pytest.fixture
def changes(spark):
    times = ["2020-01-14 23:55:00", "2020-01-14 23:55:01", "2020-01-15 12:00:00", "2020-01-16 00:00:00", None]
    return spark.createDataFrame(list(enumerate(times)), "id int, t string").select("id", F.col("t").cast("timestamp_ntz").alias("updated_at"))


def test_interval_pull_bounds(changes):
    start, end = dt.datetime.fromisoformat(START), dt.datetime.fromisoformat(END)
    assert [r[0] for r in rows(pulls.pull_interval(changes, "updated_at", start, end).select("id"))] == [1, 2]


def test_watermark_pull(spark, changes, lake):
    assert pulls.pull_since(changes, "updated_at", None).count() == 5
    assert [r[0] for r in rows(pulls.pull_since(changes, "updated_at", "2020-01-15 12:04:00").select("id"))] == [2, 3]
    assert "GreaterThan" in pulls.pull_since(spark.read.schema("u timestamp_ntz").parquet("/root/testdata/sf0.001/nation.parquet"), "u", "2020-01-15 12:04:00")._jdf.queryExecution().executedPlan().toString()
    empty = control.read_state(lake, "marks").where("key = 't'").agg(F.max("value").cast("timestamp_ntz")).scalar()
    assert pulls.pull_since(changes, "updated_at", empty).count() == 5  # no mark yet: first run


def test_mark_is_the_newest_row_read_and_comes_back_from_the_table(spark, changes, lake):
    mark = pulls.high_water_mark(pulls.pull_full(changes), "updated_at")
    assert mark.first().new_watermark == dt.datetime(2020, 1, 16)
    state = mark.select(F.lit("t").alias("key"), F.col("new_watermark").cast("string").alias("value"), F.lit("2020-01-17").cast("timestamp_ntz").alias("written_at"))
    control.record_state(lake, "marks", state)
    control.record_state(lake, "marks", state.withColumns({"value": F.lit("2019-01-01 00:00:00"), "written_at": F.lit("2019-01-02").cast("timestamp_ntz")}))
    assert control.read_state(lake, "marks").first().value == "2020-01-16 00:00:00"


def test_poll_changes(spark):
    log = spark.range(5).withColumnRenamed("id", "seq")
    assert rows(pulls.poll_changes(log, 2)) == [(3,), (4,)]
    assert tuple(pulls.next_offset(pulls.poll_changes(log, 2)).first()) == (2, 3, 4)
    assert tuple(pulls.next_offset(pulls.poll_changes(log, 9)).first()) == (0, None, None)


def test_object_pull(spark, changes):
    got = pulls.pull_object(changes, ["id"], "updated_at", since="2020-01-14 23:55:00", until="2020-01-16 00:00:00", extra=F.col("id") != 2)
    assert rows(got) == [(1,)]


def test_initial_snapshot_runs_once(spark, lake):
    assert pulls.initial_snapshot(lake, spark.range(3), "s", "t")
    assert not pulls.initial_snapshot(lake, spark.range(9), "s", "t")
    assert lake.read("bronze", "s", "t").count() == 3


def test_unfinished_snapshot_is_replaced(spark, lake):
    spark.range(7).write.parquet(lake.path("bronze", "s", "t"))
    lake.files.delete(lake.path("bronze", "s", "t") + "/_SUCCESS")
    assert pulls.initial_snapshot(lake, spark.range(3), "s", "t")
    assert lake.read("bronze", "s", "t").count() == 3


def test_jdbc_options_bound_memory_and_push_the_predicate():
    got = pulls.jdbc_options("jdbc:x", "orders", "updated_at > 'a'", "id", 0, 100, 8)
    assert got["fetchsize"] == "10000" and got["numPartitions"] == "8"
    assert got["dbtable"] == "(SELECT * FROM orders WHERE updated_at > 'a') AS pulled"


def test_seed_csv_empty_is_null(spark, lake, tmp_path):
    path = tmp_path / "fx.csv"
    path.write_text('currency_code,rate_to_myr,rate_as_of,note\nMYR,1.0,2026-07-05,base\nunitless,,2026-07-05,"a, b"\n')
    got = {r.currency_code: (r.rate_to_myr, r.note) for r in files.read_seed_csv(spark, f"file://{path}", FX_RATE).collect()}
    assert float(got["MYR"][0]) == 1.0 and got["unitless"] == (None, "a, b")


def test_prefer_full(spark, tmp_path):
    small, full = f"file://{tmp_path}/small.csv", f"file://{tmp_path}/full.csv"
    assert files.prefer_full(spark, full, small) == small
    (tmp_path / "full.csv").write_text("x")
    assert files.prefer_full(spark, full, small) == full


def test_delimited_header_is_checked(spark, tmp_path):
    (tmp_path / "b.csv").write_text('"age";"job"\n30;"a;b"\n')
    declared = schema(age="integer", job="string")
    assert rows(files.read_delimited(spark, f"file://{tmp_path}/b.csv", ["age"], declared)) == [(30, "a;b")]
    with pytest.raises(ValueError):
        files.read_delimited(spark, f"file://{tmp_path}/b.csv", ["balance"], declared)
    with pytest.raises(Exception):
        files.read_delimited(spark, f"file://{tmp_path}/b.csv", ["age"], schema(job="string", age="integer")).collect()


def test_conform_to_and_drift(spark):
    df = spark.createDataFrame([("1", "x", 2)], "A string, extra string, b int")
    got = conform_to(df, schema(a="integer", b="double"))
    assert got.dtypes == [("a", "int"), ("b", "double")]
    with pytest.raises(ValueError):
        conform_to(df, schema(zzz="integer"))
    drift = schema_drift(spark, schema(a="integer", b="double", c="string"), schema(a="integer", b="string", d="string"))
    assert {(r.column_name, r.change) for r in drift.collect()} == {("b", "retyped"), ("c", "removed"), ("d", "added")}


def test_lake_rejects_unknown_layer(spark):
    with pytest.raises(ValueError):
        Lake(spark, "file:///x").path("platinum", "t")


def test_partition_overwrite_is_idempotent_and_keeps_other_partitions(spark, lake):
    fact = spark.createDataFrame([(1, 2023), (2, 2024)], "id int, y int")
    for _ in range(2):
        lake.overwrite_partitions(fact, "gold", "f", partition_by=["y"])
    lake.overwrite_partitions(fact.where("y = 2024").withColumn("id", F.lit(9)), "gold", "f", partition_by=["y"])
    assert rows(lake.read("gold", "f")) == [(1, 2023), (9, 2024)]


def test_preparation(spark):
    df = spark.createDataFrame([("2020-02-28",), ("2020-03-01",), (None,)], "d string").select(F.col("d").cast("date").alias("d"))
    assert [str(r[0]) for r in rows(prepare.rebase_dates(df, "d", "2024-03-01"))] == ["None", "2024-02-28", "2024-03-01"]
    assert prepare.rebase_dates(df.where("d is null"), "d", "2024-03-01").first()[0] is None
    step = spark.range(1).select(prepare.step_to_timestamp(F.lit(25), "2024-02-28")).first()[0]
    assert step == dt.datetime(2024, 2, 29, 1)
    stamped = prepare.audit_stamp(df, "2024-01-01 00:00:00")
    assert stamped.columns == ["d", "created_at", "updated_at", "is_deleted"]
    ids = spark.range(50)
    assert prepare.hash_sample(ids, "id", 0, "s").count() == 0
    assert prepare.hash_sample(ids, "id", 99, "s").count() == 50
    assert rows(prepare.hash_sample(ids, "id", 7, "s")) == rows(prepare.hash_sample(ids.repartition(5), "id", 7, "s"))
    groups = spark.range(90).withColumn("g", F.when(F.col("id") < 60, 0).otherwise(F.col("id")))
    per_group = prepare.capped_group_sample(groups, "g", "id", 4, "s").groupBy("g").count().agg(F.max("count"), F.sum("count")).first()
    assert tuple(per_group) == (4, 34)


def test_interval_offsets_are_converted(spark):
    east = {"DATA_INTERVAL_START": "2024-01-10T01:00:00+02:00", "DATA_INTERVAL_END": "2024-01-11T00:00:00"}
    begin, end = pulls.run_interval(east)
    assert (begin.isoformat(), end.isoformat()) == ("2024-01-09T22:55:00+00:00", "2024-01-11T00:00:00+00:00")
    assert pulls.logical_date(east, dt.date(2024, 5, 5)) == "2024-01-09"
    rows = spark.sql("select timestamp_ntz'2024-01-09 23:30:00' ts")
    assert pulls.pull_interval(rows, "ts", "2024-01-10T01:00:00+02:00", "2024-01-11 00:00:00").count() == 1
