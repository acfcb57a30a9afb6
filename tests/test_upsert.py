import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tributary.lake import Lake
from tributary.operators import buckets, upsert

DDL = "k string, v string, updated_at string"


def batch(spark, data):
    return spark.createDataFrame(data, DDL)


def test_insert_update_keep(spark, lake):
    upsert.upsert(lake, batch(spark, [("a", "1", "t1"), ("b", "1", "t1")]), "t", ["k"], "r1", buckets=4)
    upsert.upsert(lake, batch(spark, [("b", "2", "t2"), ("b", "old", "t0"), ("c", "2", "t2")]), "t", ["k"], "r2", buckets=4)
    assert rows(upsert.read_upserted(lake, "t").select("k", "v")) == [("a", "1"), ("b", "2"), ("c", "2")]


def test_rerun_changes_nothing(spark, lake):
    source = batch(spark, [("a", "1", "t1"), ("a", "2", "t1"), ("b", "1", None)])
    upsert.upsert(lake, source, "t", ["k"], "r1", buckets=4)
    first = rows(upsert.read_upserted(lake, "t"))
    upsert.upsert(lake, source.repartition(5), "t", ["k"], "r1", buckets=4)
    assert rows(upsert.read_upserted(lake, "t")) == first
    assert len(first) == 2


def test_untouched_buckets_are_not_rewritten(spark, lake):
    upsert.upsert(lake, batch(spark, [(str(i), "1", "t") for i in range(40)]), "t", ["k"], "r1", buckets=8)
    before = set(lake.files.glob(lake.path("silver", "t") + "/bucket=*/part-*"))
    upsert.upsert(lake, batch(spark, [("3", "2", "t")]), "t", ["k"], "r2", buckets=8)
    after = set(lake.files.glob(lake.path("silver", "t") + "/bucket=*/part-*"))
    assert len({f.rsplit("/", 1)[0] for f in before - after}) == 1
    assert upsert.read_upserted(lake, "t").count() == 40


def test_null_keys_are_set_aside(spark, lake):
    for _ in range(2):
        assert upsert.upsert(lake, batch(spark, [(None, "x", "t"), ("a", "1", "t")]), "t", ["k"], "r1", buckets=2) == 1
    assert rows(upsert.read_upserted(lake, "t").select("k")) == [("a",)]
    assert lake.read("silver", "quarantine_t_null_key").count() == 1


def test_composite_key(spark, lake):
    ddl = "a int, b int, v string, updated_at string"
    upsert.upsert(lake, spark.createDataFrame([(1, 1, "x", "t"), (1, 2, "y", "t")], ddl), "t", ["a", "b"], "r1", buckets=4)
    upsert.upsert(lake, spark.createDataFrame([(1, 2, "z", "t")], ddl), "t", ["a", "b"], "r2", buckets=4)
    assert rows(upsert.read_upserted(lake, "t").select("a", "b", "v")) == [(1, 1, "x"), (1, 2, "z")]


def test_run_killed_while_swapping_is_finished_by_the_next_call(spark, lake, monkeypatch):
    upsert.upsert(lake, batch(spark, [(str(i), "1", "t1") for i in range(40)]), "t", ["k"], "r1", buckets=4)
    source = batch(spark, [("3", "2", "t2"), (None, "x", "t2")])
    real = lake.overwrite_partitions

    def die(df, layer, *parts, **kw):
        for bucket in {r[0] for r in df.select("bucket").distinct().collect()}:
            lake.files.delete(lake.path(layer, *parts) + f"/bucket={bucket}")
        raise RuntimeError("killed")

    monkeypatch.setattr(lake, "overwrite_partitions", die)
    with pytest.raises(RuntimeError):
        upsert.upsert(lake, source, "t", ["k"], "r2", buckets=4)
    monkeypatch.setattr(lake, "overwrite_partitions", real)
    assert upsert.read_upserted(lake, "t").count() < 40
    assert upsert.upsert(lake, source, "t", ["k"], "r2", buckets=4) == 1
    got = dict(rows(upsert.read_upserted(lake, "t").select("k", "v")))
    assert len(got) == 40 and got["3"] == "2"


def test_resumes_after_only_the_source_was_staged(spark, lake, monkeypatch):
    upsert.upsert(lake, batch(spark, [("a", "1", "t")]), "t", ["k"], "r1", buckets=2)
    monkeypatch.setattr(upsert, "merge_rows", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    source = batch(spark, [("b", "2", "t"), (None, "3", "t")])
    with pytest.raises(RuntimeError):
        upsert.upsert(lake, source, "t", ["k"], "r2", buckets=2)
    monkeypatch.undo()
    assert upsert.upsert(lake, source, "t", ["k"], "r2", buckets=2) == 1
    assert rows(upsert.read_upserted(lake, "t").select("k", "v")) == [("a", "1"), ("b", "2")]


def test_empty_source_leaves_the_table(spark, lake):
    upsert.upsert(lake, batch(spark, [("a", "1", "t")]), "t", ["k"], "r1", buckets=2)
    upsert.upsert(lake, batch(spark, []), "t", ["k"], "r2", buckets=2)
    assert rows(upsert.read_upserted(lake, "t").select("k", "v")) == [("a", "1")]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.sampled_from("abcde"), st.integers(0, 9), min_size=1), min_size=1, max_size=3))
def test_equals_dict_replay(spark, lake, batches):
    table = Lake(spark, lake.root + f"/case-{abs(hash(repr(batches)))}")
    state = {}
    for i, data in enumerate(batches):
        upsert.upsert(table, batch(spark, [(k, str(v), f"t{i}") for k, v in data.items()]), "t", ["k"], f"r{i}", buckets=2)
        state.update({k: str(v) for k, v in data.items()})
    assert rows(upsert.read_upserted(table, "t").select("k", "v")) == sorted(state.items(), key=repr)


def test_a_larger_table_splits_single_buckets(spark, lake):
    def keys():
        return sorted(r.k for r in upsert.read_upserted(lake, "t").collect())

    upsert.upsert(lake, batch(spark, [(str(i), "1", "t1") for i in range(20)]), "t", ["k"], "r1", buckets=4)
    before = set(lake.files.glob(lake.path("silver", "t") + "/bucket=*/part-*"))
    buckets.bucket_count(lake, "t", ["k"], 7)
    after = set(lake.files.glob(lake.path("silver", "t") + "/bucket=*/part-*"))
    assert {f.rsplit("bucket=", 1)[1][0] for f in before & after} == {"3"}  # 0, 1 and 2 hand over to 4, 5 and 6
    upsert.upsert(lake, batch(spark, [(str(i), "2", "t2") for i in range(10, 22)]), "t", ["k"], "r2", buckets=7)
    assert keys() == sorted(str(i) for i in range(22))
    upsert.upsert(lake, batch(spark, [(str(i), "3", "t3") for i in range(22)]), "t", ["k"], "r3", buckets=2)  # never shrinks
    assert keys() == sorted(str(i) for i in range(22)) and lake.layout("silver", "t")["buckets"] == 7
    got = buckets.with_bucket(lake.read("silver", "t").withColumnRenamed("bucket", "b"), ["k"], 7)
    assert got.where("b <> bucket").count() == 0


@given(st.integers(1, 40), st.integers(0, 40))
def test_split_buckets_are_those_whose_addresses_change(now, more):
    def at(h, n):
        full = 1 << (n - 1).bit_length()
        return h % full if h % full < n else h % full - full // 2

    moved = {at(h, now) for h in range(4096) if at(h, now) != at(h, now + more)}
    assert moved == set(buckets.split_buckets(now, now + more))
    assert all(at(h, now + more) >= now for h in range(4096) if at(h, now) != at(h, now + more))


def test_growth_that_died_is_finished(spark, lake, monkeypatch):
    upsert.upsert(lake, batch(spark, [(str(i), "1", "t1") for i in range(40)]), "t", ["k"], "r1", buckets=4)
    real = lake.files.delete
    monkeypatch.setattr(lake, "overwrite_partitions", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        buckets.bucket_count(lake, "t", ["k"], 6)
    monkeypatch.undo()
    assert buckets.bucket_count(lake, "t", ["k"], 5) == 6 and lake.files.delete == real
    assert sorted(int(r.k) for r in upsert.read_upserted(lake, "t").collect()) == list(range(40))


def test_a_swap_that_died_does_not_outlive_growth(spark, lake, monkeypatch):
    upsert.upsert(lake, batch(spark, [(str(i), "1", "t1") for i in range(20)]), "t", ["k"], "r1", buckets=2)
    monkeypatch.setattr(lake, "overwrite_partitions", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        upsert.upsert(lake, batch(spark, [("3", "2", "t2")]), "t", ["k"], "r2", buckets=2)
    monkeypatch.undo()
    upsert.upsert(lake, batch(spark, [("4", "3", "t3")]), "t", ["k"], "r3", buckets=5)
    upsert.upsert(lake, batch(spark, [("3", "2", "t2")]), "t", ["k"], "r2", buckets=2)
    got = {r.k: r.v for r in upsert.read_upserted(lake, "t").collect()}
    assert len(got) == 20 == upsert.read_upserted(lake, "t").count() and (got["3"], got["4"]) == ("2", "3")


def test_table_of_unknown_buckets_is_dealt_anew(spark, lake):
    rows_ = batch(spark, [(str(i), "1", "t1") for i in range(20)]).withColumn("bucket", F.pmod(F.xxhash64("k"), F.lit(3)).cast("int"))
    rows_.write.partitionBy("bucket").parquet(lake.path("silver", "t"))
    upsert.upsert(lake, batch(spark, [("3", "2", "t2")]), "t", ["k"], "r1", buckets=5)
    assert upsert.read_upserted(lake, "t").count() == 20


def test_runs_without_rows_or_rejects(spark, lake):
    """Rows of files that all fail a filter are only found to be none at run time."""
    lake.write_snapshot(batch(spark, [(str(i), "1", "t") for i in range(20)]).withColumn("verdict", F.lit(None).cast("string")), "bronze", "rows")
    stored = lake.read("bronze", "rows")
    nothing = stored.where("v = '2'")
    assert upsert.quarantine(lake, stored.where("verdict is not null"), "rule", "r1", verdict="verdict") == 0
    assert upsert.upsert(lake, nothing.drop("verdict"), "t", ["k"], "r1", buckets=2) == 0
    assert upsert.upsert(lake, stored.drop("verdict"), "t", ["k"], "r2", buckets=2) == 0
    assert upsert.upsert(lake, nothing.drop("verdict"), "t", ["k"], "r3", buckets=2) == 0
    assert upsert.read_upserted(lake, "t").count() == 20
    assert upsert.split_write(lake, nothing, "split", "r1", verdict="verdict") == {"clean": 0, "quarantined": 0}
    assert upsert.split_write(lake, stored, "split", "r1", verdict="verdict") == {"clean": 20, "quarantined": 0}


def test_a_repeated_run_without_rejects_leaves_none(spark, lake):
    bad = batch(spark, [("a", "1", "t")]).withColumn("verdict", F.lit("bad"))
    for run_id in ("2024-01-01T00:00", "123", "0123"):
        assert upsert.quarantine(lake, bad, "rule", run_id, verdict="verdict") == 1
    assert upsert.quarantine(lake, bad.where("k = 'b'"), "rule", "2024-01-01T00:00", verdict="verdict") == 0
    assert sorted(r.run_id for r in lake.read("silver", "quarantine_rule").collect()) == ["0123", "123"]
