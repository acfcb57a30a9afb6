"""The key index of a table's files, and rewrites of single files."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tributary.operators import fileindex


def months(spark, lake, n=600):
    """A partitioned table of which a key is in one file only; load ids as partition values, one with a blank."""
    df = spark.range(n).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("k"), F.when(F.col("id") % 50 != 0, F.col("id")).alias("n"), (F.col("id") % 6).cast("int").alias("m"), F.concat(F.lit("0 0:"), (F.col("id") % 2).cast("string")).alias("load_id"))
    lake.write_snapshot(df, "gold", "t", partition_by=["load_id", "m"])
    return df


def asked(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_lookup_names_the_files_that_hold_a_key(spark, lake):
    df = months(spark, lake)
    found = fileindex.files_with(lake, "gold", "t", key="k", values=asked(spark, "c7", "c8", None, "nobody"))
    assert {f.rsplit("/", 1)[0] for f in found} == {"load_id=0 0%253A1/m=1".replace(" ", "%20"), "load_id=0 0%253A0/m=2".replace(" ", "%20")}
    assert fileindex.files_with(lake, "gold", "t", key="k", values=asked(spark)) == []
    one = spark.createDataFrame([(9,)], "v bigint")
    assert len(fileindex.files_with(lake, "gold", "t", key="n", values=one)) == 1
    for r in df.where("id % 97 = 0" if "id" in df.columns else "n % 97 = 0").collect():
        assert len(fileindex.files_with(lake, "gold", "t", key="k", values=asked(spark, r.k))) >= 1


def test_only_new_files_are_indexed(spark, lake):
    months(spark, lake)
    n = len(fileindex.current_files(lake, "gold", "t"))
    assert fileindex.refresh_index(lake, "gold", "t", keys=["k", "n"]) == n
    assert fileindex.refresh_index(lake, "gold", "t", keys=["k", "n"]) == 0
    lake.append(spark.createDataFrame([("c7", None, 1, "x")], "k string, n bigint, m int, load_id string"), "gold", "t", partition_by=["load_id", "m"])
    assert fileindex.refresh_index(lake, "gold", "t", keys=["k", "n"]) == 1
    assert len(fileindex.files_with(lake, "gold", "t", key="k", values=asked(spark, "c7"))) == 2
    fileindex.rewrite_files(lake, "gold", "t", files=[f for f, _, _ in fileindex.current_files(lake, "gold", "t") if "load_id=x" in f], keep=lambda r: r.where("k <> 'c7'"), plan=("p",))
    before = fileindex.read_index(lake, "gold", "t").count()
    fileindex.prune_index(lake, "gold", "t")
    assert fileindex.read_index(lake, "gold", "t").count() < before
    assert len(fileindex.files_with(lake, "gold", "t", key="k", values=asked(spark, "c7"))) == 1


def test_a_rewrite_touches_its_files_only(spark, lake):
    df = months(spark, lake)
    before = {f: t for f, _, t in fileindex.current_files(lake, "gold", "t")}
    hit = fileindex.files_with(lake, "gold", "t", key="k", values=asked(spark, "c7"))
    fileindex.rewrite_files(lake, "gold", "t", files=hit, keep=lambda r: r.where("k <> 'c7'"), plan=("erase", "r1"))
    after = {f: t for f, _, t in fileindex.current_files(lake, "gold", "t")}
    assert before.keys() - after.keys() == set(hit) and all(after[f] == before[f] for f in before if f not in hit)
    assert rows(lake.read("gold", "t").select(*df.columns)) == rows(df.where("k <> 'c7'"))
    assert not lake.exists("staging", "erase", "r1")


@pytest.mark.parametrize("step", ["move", "delete"])
def test_a_rewrite_that_died_is_finished(spark, lake, monkeypatch, step):
    df = months(spark, lake)
    hit = [f for f, _, _ in fileindex.current_files(lake, "gold", "t") if "m=1" in f or "m=2" in f]
    real, calls = getattr(lake.files, step), []

    def die(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("killed")
        real(*args)

    keep = lambda r: r.where("k <> 'c7'")
    monkeypatch.setattr(lake.files, step, die)
    with pytest.raises(RuntimeError):
        fileindex.rewrite_files(lake, "gold", "t", files=hit, keep=keep, plan=("erase", "r1"))
    monkeypatch.undo()
    fileindex.rewrite_files(lake, "gold", "t", files=[], keep=keep, plan=("erase", "r1"))
    assert rows(lake.read("gold", "t").select(*df.columns)) == rows(df.where("k <> 'c7'"))


def test_missing_and_empty_tables(spark, lake):
    assert fileindex.files_with(lake, "gold", "none", key="k", values=asked(spark, "a")) == []
    lake.write_snapshot(spark.createDataFrame([], "k string"), "gold", "t")
    assert fileindex.files_with(lake, "gold", "t", key="k", values=asked(spark, "a")) == []
    fileindex.rewrite_files(lake, "gold", "none", files=[], keep=lambda r: r, plan=("x",))
