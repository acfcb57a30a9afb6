import pytest
from pyspark.sql import functions as F

from conftest import rows
from tributary.operators import maintenance, quality


def data_files(lake, *parts):
    return sum(n for n, _ in maintenance.file_stats(lake, *parts).values())


def test_compaction_keeps_rows_and_is_idempotent(spark, lake):
    df = spark.range(500).withColumn("v", F.col("id") % 7)
    lake.append(df.repartition(10), "gold", "t")
    before = rows(lake.read("gold", "t"))
    assert maintenance.compact(lake, "gold", "t", run_id="r1")
    assert data_files(lake, "gold", "t") == 1
    assert rows(lake.read("gold", "t")) == before
    assert not maintenance.compact(lake, "gold", "t", run_id="r2")


def test_missing_table_is_skipped(lake):
    assert not maintenance.compact(lake, "gold", "nothing", run_id="r1")


def test_partitioned_compaction_touches_crowded_partitions_only(spark, lake):
    df = spark.range(300).withColumn("p", F.concat(F.lit("a b/"), (F.col("id") % 3)))
    for part in (df.where("id < 150"), df.where("id >= 150 and p <> 'a b/2'")):
        lake.append(part, "gold", "t", partition_by=["p"])
    before = rows(lake.read("gold", "t"))
    untouched = [f for f, (n, _) in maintenance.file_stats(lake, "gold", "t").items() if n == 1]
    kept = [x for f in untouched for x in lake.files.glob(f.replace("%", "?") + "/part-*")]
    assert maintenance.compact(lake, "gold", "t", run_id="r1", partition_by=["p"])
    assert rows(lake.read("gold", "t")) == before
    assert all(n == 1 for n, _ in maintenance.file_stats(lake, "gold", "t").values())
    assert kept and all(lake.files.exists(x) for x in kept)
    assert not maintenance.compact(lake, "gold", "t", run_id="r2", partition_by=["p"])


@pytest.mark.parametrize("how", ["compact", "cluster"])
def test_rewrite_killed_while_swapping_is_finished(spark, lake, monkeypatch, how):
    lake.append(spark.range(100).repartition(5), "gold", "t")

    def run():
        if how == "compact":
            return maintenance.compact(lake, "gold", "t", run_id="r1")
        return maintenance.cluster(lake, "gold", "t", key="id", run_id="r1")

    real = lake.unstage
    monkeypatch.setattr(lake, "unstage", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        run()
    monkeypatch.setattr(lake, "unstage", real)
    lake.files.delete(lake.path("gold", "t"))  # as if the swap had only removed the old files
    run()
    assert lake.read("gold", "t").count() == 100


def test_large_partition_gets_several_files(spark, lake):
    df = spark.range(4000).withColumn("p", F.lit(1)).withColumn("v", F.sha2(F.col("id").cast("string"), 256))
    lake.append(df.repartition(30), "gold", "t")
    maintenance.compact(lake, "gold", "t", run_id="r1", target_bytes=100_000)
    assert 1 < data_files(lake, "gold", "t") <= 5


def test_cluster_gives_disjoint_ranges(spark, lake):
    df = spark.range(5000).select((F.col("id") % 1000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    lake.append(df.repartition(6), "gold", "t")
    before = rows(lake.read("gold", "t"))
    maintenance.cluster(lake, "gold", "t", key="k", run_id="r1", target_bytes=60_000)
    table = lake.read("gold", "t")
    assert rows(table) == before
    spans = sorted(tuple(r)[1:] for r in table.groupBy(F.input_file_name()).agg(F.min("k"), F.max("k")).collect())
    assert len(spans) > 2 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_cluster_splits_one_hot_key(spark, lake):
    df = spark.range(5000).select(F.when(F.col("id") >= 0, "hot").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    lake.append(df, "gold", "t")
    maintenance.cluster(lake, "gold", "t", key="k", run_id="r1", target_bytes=60_000)
    sizes = [r["count"] for r in lake.read("gold", "t").groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 2 and max(sizes) < 4000


def test_currency_gate(spark):
    df = spark.createDataFrame([(1.0, "CZK"), (None, None), (2.0, None)], "amount double, ccy string")
    checked = quality.currency_tags(df, "t", [("amount", "ccy")])
    assert rows(checked) == [("t", "amount", 1)]
    with pytest.raises(quality.QualityGateFailed):
        quality.require_currency_tags(checked)
    assert rows(quality.currency_tags(df, "t", [("amount", "absent")])) == [("t", "amount", 2)]
    quality.require_currency_tags(quality.currency_tags(df.where("ccy is not null"), "t", [("amount", "ccy")]))


def test_unique_counts_null_as_a_value(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    assert rows(quality.unique(df, "t", ["k"])) == [("t", "k", 1, 1)]
    assert rows(quality.unique(df.where("k is not null"), "t", ["k"])) == [("t", "k", 0, 0)]


def test_reconcile_needs_both_counts(spark):
    df = spark.createDataFrame([("a", 5, 5), ("b", 5, 6), ("c", None, 1), ("d", 1, None)], "t string, bronze_row_count bigint, silver_row_count bigint")
    assert {r.t: r.reconciled for r in quality.reconcile(df).collect()} == {"a": True, "b": False, "c": False, "d": False}


def test_null_rate_verdicts(spark):
    df = spark.createDataFrame([(1, None, None), (1, 1, None)], "a int, b int, c int")
    got = {r.column_name: (r.null_rate, r.verdict) for r in quality.null_rate(df, "t", ["a", "b", "c"], 0.1, 0.6).collect()}
    assert got == {"a": (0.0, "OK"), "b": (0.5, "WARN"), "c": (1.0, "BLOCK")}


def test_all_checks_of_a_table_are_one_scan(spark, lake):
    lake.write_snapshot(spark.range(10).selectExpr("id as a", "id as b", "id as c"), "gold", "t")
    plan = quality.not_null(lake.read("gold", "t"), "t", ["a", "b", "c"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_encoding(spark):
    df = spark.createDataFrame([("ok",), ("Žluťoučký",), ("bad �",), (None,)], "v string")
    broken = df.unionByName(spark.sql("select cast(x'ff41' as string) as v"))
    assert rows(quality.encoding(broken, ["v"])) == [("v", 5, 2)]


def test_leaks_are_found(spark):
    serving = spark.createDataFrame([("0001", "C1"), ("0002", "x")], "masked string, other string")
    raw = spark.createDataFrame([("C1",), ("C2",)], "raw string")
    got = {r.column_name: r.leaked_values for r in quality.no_raw_identifier(serving, "t", ["masked", "other"], raw, "raw").collect()}
    assert got == {"masked": 0, "other": 1}


def test_growth_and_grain(spark):
    runs = spark.createDataFrame([("s", 1, 5), ("s", 2, 6), ("s", 3, 6), ("t", 1, 0)], "scope string, run int, n bigint")
    got = {(r.scope, r.run): r.verdict for r in quality.unknown_growth(runs, "run", "scope", "n").collect()}
    assert got == {("s", 1): "OK", ("s", 2): "WARN", ("s", 3): "OK", ("t", 1): "OK"}
    assert tuple(quality.grain(runs, "t", ["scope"]).first()) == ("t", 4, 2, 2.0)


@pytest.mark.parametrize("how", ["compact", "cluster"])
def test_partitions_are_kept_without_being_told(spark, lake, how):
    df = spark.range(300).withColumn("p", F.col("id") % 3)
    for part in (df.where("id < 250"), df.where("id >= 250 and p = 1")):
        lake.append(part, "gold", "t", partition_by=["p"])
    before = rows(lake.read("gold", "t").select("id", "p"))
    if how == "compact":
        assert maintenance.compact(lake, "gold", "t", run_id="r1")
    else:
        maintenance.cluster(lake, "gold", "t", key="id", run_id="r1")
    assert rows(lake.read("gold", "t").select("id", "p")) == before
    assert maintenance.partition_columns(lake, "gold", "t") == ["p"]
    with pytest.raises(ValueError):
        maintenance.compact(lake, "gold", "t", run_id="r2", partition_by=["id"])


IDS = ["001234567890", "12345678e901", "000000000000"]


def digits_table(spark, lake):
    """Load ids of digits only, or that read like a float; each in several files."""
    rows_ = spark.range(300).select(F.col("id"), F.element_at(F.array(*[F.lit(i) for i in IDS]), (F.col("id") % 3 + 1).cast("int")).alias("load_id"))
    rows_.repartition(6).write.partitionBy("load_id").parquet(lake.path("bronze", "s", "t"))


def test_partition_values_that_look_like_numbers_survive(spark, lake):
    digits_table(spark, lake)
    before = sorted((r.id, r.load_id) for r in lake.read("bronze", "s", "t", text_partitions=True).collect())
    assert {i for _, i in before} == set(IDS)
    assert maintenance.compact(lake, "bronze", "s", "t", run_id="r1")
    assert sorted((r.id, r.load_id) for r in lake.read("bronze", "s", "t", text_partitions=True).collect()) == before
    assert len(lake.files.glob(lake.path("bronze", "s", "t") + "/load_id=*/part-*")) == 3
    maintenance.cluster(lake, "bronze", "s", "t", key="id", run_id="r2")
    assert sorted((r.id, r.load_id) for r in lake.read("bronze", "s", "t", text_partitions=True).collect()) == before


def test_layout_keeps_the_types_of_partition_columns(spark, lake):
    rows_ = spark.createDataFrame([("007", 1, "2024-01-01"), ("1e5", 2, "x")], "a string, b int, c string")
    lake.write_snapshot(rows_, "gold", "t", partition_by=["a", "b"])
    assert lake.read("gold", "t").schema.simpleString() == "struct<c:string,a:string,b:int>"
    assert sorted(r.a for r in lake.read("gold", "t").collect()) == ["007", "1e5"]
    lake.write_snapshot(rows_.select(F.col("c").alias("a")), "gold", "t")
    assert sorted(r.a for r in lake.read("gold", "t").collect()) == ["2024-01-01", "x"]


def test_clustering_by_several_keys(spark, lake):
    """Either key alone names few of the files; skewed keys, nulls and text keys included."""
    df = spark.range(20_000).select(
        F.pmod(F.xxhash64("id"), F.lit(5000)).alias("a"), F.concat(F.lit("customer-"), F.lpad(F.pmod(F.hash("id"), F.lit(3000)).cast("string"), 6, "0")).alias("b"),
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("c"), F.repeat(F.lit("x"), 20).alias("pad"),
    )
    lake.write_snapshot(df.repartition(3), "gold", "t")
    size = sum(n for _, n in maintenance.file_stats(lake, "gold", "t").values())
    maintenance.cluster_multi(lake, "gold", "t", keys=["a", "b"], run_id="r1", target_bytes=size // 64)
    assert rows(lake.read("gold", "t")) == rows(df)
    spans = lake.read("gold", "t").groupBy(F.input_file_name().alias("f")).agg(F.min("a").alias("a0"), F.max("a").alias("a1"), F.min("b").alias("b0"), F.max("b").alias("b1")).collect()
    assert len(spans) > 40
    for value in (17, 2500, 4999):
        assert sum(s.a0 <= value <= s.a1 for s in spans) < len(spans) / 3
    for value in ("customer-000007", "customer-001500", "customer-002990"):
        assert sum(s.b0 <= value <= s.b1 for s in spans) < len(spans) / 3
    maintenance.cluster_multi(lake, "gold", "t", keys=["c", "a"], run_id="r2", target_bytes=size // 8)
    assert rows(lake.read("gold", "t")) == rows(df)


def test_range_ranks_take_a_few_comparisons_a_row(spark):
    cuts = [-3.0, -3.0, 0.0, 0.5, 0.5, 0.5, 7.0]
    values = [-9.0, -3.0, -1.0, 0.0, 0.5, 0.6, 7.0, 8.0, None]
    for n in (0, 1, 4, 7):  # a sketch may give fewer cuts
        df = spark.createDataFrame([(v, cuts[:n]) for v in values], "v double, c array<double>")
        got = df.select("v", maintenance._below(F.col("c"), F.col("v"), 3).alias("n")).collect()
        assert {(r.v, r.n) for r in got if r.v is not None} == {(v, sum(c < v for c in cuts[:n])) for v in values if v is not None}
    rows_ = spark.range(500).select(F.concat(F.lit("k"), "id").alias("a"), F.col("id").alias("b"))
    plan = maintenance.interleaved(rows_, ["a", "b"], "z")._jdf.queryExecution().optimizedPlan().toString()
    per_row = plan[: plan.index("Range (")]
    assert "filter(" not in per_row.split("scalar-subquery", 1)[0] and "aggregate(" in per_row
