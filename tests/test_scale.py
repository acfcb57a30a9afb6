import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tributary.operators import scale


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_skew_safe_join_equals_plain_join(spark, how):
    # A third of the rows on one key, NULL keys, exact copies, misses, and repeated right keys.
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 50).cast("string")).alias("k"),
        (F.col("id") % 5).alias("v"),
    )
    right = spark.createDataFrame([("hot", "a"), ("hot", "b"), *[(str(i), f"r{i}") for i in range(0, 50, 2)], ("unused", "z")], "rk string, w string")
    salted = scale.skew_safe_join(left, right, "k", "rk", how, rows_per_task=20, small_bytes=0, broadcast_bytes=0)
    plain = left.join(right, F.col("k") == F.col("rk"), how).drop("rk")
    assert rows(salted) == rows(plain)
    assert salted.columns == plain.columns


def test_weights_only_steer_the_salting(spark):
    left = spark.range(300).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    right = spark.createDataFrame([("hot", 1), ("3", 2)], "rk string, w int")
    misleading = spark.createDataFrame([("3",)] * 50, "other string")
    salted = scale.skew_safe_join(left, right, "k", "rk", rows_per_task=5, small_bytes=0, broadcast_bytes=0, weights=(misleading, "other"))
    assert rows(salted) == rows(left.join(right, F.col("k") == F.col("rk"), "left").drop("rk"))


def test_hot_keys_are_split_in_proportion(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 600, 1).otherwise(F.col("id")).alias("k"))
    assert rows(scale.hot_keys(df, "k", 100)) == [(1, 6)]


def test_hot_key_spreads_over_tasks(spark):
    left = spark.range(4000).select(F.when(F.col("id") >= 0, "hot").alias("k"), F.col("id").alias("v"))
    right = spark.createDataFrame([("hot", 1)], "rk string, w int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = scale.skew_safe_join(left, right.hint("merge"), "k", "rk", rows_per_task=100, small_bytes=0, broadcast_bytes=0)
        per_task = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert per_task < 4000 / 2


@pytest.mark.parametrize("how", ["left", "inner"])
def test_even_keys_are_joined_as_they_are(spark, how):
    left = spark.range(600).select(F.when(F.col("id") % 60 > 0, (F.col("id") % 60).cast("string")).alias("k"), F.col("id").alias("v"))
    right = spark.range(40).select(F.col("id").cast("string").alias("rk"), F.lit(1).alias("w"))
    want = rows(left.join(right, F.col("k") == F.col("rk"), how).drop("rk"))
    for limit, salted in ((10, False), (9, True)):  # ten rows a key, and ten without one
        joined = scale.skew_safe_join(left, right, "k", "rk", how, rows_per_task=limit, small_bytes=0, broadcast_bytes=0, count_first=True)
        assert ("approx_top_k" in plan(joined)) == salted
        assert rows(joined) == want
    blank = left.withColumn("k", F.when(F.col("v") > 100, F.col("k")))
    assert "approx_top_k" in plan(scale.skew_safe_join(blank, right, "k", "rk", how, rows_per_task=20, small_bytes=0, broadcast_bytes=0, count_first=True))


def test_sizes_decide_the_kind_of_join(spark):
    left = spark.range(10).select(F.col("id").cast("string").alias("k"))
    right = spark.range(10).select(F.col("id").cast("string").alias("rk"), F.lit(1).alias("w"))
    assert "BroadcastHashJoin" in plan(scale.skew_safe_join(left, right, "k", "rk"))
    plain = plan(scale.skew_safe_join(left, right, "k", "rk", broadcast_bytes=0))
    assert "approx_top_k" not in plain and "ResolvedHint" not in plain
    assert "approx_top_k" in plan(scale.skew_safe_join(left, right, "k", "rk", broadcast_bytes=0, small_bytes=0))


def test_distributed_rank_equals_global_order(spark):
    df = spark.range(5000).select(F.concat(F.lit("k"), F.col("id")).alias("k"))
    ranked = scale.distributed_rank(df, "k", "s", "pos")
    whole = df.withColumn("pos", F.row_number().over(Window.orderBy(F.md5(F.concat(F.lit("s|"), "k")), "k")))
    assert rows(ranked) == rows(whole)
    limited = scale.distributed_rank(df, "k", "s", "pos", limit=37)
    assert rows(limited) == rows(whole.where("pos <= 37"))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 4001])
@pytest.mark.parametrize("accuracy", [20, 100_000])
def test_exact_quantiles(spark, n, accuracy):
    rng = random.Random(n)
    values = [rng.choice([rng.randint(-50, 50), rng.random() * 1000, 7]) for _ in range(n)]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    wanted = {"lo": 0.0, "q": 0.25, "m": 0.5, "h": 0.9, "hi": 1.0}
    got = scale.exact_quantiles(df, "v", wanted, accuracy).first().asDict()
    ordered = sorted(values)
    expected = {k: float(ordered[max(1, math.ceil(p * n)) - 1]) if n else None for k, p in wanted.items()}
    assert got == expected


def test_exact_quantiles_with_one_value_holding_most_rows(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 10 < 6, 5).otherwise(F.col("id")).cast("decimal(18,2)").alias("v"))
    got = scale.exact_quantiles(df, "v", {"a": 0.25, "b": 0.75}, accuracy=50).first()
    ordered = sorted(float(r.v) for r in df.collect())
    assert (float(got.a), float(got.b)) == (ordered[math.ceil(9000 * 0.25) - 1], ordered[math.ceil(9000 * 0.75) - 1])


def test_latest_per_key_limits_below_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    latest = scale.latest_per_key(df, ["k"], [F.col("id").desc()])
    text = plan(latest)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert rows(latest) == [(0, 99), (1, 97), (2, 98)]
