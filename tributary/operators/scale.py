"""Joins, ranks and quantiles that hold up on very large and skewed inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import salted

ROWS_PER_TASK = 2_000_000
MAX_HOT_KEYS = 10_000
TRACKED_KEYS = 100_000
NULL_SPREAD = 1024
ONE_TASK_BYTES = 256 * 1024 * 1024
BROADCAST_BYTES = 10 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate: file sizes for a plain scan, an upper guess after joins, huge when unknown."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def hot_keys(df: DataFrame, key: str, rows_per_task: int) -> DataFrame:
    """``(_hot, _salts)`` for the keys that hold more than ``rows_per_task`` rows.

    A frequent-items sketch finds them in one pass without shuffling the keys. It gives
    at most MAX_HOT_KEYS rows, whatever the input size, so the result may be broadcast.
    """
    sketch = df.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {MAX_HOT_KEYS}, {TRACKED_KEYS})").alias("_top")
    )
    return (
        sketch.select(F.explode("_top").alias("_t"))
        .where(F.col("_t.count") > rows_per_task)
        .select(
            F.col("_t.item").alias("_hot"), F.ceil(F.col("_t.count") / F.lit(rows_per_task)).cast("bigint").alias("_salts")
        )
    )


def is_even(df: DataFrame, key: str, rows_per_task: int) -> bool:
    """True when neither a key nor NULL holds more than ``rows_per_task`` rows; one pass, one row to the driver."""
    most = F.expr(f"approx_top_k(`{key}`, 1, {TRACKED_KEYS}) filter (where `{key}` is not null)")
    found = df.agg(most.alias("top"), F.count_if(F.col(key).isNull()).alias("blank")).first()
    return found.blank <= rows_per_task and all(t["count"] <= rows_per_task for t in found.top or [])


def skew_safe_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "left",
    rows_per_task: int = ROWS_PER_TASK,
    small_bytes: int = ONE_TASK_BYTES,
    broadcast_bytes: int = BROADCAST_BYTES,
    weights: tuple[DataFrame, str] | None = None,
    *,
    count_first: bool = False,
) -> DataFrame:
    """Equi-join in which one left key, or NULL, may hold a large share of all rows.

    A right side whose size is known to be small is broadcast, so the left side does not
    move at all. A left side that a single task can take is joined as it is. So is, with
    ``count_first``, one whose keys turn out even when a job counts them: what groups by
    the key afterwards finds its rows in place. Else hot keys are salted in proportion to
    their size and their right rows repeated once per salt; NULL keys never match and are
    spread by row hash. Salting changes where rows meet, never which rows meet. The right
    key column is dropped.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type {how!r}")
    keyed = right.withColumnRenamed(right_key, "_right_key")
    if estimated_bytes(right) <= broadcast_bytes:
        return left.join(F.broadcast(keyed), F.col(left_key) == F.col("_right_key"), how).drop("_right_key")
    if estimated_bytes(left) <= small_bytes:
        return left.join(keyed, F.col(left_key) == F.col("_right_key"), how).drop("_right_key")
    measured, key = weights or (left, left_key)
    # Weights may know nothing of NULLs that arose on the way; an inner join drops them.
    if count_first and (weights is None or how == "inner") and is_even(measured.select(key), key, rows_per_task):
        return left.join(keyed, F.col(left_key) == F.col("_right_key"), how).drop("_right_key")
    kind = left.schema[left_key].dataType
    hot = hot_keys(measured.select(F.col(key).cast(kind).alias("_key")), "_key", rows_per_task)
    spread = F.xxhash64(*[F.col(c) for c in left.columns])
    salt = (
        F.when(F.col(left_key).isNull(), F.pmod(spread, F.lit(NULL_SPREAD)))
        .when(F.col("_salts").isNotNull(), F.pmod(spread, F.col("_salts")))
        .otherwise(F.lit(0))
        .cast("bigint")
    )
    salted_left = (
        left.join(F.broadcast(hot), F.col(left_key) == F.col("_hot"), "left")
        .withColumn("_salt", salt)
        .drop("_hot", "_salts")
    )
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    salted_right = (
        keyed.join(F.broadcast(hot), F.col("_right_key") == F.col("_hot"), "left")
        .withColumn("_right_salt", copies)
        .drop("_hot", "_salts")
    )
    matched = (F.col(left_key) == F.col("_right_key")) & (F.col("_salt") == F.col("_right_salt"))
    return salted_left.join(salted_right, matched, how).drop("_salt", "_right_salt", "_right_key")


def distributed_rank(
    df: DataFrame, key: str, salt: str, out: str, limit: int | None = None, hex_digits: int = 3
) -> DataFrame:
    """Dense 1-based position of every row in the order of ``md5(salt|key), key``.

    There is no global sort: rows are grouped by the first hex digits of the hash, each
    group is ranked on its own, and the group's starting offset is added. There are at
    most ``16 ** hex_digits`` groups, so the offset table is bounded and broadcast.
    ``key`` must be unique. With ``limit``, groups past the limit are never shuffled.
    """
    hashed = df.withColumn("_h", F.md5(salted(salt, F.col(key)))).withColumn("_g", F.substring("_h", 1, hex_digits))
    before = Window.partitionBy(F.lit(0)).orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy("_g").agg(F.count("*").alias("_size"))
        .select("_g", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    if limit is not None:
        offsets = offsets.where(F.col("_offset") < limit)
    within = Window.partitionBy("_g").orderBy("_h", key)
    ranked = (
        hashed.join(F.broadcast(offsets), "_g")
        .withColumn(out, F.col("_offset") + F.row_number().over(within))
        .drop("_g", "_h", "_offset")
    )
    return ranked if limit is None else ranked.where(F.col(out) <= limit)


def exact_quantiles(df: DataFrame, column: str, quantiles: dict[str, float], accuracy: int = 100_000) -> DataFrame:
    """One row with the exact discrete quantiles of a numeric column.

    A mergeable sketch brackets each quantile first; its error bound guarantees that the
    answer lies in the bracket, which holds about ``8 / accuracy`` of the rows. One pass
    counts what lies below every bracket, and only the distinct values inside brackets
    are ordered, so no task sorts or buffers the whole column.
    """
    value = F.col(column)
    # Bracketing compares doubles; rounding keeps order, so a bracket never loses its answer.
    values = df.where(value.isNotNull()).select(value.alias("_v"), value.cast("double").alias("_d"))
    slack = 4.0 / accuracy
    names = list(quantiles)
    edges = [max(0.0, quantiles[n] - slack) for n in names] + [min(1.0, quantiles[n] + slack) for n in names]
    sketch = values.agg(
        F.percentile_approx("_d", [float(e) for e in edges], accuracy).alias("edges")
    )
    bounds = sketch.select("edges").scalar()
    bracketed = values.withColumn("_edges", bounds)

    def low(i: int) -> Column:
        return F.col("_edges")[i]

    def high(i: int) -> Column:
        return F.col("_edges")[i + len(names)]

    below = bracketed.agg(
        F.count("*").alias("_total"),
        *[F.count_if(F.col("_d") < low(i)).alias(f"_below_{i}") for i in range(len(names))],
    )
    rank = [F.greatest(F.lit(1), F.ceil(F.lit(float(quantiles[n])) * F.col("_total"))) for n in names]
    targets = below.select(
        F.array(*[(r - F.col(f"_below_{i}")).cast("bigint") for i, r in enumerate(rank)]).alias("targets")
    ).scalar()
    hits = F.filter(
        F.array(*[F.when(F.col("_d").between(low(i), high(i)), F.lit(i)) for i in range(len(names))]),
        lambda x: x.isNotNull(),
    )
    inside = bracketed.select(F.explode(hits).alias("_i"), "_v").groupBy("_i", "_v").agg(F.count("*").alias("_n"))
    running = Window.partitionBy("_i").orderBy("_v")
    positioned = (
        inside.withColumn("_cum", F.sum("_n").over(running))
        .withColumn("_goal", F.element_at(targets, F.col("_i") + 1))
        .where(F.col("_cum") >= F.col("_goal"))
    )
    return positioned.agg(*[F.min(F.when(F.col("_i") == i, F.col("_v"))).alias(n) for i, n in enumerate(names)])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in a total order.

    The filter on the rank becomes a group limit below the shuffle, so every map task
    sends at most one row per key and a hot key costs no more than a cold one.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")
