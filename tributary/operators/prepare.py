"""Preparation transforms: dates, ids, stamps and reproducible samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import salted
from .scale import distributed_rank, latest_per_key


def rebase_dates(df: DataFrame, column: str, target_max: str, out: str | None = None) -> DataFrame:
    """PRP-01: shift the whole column so that its maximum becomes ``target_max``."""
    newest = df.agg(F.max(F.col(column).cast("date"))).scalar()
    shift = F.date_diff(F.lit(target_max).cast("date"), newest)
    return df.withColumn(out or column, F.date_add(F.col(column).cast("date"), shift))


def step_to_timestamp(step: Column, base: str) -> Column:
    """PRP-02: hours since a base date as a timestamp."""
    return F.lit(base).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), step.cast("int"))


def audit_stamp(df: DataFrame, at: str, currency: str | None = None) -> DataFrame:
    """PRP-04: created/updated/deleted columns, and the currency tag when the table holds money."""
    when = F.lit(at).cast("timestamp_ntz")
    stamps = {"created_at": when, "updated_at": when, "is_deleted": F.lit(False)}
    if currency is not None:
        stamps["currency"] = F.lit(currency)
    return df.withColumns(stamps)


def hash_sample(df: DataFrame, key: str, n: int, salt: str) -> DataFrame:
    """PRP-05: the ``n`` rows first in a salted hash order; same rows on every run."""
    return distributed_rank(df, key, salt, "_pos", limit=n).drop("_pos")


def capped_group_sample(df: DataFrame, group: str, key: str, cap: int, salt: str) -> DataFrame:
    """PRP-06: at most ``cap`` rows per group, chosen by hash.

    The cap is applied below the shuffle as well, so a huge group sends ``cap`` rows per task.
    """
    from pyspark.sql import Window

    order = Window.partitionBy(group).orderBy(F.md5(salted(salt, F.col(key))), F.col(key))
    return df.withColumn("_pos", F.row_number().over(order)).where(F.col("_pos") <= cap).drop("_pos")


def coordinated_sample(
    roots: DataFrame, root_key: str, n: int, salt: str, links: Sequence[tuple[DataFrame, str, str, str]]
) -> list[DataFrame]:
    """PRP-07: sample root rows, then keep only rows linked to what was kept before.

    Each link is ``(table, its column, column of the previous table)`` plus a name used in errors.
    """
    kept = [hash_sample(roots, root_key, n, salt)]
    for table, column, previous, name in links:
        if column not in table.columns:
            raise ValueError(f"{name}: no column {column!r}")
        keys = kept[-1].select(F.col(previous).alias(column)).distinct()
        kept.append(table.join(keys, column, "left_semi"))
    return kept


__all__ = [
    "audit_stamp",
    "capped_group_sample",
    "coordinated_sample",
    "hash_sample",
    "latest_per_key",
    "rebase_dates",
    "step_to_timestamp",
]
