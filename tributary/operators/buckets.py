"""Buckets of a keyed table. Their number is kept with the table and grows by splitting single buckets.

Linear hashing: with ``n`` buckets a key's hash is taken modulo the next power of two, and addresses from ``n`` on fall
back on the bucket they will be split from. Whatever path a table took to ``n`` buckets, a key has one address.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..lake import Lake

BUCKET = "bucket"


def address(hashed: Column, buckets: int) -> Column:
    full = 1 << (buckets - 1).bit_length()
    wide = F.pmod(hashed, F.lit(full))
    return F.when(wide < buckets, wide).otherwise(wide - full // 2).cast("int")


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, address(F.xxhash64(*[F.col(k).cast("string") for k in keys]), buckets))


def split_buckets(now: int, later: int) -> list[int]:
    """The buckets of ``now`` that hand rows over when there are ``later``."""
    found = set()
    for new in range(now, later):
        while new >= now:
            new -= 1 << (new.bit_length() - 1)
        found.add(new)
    return sorted(found)


def finish_swaps(lake: Lake, table: str, topics: Sequence[str] = ("upsert", "state")) -> None:
    """Completes bucket swaps that died half way; the runs they belong to start over when they are called again."""
    for topic in topics:
        for marker in lake.files.glob(lake.path("staging", topic, table) + "/*/merged/_SUCCESS"):
            run_id = marker.rsplit("/", 3)[1]
            lake.overwrite_partitions(lake.read("staging", topic, table, run_id, "merged"), "silver", table, partition_by=[BUCKET])
            lake.unstage(topic, table, run_id)


def grow(lake: Lake, table: str, keys: Sequence[str], now: int, later: int) -> None:
    """Only buckets that hand rows over are read and written. A call that died is finished by the next one."""
    plan = ("grow", table, f"{now}-{later}")
    split = split_buckets(now, later)

    def moved() -> DataFrame:
        return with_bucket(lake.read("silver", table).where(F.col(BUCKET).isin(split)).drop(BUCKET), keys, later)

    staged = lake.stage(moved, *plan)
    lake.overwrite_partitions(staged, "silver", table, partition_by=[BUCKET])
    filled = {r[0] for r in staged.select(BUCKET).distinct().collect()}  # at most a row for each bucket
    for bucket in set(split) - filled:
        lake.files.delete(f"{lake.path('silver', table)}/{BUCKET}={bucket}")
    lake.note_layout("silver", table, buckets=later)
    lake.unstage(*plan)


def bucket_count(lake: Lake, table: str, keys: Sequence[str], wanted: int) -> int:
    """How many buckets to use for ``table``: ``wanted``, or more when it has more already.

    A table that has fewer grows first. One whose number of buckets nobody wrote down is dealt anew, once.
    """
    if not lake.exists("silver", table):
        lake.note_layout("silver", table, buckets=wanted)
        return wanted
    for marker in lake.files.glob(lake.path("staging", "grow", table) + "/*/_SUCCESS"):
        now, later = map(int, marker.rsplit("/", 2)[1].split("-"))
        grow(lake, table, keys, now, later)
    now = lake.layout("silver", table).get("buckets")
    if now is not None and now >= wanted:
        return now
    finish_swaps(lake, table)
    if now is not None:
        grow(lake, table, keys, now, wanted)
        return wanted
    plan = ("rebucket", table, str(wanted))
    lake.write_snapshot(lake.stage(lambda: with_bucket(lake.read("silver", table).drop(BUCKET), keys, wanted), *plan), "silver", table, partition_by=[BUCKET])
    lake.note_layout("silver", table, buckets=wanted)
    lake.unstage(*plan)
    return wanted
