"""SNK-05 / SNK-06: keyed upsert into a bucketed parquet table, and quarantine writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..lake import Lake, partition_folder
from .buckets import BUCKET, bucket_count, with_bucket
from .conform import VERDICT, dedup_latest

NULL_KEY = "_null_key"


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace target rows of the same key; the rest of the target stays."""
    return target.join(source.select(*keys), list(keys), "left_anti").unionByName(source, allowMissingColumns=True)


def upsert(
    lake: Lake,
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    run_id: str,
    buckets: int = 64,
    recency: Sequence[str] = ("updated_at", "created_at"),
    tiebreak: Sequence[str] = (),
) -> int:
    """Latest row per key wins; returns how many source rows were set aside for a NULL key.

    Rows live in ``bucket=<address of key>`` partitions and only buckets the source touches
    are read and rewritten. The source is staged in one pass, then the merged buckets, unless
    there is no table yet; calling again with the same run id finishes a swap that died half
    way. Choose ``buckets`` so that one bucket is a few GB: a table that has fewer grows, and
    one that has more keeps them.
    """
    n = bucket_count(lake, table, keys, buckets)
    lacks = F.lit(False)
    for k in keys:
        lacks = lacks | F.col(k).isNull()

    def latest_rows() -> DataFrame:
        # Rows without a key are told apart by a number, so they all stay and no task gets more than its share.
        marked = source.withColumn(NULL_KEY, F.when(lacks, F.monotonically_increasing_id()))
        return dedup_latest(marked, [*keys, NULL_KEY], recency, tiebreak)

    staged = lake.stage(latest_rows, "upsert", table, run_id, "source")
    latest = with_bucket(staged.where(F.col(NULL_KEY).isNull()).drop(NULL_KEY), keys, n)

    def merged() -> DataFrame:
        # At most one row for each bucket, so the broadcast is bounded; it also prunes the scan.
        touched = F.broadcast(latest.select(BUCKET).distinct())
        return merge_rows(lake.read("silver", table).join(touched, BUCKET, "left_semi"), latest, [BUCKET, *keys])

    if lake.exists("silver", table) or lake.is_staged("upsert", table, run_id, "merged"):
        latest = lake.stage(merged, "upsert", table, run_id, "merged")
    lake.overwrite_partitions(latest, "silver", table, partition_by=[BUCKET])
    bad = staged.where(F.col(NULL_KEY).isNotNull()).drop(NULL_KEY).withColumn(VERDICT, F.lit("null key"))
    null_keys = quarantine(lake, bad, f"{table}_null_key", run_id)
    lake.unstage("upsert", table, run_id)
    return null_keys


def read_upserted(lake: Lake, table: str) -> DataFrame:
    return lake.read("silver", table).drop(BUCKET)


def rows_in(lake: Lake, layer: str, *parts: str) -> int:
    """Rows below a path, from the footers of its files; none when there is nothing."""
    return lake.read(layer, *parts).count() if lake.exists(layer, *parts) else 0


def quarantine(lake: Lake, rejected: DataFrame, rule: str, run_id: str, verdict: str = VERDICT) -> int:
    """Write rejected rows with reason and run id to ``silver/quarantine_*`` tables; how many there are.

    Writing the same run again replaces its rows, also by none; a run without rejects leaves no table behind.
    """
    table = f"quarantine_{rule}"
    rows = rejected.withColumnRenamed(verdict, "reason").withColumn("run_id", F.lit(run_id))
    lake.replace_partition(rows, "silver", table, run_id=run_id)
    return rows_in(lake, "silver", table, partition_folder(run_id=run_id))


def split_write(lake: Lake, tagged: DataFrame, table: str, run_id: str, verdict: str = VERDICT) -> dict[str, int]:
    """SNK-06: write clean and rejected rows of one tagged frame in a single pass."""
    outcome = F.when(F.col(verdict).isNull(), "clean").otherwise("quarantined")
    rows = tagged.withColumns({"run_id": F.lit(run_id), "outcome": outcome}).withColumnRenamed(verdict, "reason")
    lake.replace_partition(rows, "silver", table, "outcome", run_id=run_id)
    return {k: rows_in(lake, "silver", table, partition_folder(run_id=run_id, outcome=k)) for k in ("clean", "quarantined")}
