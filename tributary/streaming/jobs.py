"""STR-01..04 on Structured Streaming."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..lake import Lake
from ..operators.buckets import BUCKET, bucket_count, with_bucket
from ..operators.conform import last_changes
from ..operators.promotion import only_new_changes
from ..operators.scale import latest_per_key


def landing_stream(lake: Lake, source: str, table: str, declared: StructType, files_per_trigger: int = 1000) -> DataFrame:
    """The landing zone as a stream: a new file is read once, the checkpoint is the offset."""
    full = StructType([*declared.fields]).add("dt", "string")
    return (
        lake.spark.readStream.schema(full)
        .option("maxFilesPerTrigger", files_per_trigger)
        .json(lake.path("landing", source, table))
    )


def _run(stream: DataFrame, lake: Lake, name: str, each_batch) -> StreamingQuery:
    return (
        stream.writeStream.option("checkpointLocation", lake.path("control", "checkpoints", name))
        .trigger(availableNow=True)
        .foreachBatch(each_batch)
        .start()
    )


def stream_promote(lake: Lake, stream: DataFrame, table: str) -> StreamingQuery:
    """STR-01: exactly-once append of change events to Bronze.

    Each micro-batch owns one ``batch_id`` partition and overwrites it, so a replayed
    batch lands on itself; it is compared only with earlier batches, and of those only
    with the sequence range it touches.
    """

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        bronze = None
        if lake.exists("bronze", table):
            span = batch.agg(F.struct(F.min("seq").alias("low"), F.max("seq").alias("high"))).scalar()
            earlier = lake.read("bronze", table).where(F.col("batch_id") < batch_id)
            # An event without a sequence number can come again at any time.
            bronze = earlier.where(F.col("seq").isNull() | F.col("seq").between(span["low"], span["high"]))
        fresh = only_new_changes(batch, bronze)
        lake.overwrite_partitions(fresh.withColumn("batch_id", F.lit(batch_id)), "bronze", table, partition_by=["batch_id"])

    return _run(stream, lake, f"promote_{table}", each_batch)


def stream_dedup(lake: Lake, stream: DataFrame, table: str, event_time: str, delay: str) -> StreamingQuery:
    """STR-02: drop redelivered events; state is kept only as long as ``delay``, the longest redelivery lag."""
    unique = stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["pk_value", "op", "seq"])
    return (
        unique.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", lake.path("control", "checkpoints", f"dedup_{table}"))
        .option("path", lake.path("bronze", table))
        .trigger(availableNow=True)
        .start()
    )


def apply_changes(lake: Lake, events: DataFrame, table: str, run_id: str, buckets: int = 64) -> None:
    """Fold change events into a latest-state table; an older event never replaces a newer one.

    Deletes stay as tombstones, so a late update cannot bring a deleted key back. Folding
    the same events again changes nothing. The table has ``buckets`` key buckets or more.
    """
    n = bucket_count(lake, table, ["pk_value"], buckets)
    latest = with_bucket(lake.stage(lambda: last_changes(events), "state", table, run_id, "changes"), ["pk_value"], n)

    def merged() -> DataFrame:
        touched = F.broadcast(latest.select(BUCKET).distinct())  # at most `buckets` rows
        current = lake.read("silver", table).join(touched, BUCKET, "left_semi")
        return latest_per_key(current.unionByName(latest), [BUCKET, "pk_value"], [F.col("seq").desc()])

    if lake.exists("silver", table) or lake.is_staged("state", table, run_id, "merged"):
        latest = lake.stage(merged, "state", table, run_id, "merged")
    lake.overwrite_partitions(latest, "silver", table, partition_by=[BUCKET])
    lake.unstage("state", table, run_id)


def current_state(lake: Lake, table: str) -> DataFrame:
    return lake.read("silver", table).where("op <> 'D'").drop(BUCKET)


def stream_latest_state(lake: Lake, stream: DataFrame, table: str, buckets: int = 64) -> StreamingQuery:
    """STR-03: keep the latest state per key as events arrive in any order."""

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        apply_changes(lake, batch, table, f"batch-{batch_id}", buckets)

    return _run(stream, lake, f"state_{table}", each_batch)


def fraud_windows(stream: DataFrame, event_time: str, width: str, delay: str = "5 minutes") -> DataFrame:
    """STR-04: fraud per tumbling window; rows later than ``delay`` are left out by contract."""
    return (
        stream.withWatermark(event_time, delay)
        .groupBy(F.window(event_time, width))
        .agg(F.count("*").alias("txn_count"), F.count_if("is_fraud").alias("fraud_count"))
        .select(F.col("window.start").alias("window_start"), "txn_count", "fraud_count")
    )


def stream_fraud_window(lake: Lake, stream: DataFrame, table: str, event_time: str, width: str) -> StreamingQuery:
    """Windows are written once the watermark has closed them."""
    return (
        fraud_windows(stream, event_time, width).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", lake.path("control", "checkpoints", f"window_{table}"))
        .option("path", lake.path("gold", table))
        .trigger(availableNow=True)
        .start()
    )


def stream_windows_with_late(
    lake: Lake, stream: DataFrame, table: str, event_time: str, width: str, delay: str = "5 minutes"
) -> StreamingQuery:
    """STR-04 with late rows as data: fraud per window, and every row that came too late in ``<table>_late``.

    The mark is the newest event time of all earlier batches less ``delay``. A window counts the rows that are not behind
    the mark when they arrive; those behind it go to the late table, so every row with an event time is in one of both.
    Windows that the mark has not passed keep their counts in a table of their own until it does. Each batch owns a
    partition in every table and overwrites it, so a replayed batch lands on itself.
    """
    names = {kind: f"{table}_{kind}" for kind in ("late", "open", "marks")}

    def read(layer: str, name: str, batch_id: int) -> DataFrame | None:
        return lake.read(layer, name).where(F.col("batch_id") < batch_id) if lake.exists(layer, name) else None

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        marks = read("control", names["marks"], batch_id)
        before = None if marks is None else marks.agg(F.max("newest")).first()[0]  # one value for each batch
        mark = F.lit(before).cast("timestamp") - F.expr(f"interval {delay}")
        late = F.coalesce(F.col(event_time) < mark, F.lit(False))
        own = lake.stage(lambda: batch.withColumn("_late", late), "windows", table, str(batch_id))
        lake.note_layout("silver", names["late"], columns=batch.schema.json())
        newest = own.agg(F.max(event_time).alias("newest")).withColumn("batch_id", F.lit(batch_id)).where("newest is not null")
        lake.overwrite_partitions(own.where("_late").drop("_late").withColumn("batch_id", F.lit(batch_id)), "silver", names["late"], partition_by=["batch_id"])
        fresh = own.where(~F.col("_late") & F.col(event_time).isNotNull()).groupBy(F.window(event_time, width).alias("w")).agg(
            F.count("*").alias("txn_count"), F.count_if("is_fraud").alias("fraud_count")
        ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "txn_count", "fraud_count")
        pending = read("control", names["open"], batch_id)
        # Of earlier batches only the newest holds what is still open.
        if pending is not None:
            fresh = fresh.unionByName(pending.where(F.col("batch_id") == pending.agg(F.max("batch_id")).scalar()).drop("batch_id"))
        counts = fresh.groupBy("window_start", "window_end").agg(F.sum("txn_count").alias("txn_count"), F.sum("fraud_count").alias("fraud_count"))
        # A row is late only when it lies behind the mark, so a window is closed only by a mark past its end.
        latest = F.greatest(F.lit(before).cast("timestamp"), newest.agg(F.max("newest")).scalar()) - F.expr(f"interval {delay}")
        counts = counts.withColumns({"closed": F.coalesce(F.col("window_end") <= latest, F.lit(False)), "batch_id": F.lit(batch_id)})
        counts = lake.stage(lambda: counts, "windows", table, f"{batch_id}-counts")
        # A batch without rows leaves a marker row, else the windows of the batch before would count as open again.
        still = counts.where(~F.col("closed")).drop("closed")
        lake.overwrite_partitions(counts.where("closed").drop("closed", "window_end"), "gold", table, partition_by=["batch_id"])
        lake.overwrite_partitions(still.unionByName(_no_window(lake, batch_id)), "control", names["open"], partition_by=["batch_id"])
        lake.overwrite_partitions(newest, "control", names["marks"], partition_by=["batch_id"])
        lake.unstage("windows", table, str(batch_id))
        lake.unstage("windows", table, f"{batch_id}-counts")

    return _run(stream, lake, f"windows_{table}", each_batch)


WINDOWS = "window_start timestamp, txn_count bigint, fraud_count bigint, batch_id int"


def window_counts(lake: Lake, table: str) -> DataFrame:
    """Closed windows, and those the newest batch left open, with ``closed``."""
    done = lake.read("gold", table) if lake.exists("gold", table) else lake.spark.createDataFrame([], WINDOWS)
    done = done.select("window_start", "txn_count", "fraud_count", F.lit(True).alias("closed"))
    pending = lake.read("control", f"{table}_open")
    newest = pending.where((F.col("batch_id") == pending.agg(F.max("batch_id")).scalar()) & (F.col("txn_count") > 0))
    return done.unionByName(newest.select("window_start", "txn_count", "fraud_count", F.lit(False).alias("closed")))


def late_table(lake: Lake, table: str) -> DataFrame:
    """The rows that came behind the mark, with the batch they came in."""
    if lake.exists("silver", f"{table}_late"):
        return lake.read("silver", f"{table}_late")
    columns = StructType.fromJson(json.loads(lake.layout("silver", f"{table}_late")["columns"]))
    return lake.spark.createDataFrame([], StructType([*columns.fields]).add("batch_id", "integer"))


def _no_window(lake: Lake, batch_id: int) -> DataFrame:
    """The row that says a batch was here; it adds nothing to any window."""
    return lake.spark.sql(
        f"select timestamp'1970-01-01' as window_start, timestamp'9999-01-01' as window_end, 0L as txn_count, 0L as fraud_count, {batch_id} as batch_id"
    )


def late_rows(query: StreamingQuery) -> int:
    """How many rows a finished or running query left out because they came after the watermark."""
    return sum(
        int(op["numRowsDroppedByWatermark"]) for progress in query.recentProgress for op in progress["stateOperators"]
    )
