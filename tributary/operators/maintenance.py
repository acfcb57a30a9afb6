"""Table upkeep: compaction, clustering, landing retention."""

from __future__ import annotations

import math
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, TimestampNTZType, TimestampType

from ..lake import Lake
from .promotion import pending_partitions, read_ledger

TARGET_FILE_BYTES = 256 * 1024 * 1024
MAX_BROADCAST_ROWS = 100_000


def file_stats(lake: Lake, layer: str, *parts: str) -> dict[str, tuple[int, int]]:
    """Per directory of a table: (data files, bytes), from the file listing alone."""
    fs, target = lake.files._open(lake.path(layer, *parts))
    stats: dict[str, tuple[int, int]] = {}
    if not fs.exists(target):
        return stats
    entries = fs.listFiles(target, True)
    while entries.hasNext():
        status = entries.next()
        if status.getPath().getName().startswith(("_", ".")):
            continue
        folder = status.getPath().getParent().toString()
        files, size = stats.get(folder, (0, 0))
        stats[folder] = (files + 1, size + status.getLen())
    return stats


def partition_columns(lake: Lake, layer: str, *parts: str) -> list[str]:
    """The partition columns of a table, as its directories name them."""
    return lake.files.partition_columns(lake.path(layer, *parts))


def compact(
    lake: Lake, layer: str, *parts: str, run_id: str, partition_by: Sequence[str] | None = None, target_bytes: int = TARGET_FILE_BYTES
) -> bool:
    """MNT-01: fewer, larger files with the same rows; only directories with too many files are rewritten.

    A missing or already compact table is left alone. Partitions are kept whether or not they are named; their values
    are handled as the text of their directory names, so rows stay in the directory they are in.
    """
    base = lake.path(layer, *parts)
    found = partition_columns(lake, layer, *parts)
    if partition_by and found and list(partition_by) != found:
        raise ValueError(f"the table is partitioned by {found}, not {list(partition_by)}")
    partition_by = found or list(partition_by or ())
    plan = ("compact", layer, *parts, run_id)
    crowded = {}
    for folder, (files, size) in file_stats(lake, layer, *parts).items():
        wanted = max(1, math.ceil(size / target_bytes))
        if files > wanted:
            crowded[folder] = wanted
    if lake.is_staged(*plan):  # an earlier call died while swapping: finish that first
        unfinished = lake.read("staging", *plan, text_partitions=True)
        partition_by = partition_columns(lake, "staging", *plan)
        if partition_by:
            _swap_in(unfinished, base, partition_by)
        else:
            unfinished.write.mode("overwrite").parquet(base)
        lake.unstage(*plan)
        return True
    if not crowded:
        return False
    # The copy is partitioned like the table, so its layout outlives a swap that died.
    rows = lake.read_as({c: StringType() for c in partition_by}, base, *crowded)
    lake.write_snapshot(rows, "staging", *plan, partition_by=partition_by)
    staged = lake.read("staging", *plan, text_partitions=True)
    row = F.xxhash64(*[F.col(c) for c in staged.columns])
    total = sum(crowded.values())
    if not partition_by:
        staged.repartition(total, row).write.mode("overwrite").parquet(base)
        lake.unstage(*plan)
        return True
    # One row per rewritten partition: its values and how many files it should have.
    values = [tuple(unquote(f.rsplit(f"{c}=", 1)[1].split("/")[0]) for c in partition_by) + (n,) for f, n in crowded.items()]
    names = [f"_p{i}" for i in range(len(partition_by))]
    sizes = lake.spark.createDataFrame(values, ", ".join(f"{n} string" for n in names) + ", _files int")
    if len(values) <= MAX_BROADCAST_ROWS:
        sizes = F.broadcast(sizes)
    same = [staged[c] == sizes[n] for c, n in zip(partition_by, names)]
    placed = staged.join(sizes, same, "left").withColumn("_file", F.pmod(row, F.coalesce("_files", F.lit(1))))
    placed = placed.repartition(total, *[F.col(c) for c in partition_by], F.col("_file")).drop(*names, "_files", "_file")
    _swap_in(placed, base, partition_by)
    lake.unstage(*plan)
    return True


def _swap_in(rows: DataFrame, base: str, partition_by: Sequence[str]) -> None:
    """Replaces the partitions present in ``rows``; the table's layout stays as it is written down."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(base)


def cluster(lake: Lake, layer: str, *parts: str, key: str, run_id: str, target_bytes: int = TARGET_FILE_BYTES) -> None:
    """MNT-02: range-cluster by one key so a point lookup skips nearly every file.

    The row hash is a second range column: a key too big for one file is split over several.
    """
    plan = ("cluster", layer, *parts, run_id)
    # The copy is partitioned like the table, so its layout outlives a swap that died.
    if not lake.is_staged(*plan):
        lake.write_snapshot(lake.read(layer, *parts, text_partitions=True), "staging", *plan, partition_by=partition_columns(lake, layer, *parts))
    staged = lake.read("staging", *plan, text_partitions=True)
    inside = partition_columns(lake, "staging", *plan)
    size = sum(s for _, s in file_stats(lake, "staging", *plan).values())
    row = F.xxhash64(*[F.col(c) for c in staged.columns])
    ranges = max(1, math.ceil(size / target_bytes))
    # Partitions stay; within each, files cover ranges of the key.
    arranged = staged.repartitionByRange(ranges, *inside, F.col(key), row).sortWithinPartitions(*inside, key)
    arranged.write.mode("overwrite").partitionBy(*inside).parquet(lake.path(layer, *parts))
    lake.unstage(*plan)


RANK_BITS = 8


def _as_number(column: Column, kind: DataType, prefix: Column | None) -> Column:
    """A number in the order of the column; of text seven bytes count, those after what all values begin with."""
    if isinstance(kind, StringType):
        rest = F.substr(column, F.length(prefix) + F.lit(1))
        return F.conv(F.rpad(F.substring(F.hex(F.encode(rest, "UTF-8")), 1, 14), 14, "0"), 16, 10).cast("double")
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    return column.cast("double")


def _common_prefix(low: Column, high: Column) -> Column:
    """What two texts begin with alike."""
    places = F.sequence(F.lit(1), F.greatest(F.least(F.length(low), F.length(high)), F.lit(1)))
    same = F.filter(places, lambda i: F.substr(low, F.lit(1), i) == F.substr(high, F.lit(1), i))
    return F.substr(low, F.lit(1), F.coalesce(F.array_max(same), F.lit(0)))


def _below(cuts: Column, value: Column, bits: int) -> Column:
    """How many of up to ``2 ** bits - 1`` ascending cuts lie below a value, halving what is left: ``bits`` comparisons a row."""
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda n, step: n + F.when(F.get(cuts, n + step - 1) < value, step).otherwise(0))


def interleaved(df: DataFrame, keys: Sequence[str], out: str, bits: int = RANK_BITS) -> DataFrame:
    """``df`` with the interleaved bits of each row's range rank in every key.

    Ranks come from a quantile sketch, so they split skewed keys evenly; NULL ranks first. The cut values stay in the
    plan: a bounded array for each key.
    """
    kinds = {k: df.schema[k].dataType for k in keys}
    numbers, prefix = df, {}
    for i, k in enumerate(keys):
        if isinstance(kinds[k], StringType):
            ends = df.agg(F.min(k).alias("low"), F.max(k).alias("high"))
            numbers = numbers.withColumn(f"_p{i}", ends.select(_common_prefix(F.col("low"), F.col("high"))).scalar())
            prefix[k] = F.col(f"_p{i}")
    numbers = numbers.withColumns({f"_n{i}": _as_number(F.col(k), kinds[k], prefix.get(k)) for i, k in enumerate(keys)})
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = numbers.agg(*[F.percentile_approx(f"_n{i}", shares, 10_000).alias(f"c{i}") for i in range(len(keys))])
    value = F.lit(0).cast("long")
    for i in range(len(keys)):
        own = F.col(f"_n{i}")
        numbers = numbers.withColumn(f"_c{i}", cuts.select(f"c{i}").scalar())
        below = F.when(own.isNull(), F.lit(0)).otherwise(_below(F.col(f"_c{i}"), own, bits))
        numbers = numbers.withColumn(f"_r{i}", below.cast("long"))
        for bit in range(bits):
            value = value + F.shiftleft(F.shiftright(F.col(f"_r{i}"), bit).bitwiseAND(F.lit(1).cast("long")), bit * len(keys) + i)
    return numbers.withColumn(out, value).drop(*[f"_{x}{i}" for x in "ncpr" for i in range(len(keys))])


def cluster_multi(lake: Lake, layer: str, *parts: str, keys: Sequence[str], run_id: str, target_bytes: int = TARGET_FILE_BYTES) -> None:
    """MNT-02: cluster by several keys at once, so that a lookup by any of them skips most files.

    Files cover ranges of the interleaved range ranks; partitions stay. A run that died is finished by the next call.
    """
    plan = ("cluster", layer, *parts, run_id)
    if not lake.is_staged(*plan):
        lake.write_snapshot(lake.read(layer, *parts, text_partitions=True), "staging", *plan, partition_by=partition_columns(lake, layer, *parts))
    staged = lake.read("staging", *plan, text_partitions=True)
    inside = partition_columns(lake, "staging", *plan)
    size = sum(s for _, s in file_stats(lake, "staging", *plan).values())
    row = F.xxhash64(*[F.col(c) for c in staged.columns])
    ranges = max(1, math.ceil(size / target_bytes))
    placed = interleaved(staged, keys, "_z").repartitionByRange(ranges, *inside, "_z", row).sortWithinPartitions(*inside, "_z")
    placed.drop("_z").write.mode("overwrite").partitionBy(*inside).parquet(lake.path(layer, *parts))
    lake.unstage(*plan)


def expire_landing(lake: Lake, source: str, table: str, as_of: str, keep_days: int) -> list[str]:
    """MNT-03: drop landed dates older than the window, but only once they were promoted."""
    done = (
        read_ledger(lake)
        .where((F.col("source") == source) & (F.col("table_name") == table) & F.col("verdict").isin("promoted", "redelivered"))
        .where(F.col("dt").try_cast("date") < F.date_sub(F.lit(as_of).cast("date"), keep_days))
        .select("dt").distinct()
        # A date may have been dropped again since; that drop is not in Bronze yet.
        .join(pending_partitions(lake, source, table).select("dt"), "dt", "left_anti")
    )
    base = lake.path("landing", source, table)
    removed = []
    for row in done.orderBy("dt").toLocalIterator():
        if lake.files.exists(f"{base}/dt={row.dt}"):
            lake.files.delete(f"{base}/dt={row.dt}")
            removed.append(row.dt)
    return removed
