"""Incremental pulls: bounded interval, high-water mark, full, change log, JDBC."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..lake import Lake
from ..operators.control import write_once

OVERLAP = dt.timedelta(minutes=5)
JDBC_FETCH_SIZE = 10_000


def in_utc(moment: dt.datetime | str) -> dt.datetime:
    """A moment without offset counts as UTC already."""
    parsed = dt.datetime.fromisoformat(moment) if isinstance(moment, str) else moment
    return parsed.astimezone(dt.UTC) if parsed.tzinfo else parsed.replace(tzinfo=dt.UTC)


class Schedule(NamedTuple):
    """What a scheduler says about a run, in UTC; either end may be missing."""

    begins: dt.datetime | None
    ends: dt.datetime | None

    @classmethod
    def of(cls, settings: Mapping[str, str]) -> Schedule:
        return cls(*(in_utc(v) if (v := settings.get(f"DATA_INTERVAL_{end}")) else None for end in ("START", "END")))

    def window(self, overlap: dt.timedelta) -> tuple[dt.datetime, dt.datetime] | None:
        return (self.begins - overlap, self.ends) if self.begins and self.ends else None

    def partition(self, otherwise: dt.date) -> str:
        return f"{self.begins or otherwise:%Y-%m-%d}"


def run_interval(settings: Mapping[str, str], overlap: dt.timedelta = OVERLAP) -> tuple[dt.datetime, dt.datetime] | None:
    """The scheduled interval in UTC, widened at its start, or None unless both ends are set."""
    return Schedule.of(settings).window(overlap)


def logical_date(settings: Mapping[str, str], today: dt.date) -> str:
    """The ``dt=`` value of a run: the UTC day its interval begins, else the given day."""
    return Schedule.of(settings).partition(today)


def _at(moment: dt.datetime | str) -> Column:
    return F.lit(in_utc(moment).replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def pull_interval(df: DataFrame, column: str, start: dt.datetime | str, end: dt.datetime | str) -> DataFrame:
    """SRC-01: rows changed in the interval, widened by the overlap at its start. No state is read or written."""
    return df.where((F.col(column) > _at(start) - F.lit(OVERLAP)) & (F.col(column) < _at(end)))


def pull_since(df: DataFrame, column: str, watermark: Column | dt.datetime | str | None) -> DataFrame:
    """SRC-02: rows changed after the mark minus the overlap; no mark means everything.

    The mark may be a scalar subquery over the control table.
    """
    if watermark is None:
        return df
    if not isinstance(watermark, Column):
        return df.where(F.col(column) > _at(watermark) - F.lit(OVERLAP))
    # A NULL mark is a first run, as with no mark at all.
    return df.where(F.coalesce(F.col(column) > watermark - F.lit(OVERLAP), watermark.isNull()))


def pull_full(df: DataFrame) -> DataFrame:
    """SRC-03: everything, whatever the mark says; the mark still advances afterwards."""
    return df


def high_water_mark(pulled: DataFrame, column: str) -> DataFrame:
    """The mark after a pull: newest change among the rows read, not the clock."""
    return pulled.agg(F.count("*").alias("rows_pulled"), F.max(column).alias("new_watermark"))


def pull_object(
    df: DataFrame,
    fields: Sequence[str],
    column: str,
    since: dt.datetime | str | None = None,
    until: dt.datetime | str | None = None,
    extra: Column | None = None,
) -> DataFrame:
    """SRC-04: chosen fields, optional extra condition, half-open change window."""
    if extra is not None:
        df = df.where(extra)
    if since is not None:
        df = df.where(F.col(column) > _at(since))
    if until is not None:
        df = df.where(F.col(column) < _at(until))
    return df.select(*fields)


def poll_changes(log: DataFrame, offset: Column | int, seq: str = "seq") -> DataFrame:
    """SRC-05: change-log events past the offset. Order is carried by ``seq``, not by row order."""
    after = offset if isinstance(offset, Column) else F.lit(offset)
    return log.where(F.col(seq) > F.coalesce(after, F.lit(-1)))


def next_offset(polled: DataFrame, seq: str = "seq") -> DataFrame:
    return polled.agg(F.count("*").alias("event_count"), F.min(seq).alias("min_seq"), F.max(seq).alias("max_seq"))


def initial_snapshot(lake: Lake, df: DataFrame, source: str, table: str) -> bool:
    """SRC-06: the one-time baseline of a change-log source; a second call changes nothing."""
    return write_once(lake, df, "bronze", source, table)


def jdbc_options(
    url: str, table: str, predicate: str, column: str, lower: int, upper: int, partitions: int, fetchsize: int = JDBC_FETCH_SIZE
) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": f"(SELECT * FROM {table} WHERE {predicate}) AS pulled",
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetchsize),
    }


def read_jdbc(spark: SparkSession, driver_options: Mapping[str, str] | None = None, **pull) -> DataFrame:
    """SRC-07: parallel range-partitioned read; each task holds one fetch page at a time."""
    return spark.read.format("jdbc").options(**jdbc_options(**pull), **(driver_options or {})).load()
