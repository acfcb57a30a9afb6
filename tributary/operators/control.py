"""SNK-07: append-only control state, latest value per key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..lake import Lake
from ..schemas import CONTROL_STATE


def latest_state(log: DataFrame, key: str = "key", value: str = "value", written_at: str = "written_at") -> DataFrame:
    """Latest value per key; equal times fall back to the larger value."""
    newest = F.max_by(F.struct(value, written_at), F.struct(written_at, value)).alias("_s")
    return log.groupBy(key).agg(newest).select(key, F.col(f"_s.{value}").alias(value), F.col(f"_s.{written_at}").alias(written_at))


def record_state(lake: Lake, topic: str, state: DataFrame) -> None:
    """Append ``(key, value, written_at)`` rows under one control topic."""
    lake.append(state.select(*[F.col(f.name).cast(f.dataType) for f in CONTROL_STATE]), "control", topic)


def read_state(lake: Lake, topic: str) -> DataFrame:
    if not lake.exists("control", topic):
        return lake.spark.createDataFrame([], CONTROL_STATE)
    return latest_state(lake.read("control", topic, schema=CONTROL_STATE))


def write_once(lake: Lake, df: DataFrame | Callable[[], DataFrame], layer: str, *parts: str) -> bool:
    """SRC-06 / MRT-14: write a table only if it is not there yet; True when written.

    The commit marker of a finished write is the guard, so a write that died half way is
    replaced on the next call. A callable is only called when there is something to write.
    """
    if lake.files.exists(lake.path(layer, *parts) + "/_SUCCESS"):
        return False
    lake.write_snapshot(df() if callable(df) else df, layer, *parts)
    return True
