"""GLD-06 / SNK-04: a ledger of the Bronze loads a consumer has taken, and facts that follow new loads by period."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..lake import Lake

LEDGER = "consumer string, source string, table_name string, dt string, load_id string, run_id string"
Load = tuple[str, str]


def all_loads(lake: Lake, source: str, table: str) -> list[Load]:
    """``(dt, load_id)`` of every load in Bronze, from a directory listing."""
    found = []
    for path in lake.files.glob(lake.path("bronze", source, table) + "/dt=*/load_id=*"):
        dt, load_id = (unquote(x.split("=", 1)[1]) for x in path.rstrip("/").rsplit("/", 2)[1:])
        found.append((dt, load_id))
    return found


def new_loads(lake: Lake, consumer: str, source: str, table: str) -> list[Load]:
    """The loads this consumer has not taken."""
    loads = all_loads(lake, source, table)
    if not loads or not lake.exists("control", "loads_taken"):
        return loads
    log = lake.read("control", "loads_taken", schema=LEDGER)
    mine = log.where((F.col("consumer") == consumer) & (F.col("source") == source) & (F.col("table_name") == table))
    listed = lake.spark.createDataFrame(loads, "dt string, load_id string")
    return sorted((r.dt, r.load_id) for r in listed.join(mine, ["dt", "load_id"], "left_anti").collect())


def take(lake: Lake, consumer: str, source: str, table: str, loads: Sequence[Load], run_id: str) -> None:
    """Notes loads as taken; the last thing a run does with them."""
    if loads:
        rows = [(consumer, source, table, dt, load_id, run_id) for dt, load_id in loads]
        lake.append(lake.spark.createDataFrame(rows, LEDGER).coalesce(1), "control", "loads_taken")


def rows_of(lake: Lake, source: str, table: str, loads: Sequence[Load]) -> DataFrame:
    """The rows of some loads, with ``dt`` and ``load_id`` as text. No other load is opened."""
    base = lake.path("bronze", source, table)
    kinds = {"dt": StringType(), "load_id": StringType()}
    return lake.read_as(kinds, base, *[f"{base}/dt={dt}/load_id={load_id}" for dt, load_id in loads])


def _alike(columns: Sequence[str], other: str) -> Column:
    return reduce(and_, [F.col(c).eqNullSafe(F.col(f"{other}{c}")) for c in columns])


def follow(
    lake: Lake, table: str, key: Sequence[str], changed: DataFrame, fresh: DataFrame, period: Sequence[str], run_id: str
) -> int:
    """Replaces a fact's rows of the ``changed`` keys by ``fresh``, in the periods where either stands; how many periods.

    Other periods are neither read in full nor written. A period whose last rows leave is removed. The new periods are
    staged first: calling again with the same run id finishes a swap that died half way.
    """
    plan, rows = ("follow", table, run_id), ("follow", table, run_id, "rows")
    fact = lake.path("gold", table)
    keys = changed.select(*[F.col(k).alias(f"_c_{k}") for k in key]).distinct()

    def touched() -> DataFrame:
        old = lake.read("gold", table).select(*key, *period).join(keys, _alike(key, "_c_"), "left_semi").select(*period)
        return old.union(fresh.select(*period)).distinct()

    if not lake.is_staged(*rows):
        periods = lake.stage(touched, *plan, "periods")  # one row for each period
        marks = F.broadcast(periods.select(*[F.col(p).alias(f"_p_{p}") for p in period]))
        standing = lake.read("gold", table).join(marks, _alike(period, "_p_"), "left_semi")
        kept = standing.join(keys, _alike(key, "_c_"), "left_anti")
        lake.write_snapshot(kept.unionByName(fresh.select(*standing.columns)), "staging", *rows)
    staged, periods = lake.read("staging", *rows), lake.read("staging", *plan, "periods")
    lake.overwrite_partitions(staged, "gold", table, partition_by=period)
    filled = {tuple(r) for r in staged.select(*period).distinct().collect()}
    all_periods = [tuple(r) for r in periods.select(*period).collect()]
    for values in set(all_periods) - filled:
        names = "/".join(f"{p}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for p, v in zip(period, values))
        lake.files.delete(f"{fact}/{names}")
    lake.unstage(*plan)
    return len(all_periods)
