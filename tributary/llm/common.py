"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..lake import Files
from ..session import shared_dir

ARROW_BATCH_BYTES = 4 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the driver and all executors share."""
    return f"{shared_dir(spark)}/corpus/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, compression: str = "snappy") -> tuple[DataFrame, str]:
    """The rows as a table in the shared folder, and its path.

    Cuts lineage: later jobs read files that survive the loss of executors.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    files = Files(spark)
    for path in paths:
        files.delete(path)


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches are cut by bytes too, so that long texts do not pile up in Python workers.

    The setting belongs to the session, as batches are cut when a plan runs; a smaller one is left alone.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name).rstrip("b")
    if not now.isdigit() or not 0 < int(now) <= ARROW_BATCH_BYTES:
        spark.conf.set(name, str(ARROW_BATCH_BYTES))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def row_hash(docs: DataFrame) -> Column:
    """A hash of the whole row in which a null differs from every value."""
    return F.xxhash64(*[x for c in docs.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())])


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names for working columns that no column of ``df`` has, whatever it is called."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        found.append(name)
    return found


def give_back() -> None:
    """Returns what a Python worker no longer uses: it lives on after its task and would hold it through later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def by_arrow(df: DataFrame, schema: StructType | str, work: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    """Each Arrow batch of ``df`` through ``work``, without a shuffle."""

    bound_batches(df.sparkSession)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            if batch.num_rows:
                yield work(batch)
        give_back()

    return df.mapInArrow(batches, schema)


def input_bytes(df: DataFrame) -> int:
    """The bytes of the tables that ``df`` is made from, as Spark knows them before it reads any; 0 if it does not.

    Estimates of whole plans multiply the sides of joins, so only the leaves are added up.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    total = sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    return total if total < 1 << 60 else 0


def text_bytes(column: pa.Array) -> tuple[memoryview, list[int]]:
    """The UTF-8 bytes of a string column and the offset of each row in them; a null row is empty."""
    column = column.fill_null("")
    wide = column.type == pa.large_string()
    offsets = memoryview(column.buffers()[1]).cast("q" if wide else "i")[column.offset : column.offset + len(column) + 1].tolist()
    return memoryview(column.buffers()[2] or b""), offsets
