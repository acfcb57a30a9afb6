"""Seed and legacy text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..lake import Files
from ..schemas import require_columns


def read_seed_csv(spark: SparkSession, path: str, declared: StructType) -> DataFrame:
    """SRC-11: header CSV with a declared schema; an empty field is NULL."""
    return spark.read.schema(declared).option("header", True).option("nullValue", "").option("enforceSchema", False).csv(path)


def prefer_full(spark: SparkSession, full: str, fallback: str) -> str:
    """SRC-12: the full-scale artifact when it exists, else the small one."""
    return full if Files(spark).exists(full) else fallback


def read_delimited(spark: SparkSession, path: str, required: Sequence[str], declared: StructType, sep: str = ";") -> DataFrame:
    """SRC-13: legacy delimited text with a header.

    ``declared`` lists every column of the file in order; a header that differs fails.
    """
    df = (
        spark.read.schema(declared)
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("enforceSchema", False)
        .csv(path)
    )
    return require_columns(df, required)
