"""The landing zone: dated drops with a manifest and a marker written last."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..lake import Lake

MANIFEST = "source string, table_name string, dt string, row_count bigint, min_seq bigint, max_seq bigint, written_at timestamp_ntz"
CHECKSUM = "source string, table_name string, dt string, file string, sha256 string, written_at timestamp_ntz"
#: What a drop from outside says about itself; the counts and the flag may be missing.
OWN_WORDS = (
    "row_count bigint, rows_landed bigint, api_reported_total bigint, reconciled boolean, checksum string, min_seq bigint, max_seq bigint"
)
PARTITIONS = "source string, table_name string, dt string, has_success boolean"
MAX_ROWS_PER_FILE = 2_000_000  # a payload file is hashed as a whole by one task
NO_MARKER = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}


def _dt_of(path: str) -> str:
    return path.rsplit("dt=", 1)[1].split("/", 1)[0]


def land(
    lake: Lake, df: DataFrame, source: str, table: str, written_at: str, fmt: str = "parquet", seq: str | None = None,
    dates: Sequence[str] | None = None,
) -> list[str]:
    """SNK-01: write ``dt=`` partitions, then their manifests, then the markers.

    Partitions present in ``df`` are replaced, so a re-run of a date replaces that date.
    A crash before the last step leaves partitions without a marker, which promotion
    refuses. Gives the dates landed; an empty frame lands nothing. A scheduled run knows
    its ``dates``; without them the frame is read once more to find them.
    """
    base = lake.path("landing", source, table)
    if dates is None:
        dates = sorted(r.dt for r in df.select(F.col("dt").cast("string").alias("dt")).distinct().toLocalIterator())
    if not dates:
        return []
    for date in dates:
        lake.files.delete(f"{base}/dt={date}/_SUCCESS")
    (
        df.hint("rebalance", F.col("dt"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**NO_MARKER, **({"ignoreNullFields": "false"} if fmt == "json" else {}))
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .partitionBy("dt")
        .format(fmt)
        .save(base)
    )
    stamp = F.lit(written_at).cast("timestamp_ntz")
    low, high = (F.min(seq), F.max(seq)) if seq else (F.lit(None), F.lit(None))
    landed = scan_landing(lake, source, table, df.drop("dt").schema, fmt, dates)
    manifest = landed.groupBy("dt").agg(
        F.count("*").alias("row_count"), low.cast("bigint").alias("min_seq"), high.cast("bigint").alias("max_seq")
    )
    lake.append(
        manifest.select(F.lit(source).alias("source"), F.lit(table).alias("table_name"), "dt", "row_count", "min_seq", "max_seq", stamp.alias("written_at")),
        "control", "manifests",
    )
    if fmt == "json":
        lake.append(payload_checksums(lake, source, table, dates).withColumn("written_at", stamp), "control", "checksums")
    for date in dates:
        lake.files.touch(f"{base}/dt={date}/_SUCCESS")
    return dates


def scan_landing(
    lake: Lake, source: str, table: str, declared: StructType, fmt: str = "parquet", dates: Sequence[str] | None = None, multiline: bool = False
) -> DataFrame:
    """SRC-08: landed rows with their ``dt``; JSON or parquet, always with a declared schema.

    A payload without rows or columns simply contributes nothing.
    """
    base = lake.path("landing", source, table)
    full = StructType([*declared.fields]).add("dt", "string")
    reader = lake.spark.read.schema(full).option("basePath", base)
    if fmt == "json":
        reader = reader.option("multiLine", multiline)
    paths = [base] if dates is None else [f"{base}/dt={d}" for d in dates]
    return reader.format(fmt).load(paths)


def documents(lake: Lake, source: str, table: str, dates: Sequence[str] | None = None, multiline: bool = False) -> DataFrame:
    """``(dt, value)``: one JSON document per row, from lines or from verbatim payloads.

    A verbatim payload is one document or an array of them over any number of lines; it is one
    response of an interface and therefore small. An empty array has no documents, and what is no JSON stays one
    broken document.
    """
    base = lake.path("landing", source, table)
    paths = [base] if dates is None else [f"{base}/dt={d}" for d in dates]
    texts = lake.spark.read.option("basePath", base).text(paths, wholetext=multiline).withColumn("dt", F.col("dt").cast("string"))
    if not multiline:
        return texts
    whole = F.array("value")
    many = F.when(F.ltrim("value").startswith("["), F.from_json("value", "array<string>"))
    return texts.where(F.ltrim("value") != "").select("dt", F.explode(F.coalesce(many, whole)).alias("value"))


def payload_checksums(lake: Lake, source: str, table: str, dates: Sequence[str] | None = None) -> DataFrame:
    """PRM-03: sha256 of every landed payload file, computed where the file is read."""
    base = lake.path("landing", source, table)
    paths = [base] if dates is None else [f"{base}/dt={d}" for d in dates]
    files = lake.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return files.select(
        F.lit(source).alias("source"),
        F.lit(table).alias("table_name"),
        F.regexp_extract("path", "dt=([^/]+)/", 1).alias("dt"),
        F.regexp_extract("path", "([^/]+)$", 1).alias("file"),
        F.sha2("content", 256).alias("sha256"),
    )


def list_partitions(lake: Lake, source: str, table: str) -> DataFrame:
    """PRM-01: landed partitions and whether each has its marker, from one directory listing."""
    base = lake.path("landing", source, table)
    marked = {_dt_of(p) for p in lake.files.glob(f"{base}/dt=*/_SUCCESS")}
    rows = [(source, table, _dt_of(p), _dt_of(p) in marked) for p in lake.files.glob(f"{base}/dt=*")]
    return lake.spark.createDataFrame(rows, PARTITIONS)


def newest(log: DataFrame, keys: Sequence[str], written_at: str = "written_at") -> DataFrame:
    """Rows of the newest write per key; every file of one drop shares its write time."""
    last = log.groupBy(*keys).agg(F.max(written_at).alias("_last"))
    return log.join(last, list(keys)).where(F.col(written_at) == F.col("_last")).drop("_last")


def read_drop_manifests(lake: Lake, source: str, table: str) -> DataFrame:
    """PRM-02: the ``_manifest.json`` that a drop from outside brings along, one row per date that has one.

    ``reconciled`` is what the manifest says, else whether the rows landed are those the
    source reported. A manifest that is no JSON object promises nothing: all its values are NULL.
    """
    found = lake.files.small_texts(lake.path("landing", source, table) + "/dt=*/_manifest.json")
    texts = lake.spark.createDataFrame([(_dt_of(p), text, at) for p, text, at in found], "dt string, text string, at bigint")
    said = texts.select("dt", F.from_json("text", OWN_WORDS).alias("m"), F.timestamp_millis("at").cast("timestamp_ntz").alias("written_at"))
    agrees = F.col("m.rows_landed") == F.col("m.api_reported_total")
    return said.select(
        F.lit(source).alias("source"), F.lit(table).alias("table_name"), "dt",
        F.coalesce("m.row_count", "m.rows_landed").alias("row_count"), "m.min_seq", "m.max_seq", "written_at",
        F.coalesce(F.col("m.reconciled"), agrees, F.lit(True)).alias("reconciled"), "m.checksum",
    )


def read_manifests(lake: Lake, source: str, table: str) -> DataFrame:
    """The newest manifest of every date, with ``reconciled`` and, for drops from outside, ``checksum``.

    Landing a date removes what lay there, so a manifest inside a partition describes what lies there now.
    """
    outside = read_drop_manifests(lake, source, table)
    if not lake.exists("control", "manifests"):
        return outside
    log = lake.spark.read.schema(MANIFEST).parquet(lake.path("control", "manifests"))
    mine = log.where((F.col("source") == source) & (F.col("table_name") == table))
    own = newest(mine, ["source", "table_name", "dt"]).join(outside.select("dt"), "dt", "left_anti")
    return own.withColumns({"reconciled": F.lit(True), "checksum": F.lit(None).cast("string")}).unionByName(outside)


def read_checksums(lake: Lake, source: str, table: str) -> DataFrame:
    if not lake.exists("control", "checksums"):
        return lake.spark.createDataFrame([], CHECKSUM)
    log = lake.spark.read.schema(CHECKSUM).parquet(lake.path("control", "checksums"))
    mine = log.where((F.col("source") == source) & (F.col("table_name") == table))
    return newest(mine, ["source", "table_name", "dt"])

