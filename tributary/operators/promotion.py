"""Landing to Bronze: was everything received, unchanged, once, and in the known shape.

A table is promoted as ``batch``, drop by drop, or as ``changes``: a change log whose events
are appended once, however often later drops repeat them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..lake import Lake
from ..sources import landing
from .scale import latest_per_key

BAD_ROW = "_bad_row"

LEDGER = (
    "source string, table_name string, dt string, verdict string, content_key string, load_id string, "
    "row_count bigint, run_id string"
)
PARTITION = ["source", "table_name", "dt"]
EVENT = ("pk_value", "op", "seq")


def read_ledger(lake: Lake) -> DataFrame:
    if not lake.exists("control", "promotions"):
        return lake.spark.createDataFrame([], LEDGER)
    return lake.spark.read.schema(LEDGER).parquet(lake.path("control", "promotions"))


def pending_partitions(lake: Lake, source: str, table: str) -> DataFrame:
    """SRC-09: landed partitions the ledger does not list as settled.

    A partition that failed stays pending and comes up again on every run. A new drop of
    a settled date has a new manifest time and is pending again.
    """
    listed = landing.list_partitions(lake, source, table)
    drops = landing.read_manifests(lake, source, table).select(*PARTITION, "written_at")
    settled = read_ledger(lake).where(F.col("verdict").isin("promoted", "redelivered")).select(*PARTITION, "load_id")
    return (
        listed.join(drops, PARTITION, "left")
        .withColumn("load_id", F.substring(F.md5(F.concat_ws("|", "source", "table_name", "dt", "written_at")), 1, 12))
        .join(settled, [*PARTITION, "load_id"], "left_anti")
    )


def checksum_report(lake: Lake, source: str, table: str, dates: Sequence[str] | None = None) -> DataFrame:
    """PRM-03: per partition, files whose bytes differ from the manifest, are missing, or are new."""
    expected = landing.read_checksums(lake, source, table).select(*PARTITION, "file", F.col("sha256").alias("expected"))
    if dates is not None:
        expected = expected.where(F.col("dt").isin(*dates))
    # A drop from outside may vouch for its only payload in its own manifest; its counts have to do otherwise.
    outside = landing.read_drop_manifests(lake, source, table).select(*PARTITION, "checksum")
    if dates is not None:
        outside = outside.where(F.col("dt").isin(*dates))
    actual = landing.payload_checksums(lake, source, table, dates)
    own = actual.join(outside, PARTITION, "left_anti").join(expected.join(outside, PARTITION, "left_anti"), [*PARTITION, "file"], "full")
    theirs = outside.where("checksum is not null").withColumnRenamed("checksum", "expected").join(actual, PARTITION, "left")
    return own.unionByName(theirs).groupBy(*PARTITION).agg(F.count_if(~F.equal_null("sha256", "expected")).alias("bad_files"))


def payload_report(
    lake: Lake, source: str, table: str, declared: StructType, fmt: str, dates: Sequence[str] | None = None, multiline: bool = False
) -> DataFrame:
    """Per landed date: rows found, the observed shape, rows that typing would damage, and a content key.

    The content key sums row hashes, so it depends neither on row order nor on how the
    rows are cut into files, and it combines on the map side. JSON gives all of it in one
    scan: shapes are merged by an aggregate, and a row is bad when it is no JSON or holds a
    value that its declared type cannot take. Parquet shapes are merged over the footers of
    all files of a date, and only dates of the declared shape are read.
    """
    base = lake.path("landing", source, table)
    if fmt == "json":
        lines = landing.documents(lake, source, table, dates, multiline)
        typed = F.from_json("value", StructType([*declared.fields]).add(BAD_ROW, "string"), {"columnNameOfCorruptRecord": BAD_ROW})
        # Documents that are all broken or null have no shape to judge; they are bad rows.
        shape = F.nullif(F.schema_of_variant_agg(F.try_parse_json("value")), F.lit("VOID"))
        return _report(lines, F.xxhash64("value"), shape, typed.isNull() | typed[BAD_ROW].isNotNull())
    landed = dates or [landing._dt_of(p) for p in lake.files.glob(f"{base}/dt=*")]
    shapes = [(d, merged_shape(lake, f"{base}/dt={d}")) for d in landed]
    fitting = [d for d, shape in shapes if shape == declared.simpleString()]
    shapes = lake.spark.createDataFrame(shapes, "dt string, shape string")
    if not fitting:
        return shapes.selectExpr("dt", "shape", "0L as rows_found", "0L as bad_rows", "cast(null as string) as content_key")
    lines = landing.scan_landing(lake, source, table, declared, fmt, fitting)
    row = F.xxhash64(*[x for f in declared for x in (F.col(f.name), F.col(f.name).isNull())])
    return shapes.join(_report(lines, row, F.lit(None), F.lit(False)).drop("shape"), "dt", "left")


def _report(lines: DataFrame, row: Column, shape: Column, bad: Column) -> DataFrame:
    report = lines.groupBy("dt").agg(
        F.count("*").alias("rows_found"),
        F.sum(row.cast("decimal(38,0)")).cast("string").alias("_digest"),
        shape.alias("shape"),
        F.count_if(bad).alias("bad_rows"),
    )
    return report.withColumn("content_key", F.concat_ws(":", "_digest", F.col("rows_found").cast("string"))).drop("_digest")


def merged_shape(lake: Lake, path: str) -> str | None:
    """The columns of all parquet files below a path, merged by a job over their footers; None without files.

    Files that cannot be merged or read have a shape that fits nothing, so their date waits and the others go on.
    """
    try:
        return lake.spark.read.option("mergeSchema", True).parquet(path).schema.simpleString()
    except (PySparkException, Py4JJavaError) as error:
        return None if "UNABLE_TO_INFER_SCHEMA" in str(error) else "unreadable"


def row_count_report(
    lake: Lake, source: str, table: str, declared: StructType, fmt: str, dates: Sequence[str] | None = None, multiline: bool = False
) -> DataFrame:
    """PRM-04: rows found against rows the manifest promised, per date with a manifest or a payload.

    ``reconciled`` is the manifest's word on paging: rows landed against the total the source reported.
    """
    promised = landing.read_manifests(lake, source, table).select("dt", F.col("row_count").alias("rows_promised"), "reconciled")
    if dates is not None:
        promised = promised.where(F.col("dt").isin(*dates))
    found = payload_report(lake, source, table, declared, fmt, dates, multiline)
    return promised.join(found, "dt", "full").withColumn("rows_found", F.coalesce("rows_found", F.lit(0)))


def matches_shape(shape: Column, declared: StructType, fmt: str) -> Column:
    """Whether an observed shape has exactly the declared top-level columns with their kinds.

    JSON tells numbers, text, booleans and nested values apart; an all-NULL column fits any kind.
    """
    if fmt != "json":
        return shape == declared.simpleString()
    fields = F.regexp_replace(F.regexp_replace(shape, "^OBJECT<", ""), ">$", "")
    for _ in range(8):
        fields = F.regexp_replace(fields, "(OBJECT|ARRAY)<[^<>]*>", "NESTED")
    fields = F.regexp_replace(fields, "BIGINT|DOUBLE|FLOAT|DECIMAL\\([0-9]+,[0-9]+\\)", "NUMBER")
    numbers = ("bigint", "int", "smallint", "tinyint", "double", "float")

    def kind(field: StructField) -> str:
        name = field.dataType.simpleString()
        if name in numbers or name.startswith("decimal"):
            return "NUMBER"
        return "BOOLEAN" if name == "boolean" else "NESTED" if "<" in name else "STRING"

    known = F.create_map(*[x for f in declared for x in (F.lit(f.name), F.lit(kind(f)))])

    def fits(field: Column) -> Column:
        seen = F.split_part(field, F.lit(": "), F.lit(-1))
        wanted = F.try_element_at(known, F.split_part(field, F.lit(": "), F.lit(1)))
        return F.coalesce((wanted == seen) | (wanted.isNotNull() & (seen == "VOID")), F.lit(False))

    parts = F.split(fields, ", ")
    return (F.size(parts) == len(declared)) & F.forall(parts, fits)


def judge(
    lake: Lake, source: str, table: str, declared: StructType, fmt: str, dates: Sequence[str], incomplete: Sequence[str] = (),
    multiline: bool = False,
) -> DataFrame:
    """PRM-01..05, 08..10: one row per pending partition with its verdict; the first failed check names it.

    All checks are columns of one frame, so a run over many partitions is one job.
    """
    parts = pending_partitions(lake, source, table).where(F.col("dt").isin(*dates))
    # Everything joined here has one row per partition.
    judged = parts.join(row_count_report(lake, source, table, declared, fmt, dates, multiline), "dt", "left")
    if fmt == "json":
        judged = judged.join(checksum_report(lake, source, table, dates), PARTITION, "left")
    else:
        judged = judged.withColumn("bad_files", F.lit(0))
    seen = (
        read_ledger(lake).where("verdict = 'promoted' and content_key is not null")
        .select("source", "table_name", "content_key").distinct().withColumn("_seen", F.lit(True))
    )
    judged = judged.join(seen, ["source", "table_name", "content_key"], "left")
    shape_ok = F.col("shape").isNull() | matches_shape(F.col("shape"), declared, fmt)
    waiting = F.col("dt").isin(*incomplete) if incomplete else F.lit(False)
    verdict = (
        F.when(~F.col("has_success"), "no success marker")
        .when(F.col("rows_promised").isNull(), "no manifest")
        .when(F.col("bad_files") > 0, "checksum mismatch")
        .when(~F.col("reconciled"), "paging not reconciled")
        # Rows of parquet files with another shape are not counted.
        .when(~shape_ok & F.lit(fmt != "json"), "schema drift")
        .when(F.col("rows_promised") != F.col("rows_found"), "row count mismatch")
        .when(~shape_ok, "schema drift")
        .when(F.col("bad_rows") > 0, "bad values")
        .when(waiting, "file set incomplete")
        .when(F.col("_seen"), "redelivered")
        .otherwise("promoted")
    )
    judged = judged.select(*PARTITION, verdict.alias("verdict"), "content_key", "load_id", F.col("rows_found").alias("row_count"))
    # Of drops with the same content in one run, the first is the delivery.
    same = Window.partitionBy("source", "table_name", "content_key").orderBy(F.col("verdict") != "promoted", "dt", "load_id")
    again = (F.col("verdict") == "promoted") & F.col("content_key").isNotNull() & (F.row_number().over(same) > 1)
    return judged.withColumn("verdict", F.when(again, "redelivered").otherwise(F.col("verdict")))


def promote(
    lake: Lake, source: str, table: str, declared: StructType, fmt: str, run_id: str, incomplete: Sequence[str] = (),
    mode: str = "batch", multiline: bool = False,
) -> DataFrame:
    """PRM-08: judge every pending partition, append the good ones to Bronze, record the verdicts.

    Bronze is partitioned by ``dt`` and ``load_id`` (one id per drop), and exactly those
    partitions are written, so replaying a run that died before the ledger entry rewrites
    the same files instead of doubling them. In mode ``changes`` only events that no other
    load holds are appended (PRM-06). Returns this run's verdicts.
    """
    if mode not in ("batch", "changes"):
        raise ValueError(f"unknown mode {mode!r}")
    dates = [r.dt for r in pending_partitions(lake, source, table).select("dt").distinct().toLocalIterator()]
    if not dates:
        return lake.spark.createDataFrame([], LEDGER)
    verdicts = judge(lake, source, table, declared, fmt, dates, incomplete, multiline).withColumn("run_id", F.lit(run_id))
    lake.write_snapshot(verdicts, "staging", "verdicts", source, table, run_id)
    verdicts = lake.spark.read.schema(LEDGER).parquet(lake.path("staging", "verdicts", source, table, run_id))
    good = verdicts.where("verdict = 'promoted'").select("dt", "load_id")
    good_dates = [r.dt for r in good.select("dt").toLocalIterator()]
    if good_dates:
        rows = landing.scan_landing(lake, source, table, declared, fmt, good_dates, multiline).join(good, "dt")
        if mode == "changes":
            rows = fresh_changes(lake, rows, good, source, table)
        lake.overwrite_partitions(rows, "bronze", source, table, partition_by=["dt", "load_id"])
    lake.append(verdicts, "control", "promotions")
    return verdicts


def fresh_changes(lake: Lake, events: DataFrame, loads: DataFrame, source: str, table: str) -> DataFrame:
    """The events of these loads that no other load in Bronze holds; of repeated events the first load's copy.

    What a dead run has left under the same load ids is about to be replaced, so it does not
    count. Bronze is read only within the new events' range of ``seq``.
    """
    if not lake.exists("bronze", source, table):
        return only_new_changes(events, None, order=("dt", "load_id"))
    ids = loads.select("load_id")
    span = events.agg(F.min("seq").alias("low"), F.max("seq").alias("high"))
    known = lake.read("bronze", source, table, text_partitions=True).join(ids, "load_id", "left_anti")
    known = known.where(F.col("seq").isNull() | F.col("seq").between(span.select("low").scalar(), span.select("high").scalar()))
    return only_new_changes(events, known, order=("dt", "load_id"))


def only_new_changes(
    events: DataFrame, bronze: DataFrame | None, keys: Sequence[str] = EVENT, order: Sequence[str] = ()
) -> DataFrame:
    """PRM-06: events not in Bronze yet, one copy each, within the batch as well as against Bronze.

    NULL counts as a value of a key. Of repeated events the first by ``order`` stays, then the one with the smallest row hash.
    """
    row = F.xxhash64(*[F.col(c) for c in events.columns], *[F.col(c).isNull() for c in events.columns])
    fresh = latest_per_key(events, list(keys), [*[F.col(c) for c in order], row])
    if bronze is None:
        return fresh
    known = bronze.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys])
    return fresh.join(known, same, "left_anti")


def complete_sets(arrivals: DataFrame, required: Sequence[str]) -> DataFrame:
    """PRM-10: per source and date, whether every required table has arrived."""
    present = F.count_distinct(F.when(F.col("table_name").isin(*required), F.col("table_name")))
    return arrivals.groupBy("source", "dt").agg(
        present.alias("tables_present"), (present == len(required)).alias("complete")
    )
