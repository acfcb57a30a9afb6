"""Layered table paths and the few ways a table is written.

Layers are ``landing``, ``bronze``, ``silver``, ``gold`` and ``control``; a table is
a directory of parquet files under ``<root>/<layer>/...`` on any Hadoop file system.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

# Characters that Spark writes as %XX in the directory name of a partition value.
ESCAPED = set("\"#%'*/:=?\\{[]^\x7f") | {chr(i) for i in range(1, 32)}
LAYERS = ("landing", "bronze", "silver", "gold", "control", "staging")


def partition_folder(**values: str) -> str:
    """The directories in which Spark puts rows with these partition values."""
    return "/".join(f"{k}=" + "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in v) for k, v in values.items())


class Files:
    """Marker files and directory listings through the Hadoop file system."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _open(self, path: str):
        target = self._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self._conf), target

    def exists(self, path: str) -> bool:
        fs, target = self._open(path)
        return fs.exists(target)

    def touch(self, path: str) -> None:
        fs, target = self._open(path)
        fs.create(target, True).close()

    def write_text(self, path: str, text: str) -> None:
        fs, target = self._open(path)
        stream = fs.create(target, True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        fs, target = self._open(path)
        fs.delete(target, True)

    def glob(self, pattern: str) -> list[str]:
        fs, target = self._open(pattern)
        return sorted(s.getPath().toString() for s in fs.globStatus(target) or [])

    def small_texts(self, pattern: str) -> list[tuple[str, str, int]]:
        """Path, content and time in milliseconds of each matching file; for one small file per directory."""
        fs, target = self._open(pattern)
        found = []
        for status in fs.globStatus(target) or []:
            stream = fs.open(status.getPath())
            try:
                text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            found.append((status.getPath().toString(), text, status.getModificationTime()))
        return found

    def raw_path(self, path: str) -> str:
        """The path without its file system, encoded as in the metadata of scanned files."""
        return self._jvm.org.apache.hadoop.fs.Path(path).toUri().getRawPath()

    def data_files(self, path: str) -> list[tuple[str, int, int]]:
        """``(encoded path, bytes, time in milliseconds)`` of every file below a path that is not a marker."""
        fs, target = self._open(path)
        found: list[tuple[str, int, int]] = []
        if not fs.exists(target):
            return found
        entries = fs.listFiles(target, True)
        while entries.hasNext():
            status = entries.next()
            if not status.getPath().getName().startswith(("_", ".")):
                found.append((status.getPath().toUri().getRawPath(), status.getLen(), status.getModificationTime()))
        return found

    def move(self, source: str, target: str) -> None:
        """Renames a file; done already when only the target is there."""
        fs, old = self._open(source)
        new = self._jvm.org.apache.hadoop.fs.Path(target)
        if not fs.exists(old) and fs.exists(new):
            return
        fs.mkdirs(new.getParent())
        if not fs.rename(old, new):
            raise OSError(f"cannot move {source} to {target}")

    def partition_columns(self, path: str) -> list[str]:
        """The partition columns below a table's path, as the names of its directories tell."""
        fs, target = self._open(path)
        found: list[str] = []
        while fs.exists(target):
            inner = [s.getPath() for s in fs.listStatus(target) if s.isDirectory() and "=" in s.getPath().getName()]
            if not inner:
                break
            target = inner[0]
            found.append(unquote(target.getName().split("=", 1)[0]))
        return found

    def fingerprint(self, pattern: str) -> str:
        """Changes whenever a matching file is added, removed or rewritten."""
        fs, target = self._open(pattern)
        return "|".join(
            f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}"
            for s in fs.globStatus(target) or []
        )

    def has_data(self, path: str) -> bool:
        """True when the directory holds at least one file that is not a marker."""
        fs, target = self._open(path)
        if not fs.exists(target):
            return False
        entries = fs.listFiles(target, True)
        while entries.hasNext():
            if not entries.next().getPath().getName().startswith(("_", ".")):
                return True
        return False


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = Files(spark)

    def path(self, layer: str, *parts: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return "/".join([self.root, layer, *parts])

    def exists(self, layer: str, *parts: str) -> bool:
        return self.files.has_data(self.path(layer, *parts))

    def read(self, layer: str, *parts: str, schema: StructType | str | None = None, text_partitions: bool = False) -> DataFrame:
        """The rows of a table. Partition columns have the types they were written with, where the layout is known.

        Directory names alone do not tell: a load id of digits would come back as a number. With
        ``text_partitions`` they are text as it stands in the names, so that rows go back to where they came from.
        """
        path = self.path(layer, *parts)
        if schema:
            return self.spark.read.schema(schema).parquet(path)
        kinds = {c: StringType() for c in self.files.partition_columns(path)} if text_partitions else self.partition_types(layer, *parts)
        return self.read_as(kinds, path, path)

    def read_as(self, kinds: dict, base: str, *paths: str) -> DataFrame:
        """Parquet below ``paths`` with given types of partition columns."""
        reader = self.spark.read.option("basePath", base)
        found = reader.parquet(*paths)
        wanted = StructType([StructField(f.name, kinds.get(f.name, f.dataType)) for f in found.schema])
        return found if wanted == found.schema else reader.schema(wanted).parquet(*paths)

    def partition_types(self, layer: str, *parts: str) -> dict:
        known = self.layout(layer, *parts).get("partition_types", {})
        return {name: DataType.fromDDL(kind) for name, kind in known.items()}

    def layout(self, layer: str, *parts: str) -> dict:
        """What is written down about a table: types of partition columns, number of buckets."""
        found: dict = {}
        for _, text, _ in self.files.small_texts(self.path("control", "layouts", layer, *parts) + "/v*.json"):
            try:
                version = json.loads(text)
            except ValueError:  # a write that died; the version before holds
                continue
            if version["version"] > found.get("version", 0):
                found = version
        return found

    def note_layout(self, layer: str, *parts: str, **facts) -> None:
        known = self.layout(layer, *parts)
        if {**known, **facts} == known:
            return
        version = known.get("version", 0) + 1
        folder = self.path("control", "layouts", layer, *parts)
        self.files.write_text(f"{folder}/v{version}.json", json.dumps({**known, **facts, "version": version}))

    def _note_partitions(self, df: DataFrame, layer: str, parts: Sequence[str], partition_by: Sequence[str]) -> None:
        kinds = {c: df.schema[c].dataType.simpleString() for c in partition_by}
        if kinds or self.layout(layer, *parts):
            self.note_layout(layer, *parts, partition_types=kinds)

    def write_snapshot(self, df: DataFrame, layer: str, *parts: str, partition_by: Sequence[str] = ()) -> None:
        """Replace the whole table (type 1), also partitions that ``df`` does not have."""
        self._note_partitions(df, layer, parts, partition_by)
        writer = self._writer(df, partition_by).mode("overwrite").option("partitionOverwriteMode", "static")
        writer.parquet(self.path(layer, *parts))

    def append(self, df: DataFrame, layer: str, *parts: str, partition_by: Sequence[str] = ()) -> None:
        self._note_partitions(df, layer, parts, partition_by)
        self._writer(df, partition_by).mode("append").parquet(self.path(layer, *parts))

    def overwrite_partitions(self, df: DataFrame, layer: str, *parts: str, partition_by: Sequence[str]) -> None:
        """Replace exactly the partitions present in ``df``; a re-run gives the same table."""
        self._note_partitions(df, layer, parts, partition_by)
        (
            self._writer(df, partition_by)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .parquet(self.path(layer, *parts))
        )

    def replace_partition(self, df: DataFrame, layer: str, *parts: str, **values: str) -> None:
        """Replace one partition, given by its values; other names in ``parts`` after the table are inner partitions.

        ``df`` may have no rows: then the partition is gone afterwards, and a table without any is not made.
        """
        table, *inner = parts
        self.files.delete(f"{self.path(layer, table)}/{partition_folder(**values)}")
        self.overwrite_partitions(df, layer, table, partition_by=[*values, *inner])

    def is_staged(self, *parts: str) -> bool:
        return self.files.exists(self.path("staging", *parts) + "/_SUCCESS")

    def stage(self, build: Callable[[], DataFrame], *parts: str) -> DataFrame:
        """A written copy of rows that will replace the table they were computed from.

        No job may overwrite what it reads, and a run can die while it swaps the new rows
        in. The copy is dropped only after the swap, so one that is still there belongs to
        an unfinished swap: it is used as it is, and the damaged table is not read again.
        """
        if not self.is_staged(*parts):
            self.write_snapshot(build(), "staging", *parts)
        return self.read("staging", *parts)

    def unstage(self, *parts: str) -> None:
        self.files.delete(self.path("staging", *parts))

    @staticmethod
    def _writer(df: DataFrame, partition_by: Sequence[str]):
        # Rebalancing lets the adaptive planner merge small output tasks and split a
        # hot partition value over several, so neither tiny nor giant files come out.
        if partition_by:
            df = df.hint("rebalance", *[F.col(c) for c in partition_by])
            return df.write.partitionBy(*partition_by)
        return df.write
