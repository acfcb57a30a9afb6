"""Which files of a table hold given keys: a bitmap index beside the table, so that a few keys touch a few files.

For every file and indexed column the index holds bitmaps of the positions that the hashes of its keys take among
``POSITIONS``, cut into parts of 4 KB; a part without a key has no row. A lookup never misses a file, and may name one
that merely shares a position. Files are known by path, size and time: new or changed ones are indexed on the next
lookup, and entries of files that are gone are passed over.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..lake import Lake

POSITIONS = 1 << 22
PART = 32768  # positions of one bitmap, fixed by the functions that build it
INDEX = "file string, size bigint, modified bigint, key string, part bigint, bits binary"
FILES = "file string, size bigint, modified bigint"


def _position(key: Column) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(POSITIONS))


def current_files(lake: Lake, layer: str, *parts: str) -> list[tuple[str, int, int]]:
    """``(file, size, modified)`` of the table's data files; the path is encoded and relative to the table."""
    base, found = lake.files.raw_path(lake.path(layer, *parts)), []
    for raw, size, modified in lake.files.data_files(lake.path(layer, *parts)):
        found.append((raw.split(base, 1)[1].strip("/"), size, modified))
    return found


def refresh_index(lake: Lake, layer: str, *parts: str, keys: Sequence[str]) -> int:
    """Indexes the files that are new since the last call; how many there were. Only their key columns are read."""
    files = current_files(lake, layer, *parts)
    if not files:
        return 0
    now = lake.spark.createDataFrame(files, FILES)
    wanted = now.select("*", F.explode(F.array(*[F.lit(k) for k in keys])).alias("key"))
    known = read_index(lake, layer, *parts).select("file", "size", "modified", "key").distinct()
    fresh = wanted.join(known, ["file", "size", "modified", "key"], "left_anti")
    names = sorted({r.file for r in fresh.select("file").distinct().collect()})  # names of files, not of rows
    if not names:
        return 0
    base, raw = lake.path(layer, *parts), lake.files.raw_path(lake.path(layer, *parts))
    rows = lake.read_as({}, base, *[f"{base}/{unquote(n)}" for n in names])
    path = F.col("_metadata.file_path")
    here = F.ltrim(F.substr(path, F.instr(path, raw) + F.lit(len(raw))), F.lit("/"))
    each = rows.select(here.alias("file"), F.explode(F.array(*[F.struct(F.lit(k).alias("key"), _position(F.col(k)).alias("at"), F.col(k).isNull().alias("none")) for k in keys])).alias("e"))
    bits = each.where("not e.none").groupBy("file", F.col("e.key").alias("key"), F.expr(f"e.at div {PART}").alias("part")).agg(F.bitmap_construct_agg(F.col("e.at") % PART).alias("bits"))
    entries = bits.join(now, "file").select("file", "size", "modified", "key", "part", "bits")
    # A file whose keys are all null is known as well.
    marks = wanted.where(F.col("file").isin(*names)) if len(names) <= 100 else wanted.join(fresh.select("file").distinct(), "file", "left_semi")
    seen = marks.select("file", "size", "modified", "key", F.lit(-1).cast("bigint").alias("part"), F.lit(None).cast("binary").alias("bits"))
    lake.append(entries.unionByName(seen), "control", "file_index", layer, *parts)
    return len(names)


def read_index(lake: Lake, layer: str, *parts: str) -> DataFrame:
    if not lake.exists("control", "file_index", layer, *parts):
        return lake.spark.createDataFrame([], INDEX)
    return lake.read("control", "file_index", layer, *parts, schema=INDEX)


def prune_index(lake: Lake, layer: str, *parts: str) -> None:
    """Drops the entries of files that are gone, and repeated ones."""
    plan = ("file_index", layer, *parts)
    now = lake.spark.createDataFrame(current_files(lake, layer, *parts), FILES)
    kept = lake.stage(lambda: read_index(lake, layer, *parts).join(now, ["file", "size", "modified"], "left_semi").dropDuplicates(["file", "key", "part"]), *plan)
    lake.write_snapshot(kept, "control", *plan)
    lake.unstage(*plan)


def files_with(lake: Lake, layer: str, *parts: str, key: str, values: DataFrame) -> list[str]:
    """The files in which ``key`` may have one of the values of the one column of ``values``."""
    refresh_index(lake, layer, *parts, keys=[key])
    files = current_files(lake, layer, *parts)
    if not files:
        return []
    at = values.select(_position(F.col(values.columns[0])).alias("at")).where(F.col(values.columns[0]).isNotNull())
    # At most POSITIONS / PART rows with at most PART bits each, however many keys there are.
    wanted = at.groupBy(F.expr(f"at div {PART}").alias("part")).agg(F.collect_set((F.col("at") % PART).cast("int")).alias("asked"))
    hit = F.expr("exists(asked, b -> (cast(conv(hex(substring(bits, b div 8 + 1, 1)), 16, 10) as int) >> cast(b % 8 as int)) & 1 = 1)")
    now = lake.spark.createDataFrame(files, FILES)
    index = read_index(lake, layer, *parts).where((F.col("key") == key) & (F.col("part") >= 0))
    found = index.join(F.broadcast(wanted), "part").where(hit).join(now, ["file", "size", "modified"], "left_semi")
    return sorted(r.file for r in found.select("file").distinct().collect())  # names of files, not of rows


def rewrite_files(
    lake: Lake, layer: str, *parts: str, files: Sequence[str], keep: Callable[[DataFrame], DataFrame], plan: Sequence[str]
) -> None:
    """Replaces some files of a table by what ``keep`` leaves of their rows; no other file is touched.

    The new files are staged with the list of old ones, moved in under names of their own, then the old ones are removed.
    Each step may be repeated, so calling again under the same plan finishes a rewrite that died, whatever ``files`` are now.
    """
    base, note = lake.path(layer, *parts), lake.path("staging", *plan) + ".files/old.json"
    if not lake.is_staged(*plan):
        if not files:
            return
        columns = lake.files.partition_columns(base)
        rows = lake.read_as({c: StringType() for c in columns}, base, *[f"{base}/{unquote(f)}" for f in files])
        lake.files.write_text(note, json.dumps(list(files)))
        lake.write_snapshot(keep(rows), "staging", *plan, partition_by=columns)
    staged = lake.path("staging", *plan)
    for name, _, _ in current_files(lake, "staging", *plan):
        inner = unquote(name)
        lake.files.move(f"{staged}/{inner}", f"{base}/{inner}")
    for text in lake.files.small_texts(note):
        for name in json.loads(text[1]):
            lake.files.delete(f"{base}/{unquote(name)}")
    lake.unstage(*plan)
    lake.files.delete(lake.path("staging", *plan) + ".files")
