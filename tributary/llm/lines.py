"""Line dedup: lines within two edits of each other are copies.

Lines are reduced to distinct ones first, so a line that is everywhere costs as much as any other. A distinct line of at
least ``MIN_CHARS`` characters is cut into three segments. If two lines are within two edits, at least one segment of
the shorter lies unchanged in the longer, close to where it was: for every length and segment, only the few starting
points are probed at which the edits before and after it can still add up to two. Index and probe rows meet in an
equi-join on a hash of (length, segment number, substring). A 64-bit parity sketch of the characters, of which an edit
changes two bits at most, drops other meetings; the rest is verified by a banded bit-parallel automaton. Linked lines form
classes; a class keeps its first line.

Classes need a spanning set of links, not all of them. Each line is first verified against one line of every key it
meets. Only keys that then still hold several classes are compared further, in cells of bounded size. A first pass over
sketches finds the lines with a partner in another class; a second one brings the texts of those and verifies inside the
cells, so that a cell gives fewer links than it has lines, whatever the number of pairs that look alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, by_arrow, discard, free_names, give_back, text_or_empty, written
from .components import components

EDITS = 2
MIN_CHARS = 30
SKETCH_MIX = np.uint64(0x9E3779B97F4A7C15)
PLACES = 1 << 20
CHUNK = 1024
WIDE = 4
CELL_CHARS = 4 * 1024 * 1024  # of either side of a cell
BLANKS = " \t\r\x0b\x0c"


def clean_line(line: Column) -> Column:
    """The line without blanks at either end. Trimming walks all characters of a line, so only lines that need it go there."""
    edge = F.lit(False)
    for blank in BLANKS:
        edge = edge | line.startswith(blank) | line.endswith(blank)
    return F.when(edge, F.btrim(line, F.lit(BLANKS))).otherwise(line)


def sketches(lines: list[str]) -> np.ndarray:
    """One number for each line, none of them empty: bit b is set when characters of kind b occur an odd number of times."""
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    kinds = (np.frombuffer("".join(lines).encode("utf-32-le"), "<u4").astype(np.uint64) * SKETCH_MIX) >> np.uint64(58)
    return np.bitwise_xor.reduceat(np.uint64(1) << kinds, np.cumsum(sizes) - sizes).view(np.int64)


def within(a: str, b: str, edits: int = EDITS) -> bool:
    """Whether two texts are at most ``edits`` insertions, deletions and replacements apart.

    A bit stands for a diagonal of the edit matrix, of which only the band around the main one can matter. One vector
    of diagonals for each number of errors advances by a character of ``a`` in a few bit operations.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > edits:
        return False
    low = 0
    while low < len(a) and a[low] == b[low]:
        low += 1
    high = 0
    while high < len(a) - low and a[len(a) - 1 - high] == b[len(b) - 1 - high]:
        high += 1
    a, b = a[low : len(a) - high], b[low : len(b) - high]
    width = 2 * edits + 1
    band = (1 << width) - 1
    # Bit d of level k: with k errors, a[:i] has become b[: i + d - edits].
    levels = [1 << edits]
    for _ in range(edits):
        levels.append(levels[-1] | levels[-1] << 1 & band)
    for i, c in enumerate(a):
        match = 0
        for d in range(width):
            at = i + d - edits
            if 0 <= at < len(b) and b[at] == c:
                match |= 1 << d
        before, levels = levels, []
        for k in range(edits + 1):
            now = before[k] & match
            if k:
                now |= before[k - 1] | before[k - 1] >> 1 | levels[k - 1] << 1 & band
            levels.append(now)
        if not levels[-1]:
            return False
    goal = len(b) - len(a) + edits
    return bool(levels[-1] >> goal & 1)


def segment(length: Column, number: Column, edits: int) -> tuple[Column, Column]:
    """Where a segment of a line of this length begins (0-based), and how long it is; the last ones are the longer."""
    parts = edits + 1
    short = F.floor(length / parts).cast("int")
    extra = F.greatest(number - (parts - length % parts), F.lit(0))
    return number * short + extra, short + F.when(number >= parts - length % parts, 1).otherwise(0)


def keyed(lines: DataFrame, places: list[tuple[int, int, int]], edits: int, own: bool = False) -> DataFrame:
    """``(key, id, sketch)`` for each ``(shorter by, segment, shift)`` that fits the line.

    If ``own``, also ``indexed``: whether the key is one under which the line itself is indexed.
    """
    entries = ", ".join(f"named_struct('d', {d}, 'i', {i}, 'o', {o})" for d, i, o in places)
    # Four bytes for each character, so that a segment is found without walking the line up to it.
    wide = lines.select("id", "sketch", F.encode("line", "UTF-32").alias("wide"))
    each = wide.select("id", "sketch", "wide", F.floor(F.octet_length("wide") / WIDE).cast("int").alias("n"), F.expr(f"inline(array({entries}))"))
    length = F.col("n") - F.col("d")
    begin, size = segment(length, F.col("i"), edits)
    at = begin + F.col("o")
    fits = (at >= 0) & (at + size <= F.col("n")) & (length >= MIN_CHARS)
    return each.where(fits).select(F.xxhash64(length, F.col("i"), F.substring(F.col("wide"), WIDE * at + 1, WIDE * size)).alias("key"), "id", "sketch", *([((F.col("d") == 0) & (F.col("o") == 0)).alias("indexed")] if own else []))


def meetings(lines: DataFrame, edits: int = EDITS) -> DataFrame:
    """``(key, id, sketch, indexed, lead, lead_sketch, several)``: lines that probe a key under which another line is indexed.

    ``lead`` is the first indexed line of a key, ``several`` says that there are more, ``indexed`` that this one is.
    """
    index = keyed(lines, [(0, i, 0) for i in range(edits + 1)], edits)
    leads = index.groupBy(F.col("key").alias("index_key")).agg(F.min(F.struct("id", "sketch")).alias("lead"), F.max("id").alias("last"))
    probes = [
        (d, i, o)
        for d in range(edits + 1)
        for i in range(edits + 1)
        for o in range(max(-i, d - (edits - i)), min(i, d + edits - i) + 1)
    ]
    probe = keyed(lines, probes, edits, own=True)
    several = F.col("last") != F.col("lead.id")
    met = probe.join(leads, (F.col("key") == F.col("index_key")) & ((F.col("id") != F.col("lead.id")) | several))
    return met.select("key", "id", "sketch", "indexed", F.col("lead.id").alias("lead"), F.col("lead.sketch").alias("lead_sketch"), several.alias("several"))


def pairs_with_leads(met: DataFrame, edits: int) -> DataFrame:
    """A line with the lead of each key that indexes no other, and with one lead of its other keys, which are cells later."""
    near = F.bit_count(F.col("sketch").bitwiseXOR(F.col("lead_sketch"))) <= 2 * edits
    close = met.where((F.col("id") != F.col("lead")) & near)
    found = close.where("not several").select("id", "lead").union(close.where("several").groupBy("id").agg(F.min("lead").alias("lead")))
    return found.select(F.greatest("id", "lead").alias("a"), F.least("id", "lead").alias("b")).distinct()


def several_classes(met: DataFrame, roots: DataFrame) -> DataFrame:
    """``(key, id, sketch, indexed, root)``: the lines of keys that hold several classes."""
    wide = met.where("several").select("key", "id", "sketch", "indexed").join(roots, F.col("id") == F.col("node"), "left")
    wide = wide.select("key", "id", "sketch", "indexed", F.coalesce("root", "id").alias("root"))
    spans = wide.groupBy(F.col("key").alias("k")).agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return wide.join(spans.where("low < high").select("k"), F.col("key") == F.col("k")).drop("k")


def cells(wide: DataFrame) -> DataFrame:
    """``wide`` dealt into cells of at most ``CHUNK`` indexed and ``CHUNK`` probing lines; of fewer if it has long texts."""
    length = F.max(F.length("line")) if "line" in wide.columns else F.max(F.lit(1))
    sizes = wide.groupBy(F.col("key").alias("k")).agg(F.count("*").alias("n"), F.count_if("indexed").alias("x"), length.alias("length"))
    met = wide.join(sizes.where("x > 0"), F.col("key") == F.col("k"))
    chunk = F.least(F.lit(CHUNK), F.greatest(F.lit(1), F.floor(F.lit(CELL_CHARS) / F.col("length"))))
    rows, columns = F.ceil(F.col("x") / chunk), F.ceil(F.col("n") / chunk)
    here = F.xxhash64("id")
    rest = [c for c in wide.columns if c not in ("key", "indexed")]
    index = met.where("indexed").select("key", F.pmod(here, rows).alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), columns - 1)).alias("j"), *rest, F.lit(True).alias("indexed"))
    probe = met.select("key", F.explode(F.sequence(F.lit(0).cast("long"), rows - 1)).alias("i"), F.pmod(here, columns).alias("j"), *rest, F.lit(False).alias("indexed"))
    return index.union(probe)


def near_of(rows: pa.Table, edits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Indexed lines of a cell, some at a time, its probing lines, and which of them are near in their sketches."""
    indexed, sketch = rows["indexed"].to_numpy(), rows["sketch"].to_numpy()
    x, y = np.flatnonzero(indexed), np.flatnonzero(~indexed)
    for at in range(0, len(x), 256):
        part = x[at : at + 256]
        yield part, y, np.bitwise_count(sketch[part][:, None] ^ sketch[y][None, :]) <= 2 * edits


def partners(rows: pa.Table, edits: int) -> list[np.ndarray]:
    """The lines of a cell that are near one of another class."""
    root, some = rows["root"].to_numpy(), np.zeros(rows.num_rows, bool)
    for part, y, near in near_of(rows, edits):
        near &= root[part][:, None] != root[y][None, :]
        some[part] |= near.any(axis=1)
        some[y] |= near.any(axis=0)
    return [np.unique(rows["id"].to_numpy()[some])]


def links_of_cell(rows: pa.Table, edits: int) -> list[np.ndarray]:
    """Verified links that join the classes of a cell as far as all of its links would: fewer than it has lines."""
    ids, root, text = rows["id"].to_numpy(), rows["root"].to_numpy().copy(), rows["line"].to_pylist()
    found: list[tuple[int, int]] = []
    for part, y, near in near_of(rows, edits):
        for here, k in zip(near, part.tolist()):
            for m in y[here & (root[y] != root[k])].tolist():
                if root[m] != root[k] and within(text[k], text[m], edits):
                    found.append((k, m))
                    root[root == root[m]] = root[k]
    a, b = ids[np.array([k for k, _ in found], np.int64)], ids[np.array([m for _, m in found], np.int64)]
    return [np.maximum(a, b), np.minimum(a, b)]


def over_cells(dealt: DataFrame, find: Callable[[pa.Table, int], list[np.ndarray]], names: list[str], edits: int) -> DataFrame:
    """What ``find`` gives for each cell. A cell arrives as a run of equal ``(key, i, j)``."""

    def out(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in find(pa.Table.from_batches(parts), edits)], names)

    def work(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        last = None
        for batch in stream:
            if not batch.num_rows:
                continue
            keys = np.stack([batch[c].to_numpy() for c in ("key", "i", "j")])
            begins = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0))).tolist()
            for low, high in zip(begins, [*begins[1:], batch.num_rows]):
                now = tuple(keys[:, low].tolist())
                if rest and last != now:
                    yield out(rest)
                    rest = []
                last = now
                rest.append(batch.slice(low, high - low))
        if rest:
            yield out(rest)
        give_back()

    bound_batches(dealt.sparkSession)
    ordered = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return ordered.mapInArrow(work, ", ".join(f"{n} long" for n in names)).distinct()


def linked_lines(lines: DataFrame, edits: int = EDITS) -> tuple[DataFrame, list[str]]:
    """``(node, root)`` of the lines that are linked with others, and the paths it lives in."""
    spark = lines.sparkSession
    paths: list[str] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        table, path = written(df, name)
        paths.append(path)
        return table

    met = keep(meetings(lines.where("sketch is not null"), edits), "meetings")
    links = keep(verified(keep(pairs_with_leads(met, edits), "pairs"), lines, edits), "links")
    roots = spark.createDataFrame([], "node long, root long")
    if not links.isEmpty():
        roots, path = components(links)
        paths.append(path)
    wide = keep(several_classes(met, roots), "wide")
    alive = keep(over_cells(cells(wide), partners, ["id"], edits), "alive")
    if alive.isEmpty():
        return roots, paths
    texts = keep(lines_of(alive, lines), "alive-lines")
    more = keep(over_cells(cells(wide.join(texts, "id")), links_of_cell, ["a", "b"], edits), "links")
    if not more.isEmpty():
        roots, path = components(links.union(more))
        paths.append(path)
    return roots, paths


def place_of(key: Column) -> Column:
    """One of ``PLACES`` places: a set of places is a filter of bounded size, whatever it was made from."""
    return F.pmod(F.xxhash64(F.lit(29), key), F.lit(PLACES)).cast("int")


def lines_of(ids: DataFrame, lines: DataFrame) -> DataFrame:
    """``(id, line)`` of distinct ids. Lines in no place of an id stay where they are."""
    # At most PLACES numbers, so they fit any broadcast.
    near = lines.select("id", "line", place_of(F.col("id")).alias("place")).join(F.broadcast(ids.select(place_of(F.col("id")).alias("place")).distinct()), "place", "left_semi")
    return near.join(ids, "id").select("id", "line")


def verified(pairs: DataFrame, lines: DataFrame, edits: int = EDITS) -> DataFrame:
    """The pairs whose lines are within ``edits``."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    some, _ = written(lines_of(ids, lines), "pair-lines")
    left = some.select(F.col("id").alias("a"), F.col("line").alias("line_a"))
    right = some.select(F.col("id").alias("b"), F.col("line").alias("line_b"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        good = [within(x, y, edits) for x, y in zip(batch["line_a"].to_pylist(), batch["line_b"].to_pylist())]
        return batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return by_arrow(pairs.join(left, "a").join(right, "b").select("a", "b", "line_a", "line_b"), "a long, b long", work)


def split_lines(docs: DataFrame, *keys: str) -> DataFrame:
    each = docs.select(*keys, F.posexplode(F.split(text_or_empty(), "\n", -1)).alias("no", "raw"))
    return each.select(*keys, "no", clean_line(F.col("raw")).alias("line"))


def digest(line: Column) -> Column:
    return F.when(line != "", F.unhex(F.md5(line)))


def located(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, no, digest, place)`` for each line of ``docs (row, doc_id, text)``; the digest is null for blank lines. Written."""
    each = split_lines(docs, "row", "doc_id")
    return written(each.select("row", "doc_id", "no", digest(F.col("line")).alias("digest"), place_of(F.col("line")).alias("place")), "located")[0]


def distinct_lines(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``(id, digest, line, sketch)`` for each distinct line; the sketch only for lines long enough to be compared.

    Lines that share their place with no line that repeats are distinct where they stand; only the others move.
    """
    repeated = found.where("digest is not null").groupBy("digest").agg(F.count("*").alias("n"), F.min("place").alias("place")).where("n > 1")
    taken = F.broadcast(repeated.select("place").distinct())
    each = split_lines(docs).where("line <> ''").select("line", place_of(F.col("line")).alias("place"))
    unique = each.join(taken, "place", "left_anti").select("line").union(each.join(taken, "place", "left_semi").select("line").distinct())

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        held = batch["line"].to_pylist()
        long = [i for i, x in enumerate(held) if len(x) >= MIN_CHARS]
        marks, none = np.zeros(len(held), np.int64), np.ones(len(held), bool)
        for at in range(0, len(long), CHUNK):
            now = long[at : at + CHUNK]
            marks[now], none[now] = sketches([held[i] for i in now]), False
        return batch.append_column("sketch", pa.array(marks, mask=none))

    sketched = by_arrow(unique, "line string, sketch long", work)
    return written(sketched.select(F.monotonically_increasing_id().alias("id"), digest(F.col("line")).alias("digest"), "line", "sketch"), "lines", "zstd")[0]


def line_classes(found: DataFrame, docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """``(row, doc_id, no, class, copy)`` for each line of ``docs``; ``found`` is what ``located`` returns for it.

    ``class`` is null for blank lines, and for the one line of an empty text. ``copy`` says that the class has an earlier
    line, in the order of doc_id (null last), row and number. Lines shorter than ``MIN_CHARS`` are copies only if equal.
    """
    lines = distinct_lines(docs, found)
    roots, paths = linked_lines(lines, edits)
    known = lines.select("digest", "id").join(roots, F.col("id") == F.col("node"), "left").select("digest", F.coalesce("root", "id").alias("class"))
    placed, _ = written(found.join(known, "digest", "left").drop("digest", "place"), "placed")
    discard(docs.sparkSession, *paths)
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("row").alias("r"), F.col("no").alias("l"))
    # Written, so that the join is free to split a hot class.
    first, _ = written(placed.where("class is not null").groupBy(F.col("class").alias("of")).agg(F.min(order).alias("first")), "first")
    joined = placed.join(first, F.col("class") == F.col("of"), "left")
    return joined.select("row", "doc_id", "no", "class", F.coalesce(order != F.col("first"), F.lit(False)).alias("copy"))


def line_report(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """``(doc_id, n_lines, n_copies, copies)``, a row for each row of ``docs``.

    ``n_lines`` counts lines that are not blank, ``n_copies`` those with an earlier copy in this or another document, and
    ``copies`` lists their 0-based numbers. Null and empty texts have no lines. Other columns are not read.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    placed = line_classes(located(rows), rows, edits)
    numbers = F.sort_array(F.collect_list(F.when(F.col("copy"), F.col("no"))))
    by_row = placed.groupBy("row", "doc_id").agg(F.count("class").alias("n_lines"), F.count_if("copy").alias("n_copies"), numbers.alias("numbers"))
    return by_row.select("doc_id", "n_lines", "n_copies", F.concat_ws(",", F.col("numbers").cast("array<string>")).alias("copies"))


def drop_copied_lines(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """``docs`` without the lines that have an earlier copy; blank lines and all other columns stay."""
    (row,) = free_names(docs, "line_row")
    whole, _ = written(docs.select("*", F.monotonically_increasing_id().alias(row)), "whole-rows")
    rows = whole.select(F.col(row).alias("row"), "doc_id", "text")
    placed = line_classes(located(rows), rows, edits)
    gone = placed.where("copy").groupBy(F.col("row").alias("of")).agg(F.collect_set("no").alias("gone"))
    of, numbers = free_names(whole, "line_of", "line_gone")
    joined = whole.join(gone.select(F.col("of").alias(of), F.col("gone").alias(numbers)), F.col(row) == F.col(of), "left")
    kept = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains(F.col(numbers), i))
    text = F.when(F.col(numbers).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
