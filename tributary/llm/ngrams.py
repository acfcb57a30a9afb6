"""N-gram Jaccard join: documents whose sets of word shingles reach a similarity, and the components they form.

Grouped prefix join. All shingles get one global order, rare ones first. Two sets that reach the similarity share a shingle
among the first few of each, their prefixes. Documents with equal sets are one class; classes of equal prefix and size are
one group. Groups meet in lists, one for each shingle of their prefixes. Pairs of groups are filtered by size, by the
places of the common shingle and by a sketch, and only then are members met and verified on all their shingles.

A component needs a spanning set of its links, so a large group of copies is not met all against all:

1. Groups without any partner that passes the filters leave the lists, before a text is fetched.
2. The others are verified against a few leaders of their lists, and every member against the first of its group.
3. Lists that still hold several components yield pairs that may link them, a spanning set at first.
4. What verification has left apart is compared again, and now every pair that may link is verified.

Lists are compared in cells of bounded size: a long list is cut into chunks, and each pair of chunks is one cell.

A sketch holds, for each of its bits, whether an odd number of shingles fall on it. Two sketches differ in at most as many
bits as the sets have shingles apart, so the filter loses nothing.

The order takes the frequency of a shingle from a table of ``2**ORDER_BITS`` counters over all documents. Shingles that
share a counter count as one; this changes how many candidates there are, never the links. A shingle whose counter is no
fuller than chance would fill it is cold: few documents can share it.

Nulls, empty texts and those of blanks only have an empty set and are linked with nothing. Rows that repeat stay separate
rows of one component; a null doc_id is never a component's smallest unless there is no other. Empty tables give no rows.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, by_arrow, discard, give_back, row_hash, text_bytes, written
from .components import components
from .simhash import LOWER

ORDER_BITS, ORDER_CHUNKS = 22, 64
MEMO_WORDS = 1 << 17  # some 20 MB in a worker
LEADERS = 4  # for each list and band of sizes, by the shingle
ROUNDS = 2
CHUNK = 1024
SHORT = 32  # entries of lists that are compared many at a time
LEAST_BITS, MOST_BITS = 256, 1 << 16
SKETCH_BYTES = 1 << 22  # of sketches that are compared at once
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


class Rule(NamedTuple):
    """Sets of shingles of ``size`` words are linked when ``of * |intersection| >= link * |union|``."""

    size: int
    link: int
    of: int

    def needed(self, n: np.ndarray | int):
        """The smallest intersection of two linked sets that have ``n`` elements together, repeats counted."""
        return -(-self.link * n // (self.link + self.of))

    def prefix_length(self, n: int) -> int:
        return n + (-self.link * n // self.of) + 1

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether two sets, as ascending hashes, reach the similarity."""
        if self.link * max(len(a), len(b)) > self.of * min(len(a), len(b)):
            return False
        both = len(np.intersect1d(a, b, assume_unique=True))
        return self.of * both >= self.link * (len(a) + len(b) - both)

    def sketch_bits(self, n: int) -> int:
        """Eight bits, or a few more, for each shingle that two linked sets of this size can have apart."""
        apart = 2 * n - 2 * self.needed(2 * n)
        return min(MOST_BITS, max(LEAST_BITS, 1 << (8 * apart - 1).bit_length()))

    def sketch(self, hashes: np.ndarray) -> bytes:
        bits = self.sketch_bits(len(hashes))
        odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
        return np.packbits(odd.astype(np.uint8)).tobytes()


CONTRACT = Rule(3, 90, 100)


class Hashes(dict):
    """Hash of each word met so far."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX[1]
    return x ^ (x >> np.uint64(29))


def shingles(text: bytes, known: Hashes, size: int) -> np.ndarray:
    """Distinct hashes of the word shingles, ascending; a shorter text is one shingle, one without words has none."""
    words = text.translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(size, len(ids))
    n = len(ids) - size + 1
    found = np.full(n, size, np.uint64) * MIX[0]
    for i in range(size):
        found = mixed(found * MIX[2] + ids[i : i + n])
    found.sort()
    return found[np.append(True, found[1:] != found[:-1])]


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - ORDER_BITS)).astype(np.int64)


def code(counts: np.ndarray) -> np.ndarray:
    """Counts on a logarithmic scale of eight steps an octave."""
    return np.minimum(255, 8 * np.log2(1.0 + counts)).astype(np.uint8)


def frequency_levels(docs: DataFrame, rule: Rule) -> np.ndarray:
    """For each counter a level, zero for those no fuller than chance would fill them.

    Tasks count their shingles, chunks of counters are added up by a shuffle, and ``2**ORDER_BITS`` bytes reach the driver.
    """
    width = (1 << ORDER_BITS) // ORDER_CHUNKS

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, known = np.zeros(1 << ORDER_BITS, np.uint32), Hashes()
        for batch in stream:
            data, offsets = text_bytes(batch["text"])
            for a, b in zip(offsets, offsets[1:]):
                np.add.at(seen, buckets(shingles(bytes(data[a:b]), known, rule.size)), 1)
        parts = [pa.compress(p.tobytes(), "zstd", asbytes=True) for p in seen.reshape(ORDER_CHUNKS, width)]
        yield pa.RecordBatch.from_arrays([pa.array(range(ORDER_CHUNKS), pa.int32()), pa.array(parts, pa.binary())], ["chunk", "counts"])

    def add(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in stream:
            for chunk, counts in zip(batch["chunk"].to_pylist(), batch["counts"].to_pylist()):
                own = np.frombuffer(pa.decompress(counts, width * 4, "zstd", asbytes=True), np.uint32)
                sums[chunk] = sums.get(chunk, 0) + own.astype(np.int64)
        chunks = sorted(sums)
        codes = [code(sums[c]).tobytes() for c in chunks]
        totals = [int(sums[c].sum()) for c in chunks]
        yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int32()), pa.array(codes, pa.binary()), pa.array(totals, pa.int64())], ["chunk", "codes", "total"])

    bound_batches(docs.sparkSession)
    counted = docs.select("text").mapInArrow(count, "chunk int, counts binary")
    rows = counted.repartition("chunk").mapInArrow(add, "chunk int, codes binary, total long").collect()
    codes = np.zeros((ORDER_CHUNKS, width), np.uint8)
    for row in rows:
        codes[row["chunk"]] = np.frombuffer(row["codes"], np.uint8)
    mean = sum(r["total"] for r in rows) / codes.size
    usual = int(code(np.array([mean + 6 * mean**0.5 + 8]))[0])
    return np.where(codes.ravel() <= usual, 0, codes.ravel() // 4).astype(np.uint8)


def folded(rows: np.ndarray, size: int) -> np.ndarray:
    """Sketches, as rows of bytes, brought to fewer bits."""
    while rows.shape[1] > size:
        half = rows.shape[1] // 2
        rows = rows[:, :half] ^ rows[:, half:]
    return rows


SETS = "doc_id {}, mark long, n int, digest binary, front binary, hot int, prefix array<long>, sketch binary"


def sets(docs: DataFrame, levels: np.ndarray, rule: Rule) -> DataFrame:
    """Size, digest, prefix and sketch of the set of each row of ``docs (doc_id, mark, text)``; the text is left behind.

    The last ``hot`` shingles of a prefix are those that are not cold.
    """
    shared = docs.sparkSession.sparkContext.broadcast(levels)
    known = Hashes()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(batch["text"])
        out = []
        for a, b in zip(offsets, offsets[1:]):
            own = shingles(bytes(data[a:b]), known, rule.size)
            level = shared.value[buckets(own)]
            first = np.argsort(level, kind="stable")[: rule.prefix_length(len(own))] if len(own) else np.empty(0, np.int64)
            hot, first = int((level[first] > 0).sum()), own[first]
            out.append((len(own), xxhash.xxh3_128_digest(own.tobytes()), xxhash.xxh3_128_digest(first.tobytes()), hot, first.view(np.int64), rule.sketch(own)))
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.list_(pa.int64()), pa.binary()]
        columns = [pa.array(list(x), kind) for x, kind in zip(zip(*out), kinds)]
        return pa.RecordBatch.from_arrays([batch["doc_id"], batch["mark"], *columns], ["doc_id", "mark", "n", "digest", "front", "hot", "prefix", "sketch"])

    return by_arrow(docs.select("doc_id", "mark", "text"), SETS.format(docs.schema["doc_id"].dataType.simpleString()), work)


def packed(docs: DataFrame) -> DataFrame:
    """``(mark, text)`` with the text compressed, for a shuffle."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(batch["text"])
        pack = zstandard.ZstdCompressor(level=3)
        return pa.RecordBatch.from_arrays([batch["mark"], pa.array([pack.compress(bytes(data[a:b])) for a, b in zip(offsets, offsets[1:])], pa.binary())], ["mark", "text"])

    return by_arrow(docs.select("mark", "text"), "mark long, text binary", work)


def verified(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``(a, b)`` of classes whose sets reach the similarity; ``texts (cid, text)`` are compressed."""
    left = texts.select(F.col("cid").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("cid").alias("b"), F.col("text").alias("text_b"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, known, unpack = Hashes(), {}, zstandard.ZstdDecompressor()
        for name in ("a", "b"):
            for i, text in zip(batch[name].to_pylist(), batch[f"text_{name}"].to_pylist()):
                if i not in known:
                    known[i] = shingles(unpack.decompress(text), words, rule.size)
        good = [rule.linked(known[a], known[b]) for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist())]
        return batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return by_arrow(pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b"), "a long, b long", work)


def star_pairs(lists: DataFrame, turn: int, rule: Rule) -> DataFrame:
    """Each group with a leader of its list among those of about its size; bands of sizes shift from turn to turn."""
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(rule.of / rule.link)) + turn / ROUNDS)
    banded = lists.select("token", band.alias("band"), "gid", "root", F.pmod("token", F.lit(LEADERS)).alias("slot"))
    order = F.struct(F.xxhash64("gid", "slot", F.lit(turn)).alias("h"), "gid")
    lead = banded.groupBy(F.col("token").alias("t"), F.col("band").alias("w")).agg(F.min(F.struct(order.alias("o"), "root")).alias("lead"))
    met = banded.join(lead, (F.col("token") == F.col("t")) & (F.col("band") == F.col("w")))
    a, b = F.col("gid"), F.col("lead.o.gid")
    return met.where((a != b) & (F.col("root") != F.col("lead.root"))).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()


class Entries:
    """Entries of lists in arrays, with their sketches in every size that a comparison may need."""

    def __init__(self, rows: pa.Table):
        for name in ("gid", "n", "pos", "low", "high", "members"):
            setattr(self, name, rows[name].to_numpy().astype(np.int64))
        held = rows["sketch"].to_pylist()
        self.bytes = np.array([len(s) for s in held])
        sizes, self.sketches = np.unique(self.bytes).tolist(), {}
        for size in sizes:
            self.sketches[size] = np.zeros((len(held), size), np.uint8)
            for big in sizes:
                if big >= size:
                    these = np.flatnonzero(self.bytes == big)
                    self.sketches[size][these] = folded(np.frombuffer(b"".join([held[k] for k in these]), np.uint8).reshape(-1, big), size)

    def filtered(self, a: np.ndarray, b: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
        """Of pairs of places those whose groups may hold a link between different components."""
        one, two = self.n[a], self.n[b]
        need = rule.needed(one + two)
        most = np.minimum(self.pos[a], self.pos[b]) + 1 + np.minimum(one - 1 - self.pos[a], two - 1 - self.pos[b])
        may = (rule.link * np.maximum(one, two) <= rule.of * np.minimum(one, two)) & (most >= need)
        may &= np.minimum(self.low[a], self.low[b]) != np.maximum(self.high[a], self.high[b])
        a, b, apart = a[may], b[may], (one + two - 2 * need)[may]
        keep = np.ones(len(a), bool)
        single = (self.members[a] == 1) & (self.members[b] == 1)
        sizes = np.minimum(self.bytes[a], self.bytes[b])
        for size, table in self.sketches.items():
            own = np.flatnonzero(single & (sizes == size))
            step = max(1, SKETCH_BYTES // size)
            for at in range(0, len(own), step):
                now = own[at : at + step]
                bits = np.bitwise_count((table[a[now]] ^ table[b[now]]).view(np.uint64)).sum(axis=1, dtype=np.int64)
                keep[now] = bits <= apart[now]
        return a[keep], b[keep]


#: Leaves those of pairs of places that are wanted; what it gives for parts of the pairs, it can be given again.
Find = Callable[[Entries, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def pairs_of_runs(entries: Entries, run: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """The filtered pairs within each run of short lists, all runs at once."""
    lefts, rights = [], []
    for step in range(1, SHORT):
        a = np.flatnonzero(run[:-step] == run[step:])
        if not len(a):
            break
        a, b = entries.filtered(a, a + step, rule)
        lefts.append(a)
        rights.append(b)
    none = np.empty(0, np.int64)
    return np.concatenate([none, *lefts]), np.concatenate([none, *rights])


def pairs_of_cell(entries: Entries, x: np.ndarray, y: np.ndarray, same: bool, rule: Rule, find: Find) -> tuple[np.ndarray, np.ndarray]:
    """What ``find`` leaves of the filtered pairs of two chunks, or of one; they are never held all at once."""
    none = np.empty(0, np.int64)
    lefts, rights = [none], [none]
    for at in range(0, len(x), 128):
        part = x[at : at + 128]
        a, b = np.repeat(part, len(y)), np.tile(y, len(part))
        if same:
            a, b = a[a < b], b[a < b]
        a, b = find(entries, *entries.filtered(a, b, rule))
        lefts.append(a)
        rights.append(b)
    return find(entries, np.concatenate(lefts), np.concatenate(rights))


def partners(entries: Entries, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The groups that have a partner, each as a pair of itself."""
    found = np.append(a, b)
    found = found[np.unique(entries.gid[found], return_index=True)[1]]
    return found, found


def every_pair(entries: Entries, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return a, b


def spanning_pairs(entries: Entries, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that join the components as far as all of the pairs would, if each held a link."""
    root: dict[int, int] = {}

    def find(k: int) -> int:
        while root.get(k, k) != k:
            root[k] = k = root.get(root[k], root[k])
        return k

    keep = np.ones(len(a), bool)
    whole = np.flatnonzero((entries.low[a] == entries.high[a]) & (entries.low[b] == entries.high[b]))
    for at, u, v in zip(whole.tolist(), entries.low[a[whole]].tolist(), entries.low[b[whole]].tolist()):
        u, v = find(u), find(v)
        keep[at] = u != v
        root[u] = v
    return a[keep], b[keep]


def over_cells(cells: DataFrame, rule: Rule, find: Find) -> DataFrame:
    """``(a, b)``: what ``find`` gives for the filtered pairs of the cells. A cell arrives as a run of equal ``(token, i, j)``."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def out(rows: pa.Table) -> pa.RecordBatch:
        """For whole cells."""
        entries = Entries(rows)
        keys = np.stack([rows[c].to_numpy() for c in ("token", "i", "j")])
        begins = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
        sizes = np.diff(np.append(begins, rows.num_rows))
        short = (sizes <= SHORT) & (keys[1, begins] == keys[2, begins])
        run = np.repeat(np.where(short, np.arange(len(begins)), -1), sizes)
        # Entries of long lists are runs of their own here.
        a, b = pairs_of_runs(entries, np.where(run >= 0, run, -1 - np.arange(len(run))), rule)
        lefts, rights = [a], [b]
        chunk = rows["chunk"].to_numpy()
        for low, size in zip(begins[~short].tolist(), sizes[~short].tolist()):
            places = np.arange(low, low + size)
            x, y = places[chunk[places] == keys[1, low]], places[chunk[places] == keys[2, low]]
            a, b = pairs_of_cell(entries, x, y, keys[1, low] == keys[2, low], rule, find)
            lefts.append(a)
            rights.append(b)
        a, b = (entries.gid[c] for c in find(entries, np.concatenate(lefts), np.concatenate(rights)))
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], schema=schema)

    def work(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in stream:
            if not batch.num_rows:
                continue
            last = tuple(batch[c][batch.num_rows - 1].as_py() for c in ("token", "i", "j"))
            same = np.logical_and.reduce([batch[c].to_numpy() == v for c, v in zip(("token", "i", "j"), last)])
            cut = batch.num_rows - int(same.sum())
            # The last cell may go on in the next batch.
            if cut:
                yield out(pa.Table.from_batches([*rest, batch.slice(0, cut)]))
                rest = []
            elif rest and any(rest[-1][c][0].as_py() != v for c, v in zip(("token", "i", "j"), last)):
                yield out(pa.Table.from_batches(rest))
                rest = []
            rest.append(batch.slice(cut))
        if rest:
            yield out(pa.Table.from_batches(rest))
        give_back()

    bound_batches(cells.sparkSession)
    dealt = cells.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    return dealt.mapInArrow(work, "a long, b long").distinct()


def in_cells(lists: DataFrame) -> DataFrame:
    """``lists`` with a row for every cell that an entry is in; entries of a list of one chunk are in one."""
    chunks = F.ceil(F.col("entries") / CHUNK)
    chunked = lists.withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("gid"), F.col("chunks")))
    each = chunked.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    return each.select("token", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "gid", "n", "pos", "low", "high", "members", "chunk", "sketch")


def counted(lists: DataFrame) -> DataFrame:
    """``lists`` with the number of entries of each list, without lists of one."""
    sizes = lists.groupBy(F.col("token").alias("t")).agg(F.count("*").alias("entries")).where("entries > 1")
    return lists.join(sizes, F.col("token") == F.col("t")).drop("t")


class Spanning:
    """Finds components by verified links among groups that meet in lists.

    A subclass provides ``groups (gid, members, sketch)``, the ``members (gid, cid)`` of groups that have several, the
    ``lists (token, pos, gid, n, entries)`` and the compressed ``texts (cid, text)``. A group goes by its first member.
    """

    groups: DataFrame
    members: DataFrame
    lists: DataFrame
    texts: DataFrame

    def __init__(self, spark, rule: Rule):
        self.spark, self.rule = spark, rule
        self.paths: list[str] = []
        self.links = spark.createDataFrame([], "a long, b long")
        self.roots = spark.createDataFrame([], "node long, root long")

    def keep(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        table, path = written(df, name, compression)
        self.paths.append(path)
        return table

    def add(self, pairs: DataFrame) -> int:
        """Verifies pairs of classes and brings the components up to date; how many links there are now to add."""
        found = self.keep(verified(pairs, self.texts, self.rule), "links")
        n = found.count()
        if n:
            self.links = self.links.union(found)
            self.roots, path = components(self.links)
            self.paths.append(path)
        return n

    def spans(self) -> DataFrame:
        """``(gid, low, high)``: smallest and largest component among the members of each group."""
        several = self.members.join(self.roots, F.col("cid") == F.col("node"), "left").select("gid", F.coalesce("root", "cid").alias("root"))
        several = several.groupBy("gid").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        single = self.groups.where("members = 1").select("gid").join(self.roots, F.col("gid") == F.col("node"), "left")
        return several.union(single.select("gid", F.coalesce("root", "gid").alias("low"), F.coalesce("root", "gid").alias("high")))

    def open_lists(self) -> DataFrame:
        """The lists that hold more than one component, with each group's span."""
        placed = self.lists.join(self.spans().withColumnRenamed("gid", "g"), F.col("gid") == F.col("g")).drop("g")
        apart = placed.groupBy(F.col("token").alias("t")).agg(F.min("low").alias("l"), F.max("high").alias("h")).where("l < h").select("t")
        return placed.join(apart, F.col("token") == F.col("t"), "left_semi")

    def cells(self) -> DataFrame:
        return in_cells(self.open_lists().join(self.groups.select(F.col("gid").alias("g"), "members", "sketch"), F.col("gid") == F.col("g")).drop("g"))

    def expanded(self, pairs: DataFrame) -> DataFrame:
        """Pairs of groups as pairs of their members, as far as those are in different components."""
        left = self.members.select(F.col("gid").alias("ga"), F.col("cid").alias("ca"))
        right = self.members.select(F.col("gid").alias("gb"), F.col("cid").alias("cb"))
        met = pairs.join(left, F.col("a") == F.col("ga"), "left").join(right, F.col("b") == F.col("gb"), "left")
        return self.apart(met.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))

    def apart(self, pairs: DataFrame) -> DataFrame:
        one, two = (self.roots.select(F.col("node").alias(f"n{x}"), F.col("root").alias(f"r{x}")) for x in "ab")
        met = pairs.join(one, F.col("a") == F.col("na"), "left").join(two, F.col("b") == F.col("nb"), "left")
        return met.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")

    def inside(self) -> DataFrame:
        """Pairs of members of one group that are in different components."""
        mixed_ = self.spans().where("low < high").select("gid")
        own = self.members.join(mixed_, "gid", "left_semi")
        pairs = own.select("gid", F.col("cid").alias("a")).join(own.select(F.col("gid").alias("g"), F.col("cid").alias("b")), F.col("gid") == F.col("g"))
        return self.apart(pairs.where("a > b").select("a", "b"))

    def run(self) -> None:
        own = self.members.where("cid <> gid").select(F.col("cid").alias("a"), F.col("gid").alias("b"))
        for turn in range(ROUNDS):
            stars = star_pairs(self.open_lists().withColumn("root", F.col("low")), turn, self.rule)
            self.add(stars.union(own) if turn == 0 else stars)
        for find in (spanning_pairs, every_pair):
            pairs = self.expanded(self.keep(over_cells(self.cells(), self.rule, find), "group-pairs"))
            self.add(pairs if find is spanning_pairs else pairs.union(self.inside()))


class PrefixJoin(Spanning):
    """The classes, groups and lists of a set of documents."""

    def __init__(self, docs: DataFrame, rule: Rule):
        super().__init__(docs.sparkSession, rule)
        marked = docs.select("doc_id", "text", row_hash(docs.select("doc_id", "text")).alias("mark"))
        self.sets = self.keep(sets(marked, frequency_levels(docs, rule), rule), "sets")
        known = self.sets.where("n > 0")
        meeting = F.xxhash64("n", "front")  # groups that share it are met as one
        alike = known.groupBy("n", "digest").agg(
            F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.min("mark").alias("mark"),
            F.min("front").alias("front"), F.min("sketch").alias("sketch"),
        )
        alike = alike.select("n", "digest", "first_id", "copies", "mark", "sketch", meeting.alias("meeting"), F.monotonically_increasing_id().alias("cid"))
        self.classes = self.keep(alike, "classes")
        found = self.classes.groupBy("meeting").agg(F.min("cid").alias("gid"), F.count("*").alias("members"), F.min_by("sketch", "cid").alias("sketch"))
        groups = self.keep(found, "groups")
        self.lists, alive = self.shared_shingles(known, groups, meeting)
        self.groups = self.keep(groups.join(alive, "gid", "left_semi").select("gid", "members", "sketch"), "live-groups")
        several = groups.where("members > 1").select("meeting", "gid")
        self.members = self.keep(self.classes.join(several, "meeting").select("gid", "cid"), "members")
        wanted = alive.select(F.col("gid").alias("cid")).union(self.members.select("cid")).distinct()
        wanted = self.keep(self.classes.join(wanted, "cid", "left_semi").select("cid", F.col("mark").alias("m")), "wanted")
        own = packed(marked).join(wanted, F.col("mark") == F.col("m")).select("cid", "text").dropDuplicates(["cid"])
        self.texts = self.keep(own, "candidate-texts")

    def shared_shingles(self, known: DataFrame, groups: DataFrame, meeting) -> tuple[DataFrame, DataFrame]:
        """The lists, cut down to groups that have a partner somewhere, and those groups."""
        fronts = known.groupBy("n", "front").agg(F.first("prefix").alias("prefix"), F.first("hot").alias("hot"))
        each = fronts.select(meeting.alias("meeting"), "n", (F.size("prefix") - F.col("hot")).alias("cold"), F.posexplode("prefix").alias("pos", "token"))
        by_size = Window.partitionBy("token").orderBy("n")
        link, of = self.rule.link, self.rule.of
        near = (of * F.lag("n").over(by_size) >= link * F.col("n")) | (link * F.lead("n").over(by_size) <= of * F.col("n"))
        # A cold shingle is in few documents, so its list is short; hot ones stay out of the window.
        cold = each.where("pos < cold").select("meeting", "n", "pos", "token").withColumn("near", near).where("near").drop("near")
        both = cold.union(each.where("pos >= cold").select("meeting", "n", "pos", "token"))
        every = self.keep(both, "postings")
        # Any pair of members may have a link, so a group of several always has partners.
        mini = groups.select("meeting", "gid", "members", "sketch")
        # Lists are counted before sketches come along, so these move once, with the cells.
        met = counted(every).join(mini, "meeting").drop("meeting")
        marks = over_cells(in_cells(met.withColumns({"low": F.col("gid"), "high": F.col("gid")})), self.rule, partners)
        alive = self.keep(marks.select(F.col("a").alias("gid")).union(groups.where("members > 1").select("gid")).distinct(), "alive")
        lists = every.join(groups.select("meeting", "gid"), "meeting").join(alive, "gid", "left_semi").select("token", "pos", "gid", "n")
        return self.keep(counted(lists), "lists"), alive

    def verdicts(self) -> DataFrame:
        rooted = self.classes.join(self.roots, F.col("cid") == F.col("node"), "left").select("n", "digest", "first_id", "copies", "root", F.coalesce("root", "cid").alias("of"))
        least = rooted.where("root is not null").groupBy(F.col("root").alias("r")).agg(F.min("first_id").alias("least"))
        # Only classes with several rows or with links need looking up.
        known = rooted.where("copies > 1 or root is not null").join(least, F.col("root") == F.col("r"), "left").select(
            F.col("n").alias("of_n"), F.col("digest").alias("of_digest"), F.coalesce("least", "first_id").alias("least"), F.lit(True).alias("met")
        )
        table = self.keep(known, "components")
        met = self.sets.select("doc_id", "n", "digest").join(table, (F.col("n") == F.col("of_n")) & (F.col("digest") == F.col("of_digest")), "left")
        return met.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("met"), F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def similar_documents(docs: DataFrame, rule: Rule = CONTRACT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, a row for each row of ``docs``."""
    join = PrefixJoin(docs.select("doc_id", "text"), rule)
    join.run()
    found = join.verdicts()
    discard(docs.sparkSession, *[p for p in join.paths if "/sets-" not in p and "/components-" not in p])
    return found
