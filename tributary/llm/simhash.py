"""SimHash near-duplicates: fingerprints that differ in at most three of 64 bits are linked.

Candidates are met in the middle. Two fingerprints at an even distance have a variant halfway, one that each reaches by
flipping half of the differing bits. Three bits have no middle, so the third is masked: the 64 bits are cut into three
blocks, and each fingerprint emits, for every block left out, all variants of the other bits with at most one bit
flipped (131 rows). Leave out a block in which two linked fingerprints differ: at most two bits are left to differ, and
their balls of radius one meet. (All three in one block meet as well, in the variant without a flip.)

The rows are shuffled on the variant. A group never holds more than 43 * 2**22 distinct fingerprints, whatever the input,
and is linked in stars instead of pairs: those equal in the masked block are within two bits of each other, so each is
linked to one of them, and one of them to one of every set that differs in one masked bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, by_arrow, discard, free_names, row_hash, text_bytes, written
from .components import components

RADIUS, SEED, SHINGLE = 3, 42, 3
BLOCKS = ((0, 22), (22, 43), (43, 64))
ALL_BITS = (1 << 64) - 1
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def block_mask(block: int) -> int:
    low, high = BLOCKS[block]
    return (1 << high) - (1 << low)


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """SimHash over all word shingles of a text; zero when it has no words."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.append(0, ends[:-1] + 1)
    size = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())], np.uint64)
    set_in = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        set_in += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, out: str) -> DataFrame:
    """``docs`` without ``text``, with the fingerprint as a signed long; a null text has no words."""
    kept = [c for c in docs.columns if c != "text"]
    schema = docs.select(*[F.col(f"`{c}`") for c in kept], F.lit(0).cast("long").alias(out)).schema

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(batch["text"])
        prints = [fingerprint(bytes(data[a:b])) for a, b in zip(offsets, offsets[1:])]
        return pa.RecordBatch.from_arrays([*[batch[c] for c in kept], pa.array(np.array(prints, np.uint64).view(np.int64))], [*kept, out])

    return by_arrow(docs, schema, work)


def variants(nodes: DataFrame) -> DataFrame:
    """``(block, key, fp)``: every variant of every fingerprint, the masked block's bits cleared."""
    entries = []
    for block in range(len(BLOCKS)):
        keep = ALL_BITS ^ block_mask(block)
        for flip in [0, *(1 << i for i in range(64) if keep >> i & 1)]:
            entries.append(f"named_struct('block', {block}Y, 'keep', {signed(keep)}L, 'flip', {signed(flip)}L)".replace("-9223372036854775808L", "(-9223372036854775807L - 1L)"))
    each = nodes.select("fp", F.expr(f"inline(array({', '.join(entries)}))"))
    return each.select("block", F.col("fp").bitwiseXOR(F.col("flip")).bitwiseAND(F.col("keep")).alias("key"), "fp")


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def star_edges(block: int, key: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all fingerprints of a group which are within the radius of each other."""
    low, high = BLOCKS[block]
    mask = np.uint64(block_mask(block))
    inner = (prints & mask) >> np.uint64(low)
    values, first, of = np.unique(inner, return_index=True, return_inverse=True)
    lead = prints[first]
    left, right = [lead[of]], [prints]

    def meet(here: np.ndarray, there: np.ndarray, target: np.ndarray, leads: np.ndarray, own: np.ndarray) -> None:
        """Links own[i] with the lead of the entry of ``target`` that equals there[i]."""
        at = np.minimum(np.searchsorted(target, there), len(target) - 1)
        hit = target[at] == there
        left.append(own[here[hit]])
        right.append(leads[at[hit]])

    every = np.arange(len(values))
    for bit in range(high - low):
        meet(every, values ^ np.uint64(1 << bit), values, lead, lead)
    exact = (prints & ~mask) == np.uint64(key)
    if exact.sum() > 1:  # all differing bits may lie in the masked block: one flip from one side, two from the other
        own, bits = inner[exact], np.uint64(1) << np.arange(high - low, dtype=np.uint64)
        one = (own[:, None] ^ np.append(np.uint64(0), bits)).ravel()
        near, where = np.unique(one, return_index=True)
        leads = prints[exact][where // (len(bits) + 1)]
        for i, bit in enumerate(bits):
            far = (own[:, None] ^ (bit ^ bits[i + 1 :])).ravel()
            if len(far):
                meet(np.repeat(np.arange(len(own)), len(bits) - i - 1), far, near, leads, prints[exact])
    return np.concatenate(left), np.concatenate(right)


def group_links(block: np.ndarray, key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified links of whole groups, which arrive as runs of equal ``(block, key)``."""
    none = np.empty(0, np.uint64)
    begins = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (key[1:] != key[:-1])))
    sizes = np.diff(np.append(begins, len(fp)))
    keep = np.array([ALL_BITS ^ block_mask(b) for b in range(len(BLOCKS))], np.uint64)
    outer = fp & keep[block]
    # Fingerprints alike outside the masked block meet in each other's every variant; the one without a flip is enough.
    several = np.maximum.reduceat(outer, begins) != np.minimum.reduceat(outer, begins)
    useful = (sizes > 1) & (several | (outer[begins] == key[begins]))
    lefts, rights = [none], [none]
    pairs = begins[useful & (sizes == 2)]
    lefts.append(fp[pairs])
    rights.append(fp[pairs + 1])
    for at in np.flatnonzero(useful & (sizes > 2)):
        i, n = begins[at], sizes[at]
        a, b = star_edges(int(block[i]), int(key[i]), fp[i : i + n])
        lefts.append(a)
        rights.append(b)
    a, b = np.concatenate(lefts), np.concatenate(rights)
    linked = (a != b) & (distance(a, b) <= RADIUS)
    return a[linked], b[linked]


def links(nodes: DataFrame) -> DataFrame:
    """``(a, b)``: edges that connect exactly the fingerprints connected by distances of at most three."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def work(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.empty(0, np.int8), np.empty(0, np.uint64), np.empty(0, np.uint64)]

        def out(block, key, fp):
            a, b = group_links(block, key, fp)
            pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1), axis=0) if len(a) else np.empty((0, 2), np.uint64)
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, i]).view(np.int64)) for i in (0, 1)], schema=schema)

        for batch in stream:
            new = [batch["block"].to_numpy(), batch["key"].to_numpy().view(np.uint64), batch["fp"].to_numpy().view(np.uint64)]
            block, key, fp = [np.concatenate(x) for x in zip(rest, new)]
            # The last group may go on in the next batch.
            cut = len(fp)
            same = (block == block[-1]) & (key == key[-1]) if cut else np.empty(0, bool)
            cut -= int(same.sum())
            if cut:
                yield out(block[:cut], key[:cut], fp[:cut])
            rest = [block[cut:], key[cut:], fp[cut:]]
        if len(rest[2]):
            yield out(*rest)

    bound_batches(nodes.sparkSession)
    grouped = variants(nodes).repartition("block", "key").sortWithinPartitions("block", "key")
    return grouped.mapInArrow(work, "a long, b long")


def classes(prints: DataFrame) -> tuple[DataFrame, list[str]]:
    """``(fp, root, component_id)`` for each distinct fingerprint of ``prints (doc_id, fp)``; paths it lives in.

    ``component_id`` is the smallest doc_id of the component, null if all are null.
    """
    spark = prints.sparkSession
    nodes, nodes_path = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    roots, edges_path = components(links(nodes))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    rooted, rooted_path = written(rooted, "rooted")
    least = rooted.groupBy(F.col("root").alias("of")).agg(F.min("first_id").alias("component_id"))
    found, path = written(rooted.join(least, F.col("root") == F.col("of")).select("fp", "root", "component_id"), "classes")
    discard(spark, nodes_path, edges_path, rooted_path)
    return found, [path]


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, a row for each row of ``docs``.

    Nulls and empty texts have the fingerprint zero and are linked like any other. Rows that repeat stay separate rows of
    one component. Other columns are not read, whatever their names.
    """
    prints, _ = written(with_fingerprint(docs.select("doc_id", "text"), "fp"), "prints")
    found, _ = classes(prints)
    return prints.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, marked: DataFrame, mark: str, prints: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one for each root. ``marked`` is ``docs`` with the row hash as ``mark``, ``prints``
    has ``(doc_id, mark, fp)`` of each row and ``found`` the root of each ``fp``; both are read before it returns."""
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "mark")
    # Copies of a row meet in map-side sums before anything is compared.
    rows = prints.groupBy("fp", "doc_id", "mark").agg(F.count("*").alias("copies"))
    best = rows.join(found, "fp").groupBy("root").agg(F.min_by(F.struct("doc_id", "mark", "copies"), order).alias("w"))
    winners, _ = written(best.select(F.col("w.doc_id").alias("w_id"), F.col("w.mark").alias("w_mark"), F.col("w.copies").alias("w_copies")), "winners")
    wid, wmark, wcopies = free_names(marked, "w_id", "w_mark", "w_copies")
    winners = winners.select(F.col("w_id").alias(wid), F.col("w_mark").alias(wmark), F.col("w_copies").alias(wcopies))
    kept = marked.join(winners, F.col("doc_id").eqNullSafe(F.col(wid)) & (F.col(mark) == F.col(wmark)))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return kept.where(F.col(wcopies) == 1).select(*columns).union(kept.where(F.col(wcopies) > 1).select(*columns).distinct())


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, that of the smallest doc_id, with all columns.

    Of several rows with that doc_id the one with the smallest row hash stays; of wholly equal rows, one. A null doc_id
    loses to any other.
    """
    mark, fp = free_names(docs, "row_mark", "row_print")
    marked = docs.select("*", row_hash(docs).alias(mark))
    prints, prints_path = written(with_fingerprint(marked.select("doc_id", "text", mark), fp).select("doc_id", F.col(mark).alias("mark"), F.col(fp).alias("fp")), "prints")
    found, paths = classes(prints.select("doc_id", "fp"))
    kept = one_of_each(docs, marked, mark, prints, found)
    discard(docs.sparkSession, prints_path, *paths)
    return kept
