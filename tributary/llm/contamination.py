"""Benchmark decontamination: which words of each document lie inside a passage of a benchmark.

The benchmark's windows of 13 words go to every task as a hash set with a proven bound: pairs of a window and an item
are cut into blocks of at most ``BLOCK_PAIRS``, and with more than one block the documents pass one after the other,
written in between. A scan turns a document's words into benchmark word numbers, looks rolling hashes of its windows
up in the set, and compares the words of every hit.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_arrow, discard, free_names, text_bytes, written

WINDOW = 13
SHARE = 20  # contaminated: one word in twenty, or more, is hit
BLOCK_PAIRS = 200_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)
# A-Z become a-z; ASCII that is neither letter nor digit parts words.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(item, words)``: the distinct windows of each item, words joined by a space; a null item_id becomes ''."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(batch["text"])
        items, found = [], []
        for item, a, b in zip(batch["item"].to_pylist(), offsets, offsets[1:]):
            words = words_of(bytes(data[a:b]))
            size = min(window, len(words))
            own = {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)} if words else ()
            items += [item] * len(own)
            found += own
        return pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(found, pa.binary())], ["item", "words"])

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return by_arrow(items, "item string, words binary", work).distinct()


def rolling(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` ids."""
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * FACTOR
    mixed ^= mixed >> np.uint64(29)
    out = np.zeros(len(ids) - size + 1, np.uint64)
    for j in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + mixed[j : j + len(out)]
    return out


class Windows:
    """The windows of a block, by length: sorted hashes, the word numbers behind them, and the items that hold them."""

    def __init__(self, pairs: list[tuple[str, bytes]]):
        self.items = sorted({item for item, _ in pairs})
        number = {item: i for i, item in enumerate(self.items)}
        held: dict[bytes, list[int]] = {}
        for item, words in sorted(pairs):
            held.setdefault(words, []).append(number[item])
        split = {words: words.split(b" ") for words in held}
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for ws in split.values() for w in ws}), 1)}
        self.by_size = {}
        for size in sorted({len(ws) for ws in split.values()}):
            own = [w for w in held if len(split[w]) == size]
            ids = np.array([[self.vocabulary[w] for w in split[x]] for x in own], np.int64)
            hashes = np.concatenate([rolling(row, size) for row in ids])
            order = np.argsort(hashes, kind="stable")
            self.by_size[size] = (hashes[order], ids[order], [held[own[i]] for i in order])

    def scan(self, words: list[bytes], hit: np.ndarray) -> set[str]:
        """Marks the words that lie in a window in ``hit``; the items whose windows occur."""
        ids = np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words))
        unknown = np.append(0, np.cumsum(ids == 0))
        found: set[int] = set()
        for size, (hashes, rows, held) in self.by_size.items():
            if len(ids) < size:
                continue
            at = np.flatnonzero(unknown[size:] == unknown[: len(ids) - size + 1])
            if not len(at):
                continue
            own = rolling(ids, size)[at]
            low, high = np.searchsorted(hashes, own), np.searchsorted(hashes, own, "right")
            for i, a, b in zip(at[low < high].tolist(), low[low < high].tolist(), high[low < high].tolist()):
                for j in range(a, b):
                    if np.array_equal(rows[j], ids[i : i + size]):
                        hit[i : i + size] = True
                        found.update(held[j])
        return {self.items[i] for i in found}


def scan(docs: DataFrame, benchmark: DataFrame, block_pairs: int = BLOCK_PAIRS, window: int = WINDOW) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the hit words and items of each row; the names of the added columns by ``words``, ``hits``, ``items``.

    ``words`` counts words, ``hits`` is a bit for each word (little-endian), ``items`` holds the sorted item ids whose
    windows occur. Nulls have no words. Rows are judged one by one, so repeated rows have equal results.
    """
    spark = docs.sparkSession
    pairs, path = written(item_windows(benchmark, window), "windows")
    names = dict(zip(("words", "hits", "items"), free_names(docs, "n_words", "hit_bits", "hit_items")))
    columns = [names[k] for k in ("words", "hits", "items")]
    state = docs.select("*", F.lit(0).cast("long").alias(columns[0]), F.lit(b"").alias(columns[1]), F.array().cast("array<string>").alias(columns[2]))
    schema, n_blocks, earlier = state.schema, max(1, -(-pairs.count() // block_pairs)), None
    # Cut by hash into as many blocks again as needed, so that chance never puts more than the bound into one.
    n_blocks = n_blocks if n_blocks == 1 else 2 * n_blocks
    for block in range(n_blocks):
        own = pairs.where(F.pmod(F.xxhash64("item", "words"), F.lit(n_blocks)) == block)
        block_rows = [(r["item"], bytes(r["words"])) for r in own.collect()]
        shared = spark.sparkContext.broadcast(block_rows)
        ready: list[Windows] = []

        def work(batch: pa.RecordBatch, shared=shared, ready=ready) -> pa.RecordBatch:
            if not ready:
                ready.append(Windows(shared.value))
            data, offsets = text_bytes(batch["text"])
            counts, bits, items = [], [], []
            for k, (a, b) in enumerate(zip(offsets, offsets[1:])):
                words = words_of(bytes(data[a:b]))
                before, known = batch[columns[1]][k].as_py(), batch[columns[2]][k].as_py()
                hit = np.unpackbits(np.frombuffer(before, np.uint8), bitorder="little", count=len(words)).astype(bool) if before else np.zeros(len(words), bool)
                found = ready[0].scan(words, hit)
                counts.append(len(words))
                bits.append(np.packbits(hit, bitorder="little").tobytes() if hit.any() else b"")
                items.append(sorted({*known, *found}))
            kept = [batch[c] for c in batch.schema.names if c not in columns]
            return pa.RecordBatch.from_arrays(
                [*kept, pa.array(counts, pa.int64()), pa.array(bits, pa.binary()), pa.array(items, pa.list_(pa.string()))],
                [*[c for c in batch.schema.names if c not in columns], *columns],
            )

        state = by_arrow(state, schema, work)
        if block + 1 < n_blocks:
            state, now = written(state, "scanned")
            if earlier:
                discard(spark, earlier)
            earlier = now
    discard(spark, path)
    return state, names


def verdicts(docs: DataFrame, benchmark: DataFrame, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)``, a row for each row of ``docs``.

    Contaminated: some word is hit, and at least one word in twenty. Other columns are not read.
    """
    state, names = scan(docs.select("doc_id", "text"), benchmark, block_pairs)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = batch[names["words"]].to_pylist()
        hits = [int.from_bytes(b, "little").bit_count() for b in batch[names["hits"]].to_pylist()]
        items = batch[names["items"]].to_pylist()
        return pa.RecordBatch.from_arrays(
            [
                batch["doc_id"], pa.array(words, pa.int64()), pa.array(hits, pa.int64()), pa.array([len(i) for i in items], pa.int64()),
                pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]),
                pa.array([h > 0 and SHARE * h >= n for n, h in zip(words, hits)]),
            ],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )

    schema = docs.select("doc_id", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"),
                         F.lit("").alias("items_sha256"), F.lit(True).alias("contaminated")).schema
    return by_arrow(state.drop("text"), schema, work)


def decontaminate(docs: DataFrame, benchmark: DataFrame, action: str = "documents", block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``docs`` without contaminated documents, or with every hit word cut out of the texts (``action="spans"``).

    All columns stay as they are; documents below the contamination share stay untouched by ``documents``.
    """
    if action not in ("documents", "spans"):
        raise ValueError(f"unknown action {action!r}")
    state, names = scan(docs, benchmark, block_pairs)
    count, bits = names["words"], names["hits"]
    columns = docs.columns

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hits = batch[bits].to_pylist()
        if action == "documents":
            counts = [int.from_bytes(b, "little").bit_count() for b in hits]
            clean = pa.array([h == 0 or SHARE * h < n for n, h in zip(batch[count].to_pylist(), counts)])
            return batch.select(columns).filter(clean)
        texts = batch["text"].to_pylist()
        for i, (t, b) in enumerate(zip(texts, hits)):
            texts[i] = cut(t, b) if b else t
        return batch.select(columns).set_column(columns.index("text"), "text", pa.array(texts, batch["text"].type))

    return by_arrow(state, docs.schema, work)


def cut(text: str, bits: bytes) -> str:
    """The text without its hit words; what stands between two hit words goes too."""
    raw = text.encode()
    flat = raw.translate(WORDS)
    words = words_of(raw)
    hit = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little", count=len(words)).astype(bool)
    out, at, end, before = [], 0, 0, False
    for word, gone in zip(words, hit.tolist()):
        start = flat.index(word, at)
        at = start + len(word)
        if not (gone and before):
            out.append(raw[end:start])
        if not gone:
            out.append(raw[start:at])
        end, before = at, gone
    return b"".join([*out, raw[end:]]).decode()
