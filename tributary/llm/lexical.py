"""Ranked lexical search: the best documents for every item, by integer term weights.

Documents are restricted to the terms of the items: a bag, the term numbers and their frequencies. Documents alike in
bag and in ``m`` score alike for every item, so each such class is scored once. A hash of both brings candidates together
and the bags themselves are compared. A class keeps its ``k`` smallest doc_ids, as no other member can be among the best
``k`` of an item; the best ``k`` classes of an item hold its best ``k`` documents, because every class ahead of another has
a member ahead of all of the other's.

Items go to every task in blocks of a bounded number of terms, all documents against each block. Tasks keep the best
``k`` classes for each item, and so does the shuffle between them.

Nulls: a null text has no terms; a document without any is not counted and never found. Repeated rows are documents of
their own, and so are repeated items, each ranked by itself. Equal scores go by ascending doc_id, nulls last. Empty
tables give no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, by_arrow, discard, text_bytes, written
from .contamination import words_of

TOP = 10
BLOCK_TERMS = 200_000  # pairs of an item and a term that are broadcast at once
LOAD = 1 << 20  # gains, and scores, held at once


def item_terms(items: DataFrame) -> DataFrame:
    """``(item, item_id, term)``: the terms of each item once; ``item`` tells rows apart that share an item_id."""
    schema = items.select("item", "item_id", F.lit(b"").alias("term")).schema

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(batch["text"])
        own = [sorted(set(words_of(bytes(data[a:b])))) for a, b in zip(offsets, offsets[1:])]
        at = pa.array([i for i, terms in enumerate(own) for _ in terms], pa.int32())
        flat = pa.array([t for terms in own for t in terms], pa.binary())
        return pa.RecordBatch.from_arrays([batch["item"].take(at), batch["item_id"].take(at), flat], ["item", "item_id", "term"])

    return by_arrow(items.select("item", "item_id", "text"), schema, work)


def bags(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``(doc_id, n, bag)``: how many terms a document has, and number and frequency of those in the vocabulary.

    ``bag`` holds pairs of little-endian unsigned 32-bit integers by ascending term number.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = docs.select("doc_id", F.lit(0).cast("long").alias("n"), F.lit(b"").alias("bag")).schema

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(batch["text"])
        known, counts, found = shared.value, [], []
        for a, b in zip(offsets, offsets[1:]):
            words = words_of(bytes(data[a:b]))
            counts.append(len(words))
            own = sorted((known[w], tf) for w, tf in Counter(words).items() if w in known)
            found.append(np.array(own, "<u4").tobytes())
        return pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(counts, pa.int64()), pa.array(found, pa.binary())], ["doc_id", "n", "bag"])

    return by_arrow(docs.select("doc_id", "text"), schema, work)


def frequencies(found: DataFrame, size: int) -> DataFrame:
    """``(term, df)``: in how many bags each term number is. Tasks add up before anything moves."""

    def work(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size, np.int64)
        for batch in stream:
            data, offsets = text_bytes(batch["bag"])
            pairs = np.frombuffer(data[offsets[0] : offsets[-1]], "<u4")[::2]
            seen += np.bincount(pairs, minlength=size)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(seen[at])], ["term", "df"])

    return found.select("bag").mapInArrow(work, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def classes(found: DataFrame, documents: int, terms: int, k: int) -> DataFrame:
    """``(class, m, bag, doc_id, member)``: of each class of equal bag and ``m`` the ``k`` smallest doc_ids, by number.

    Rows meet by a hash; the bags are compared. The limit by rank also holds below the shuffle, so a hot class sends ``k``
    rows for each task. Only the first member keeps the bag; its ``row`` names the class.
    """
    m = (F.lit(10) + F.expr(f"(90L * n * {documents}L) div {terms}L")).cast("long")
    known = found.where(F.length("bag") > 0).select("row", "doc_id", m.alias("m"), "bag").withColumn("print", F.xxhash64("bag", "m"))
    same = Window.partitionBy("print", "m", "bag").orderBy(F.col("doc_id").asc_nulls_last(), "row")
    so_far = same.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    members = known.withColumns({"member": F.row_number().over(same), "class": F.first("row").over(so_far)}).where(F.col("member") <= k)
    return members.select("class", "m", F.when(F.col("member") == 1, F.col("bag")).alias("bag"), "doc_id", "member")


class Items:
    """The terms of a block of items: for each term number its weight and the items that hold it."""

    def __init__(self, of_term: list[list[int]], weights: list[int], n_items: int):
        self.begins = np.append(0, np.cumsum([len(x) for x in of_term])).astype(np.int64)
        self.items = np.array([i for x in of_term for i in x], np.int64)
        self.weights = np.array(weights, np.int64)
        self.n_items = n_items

    def slices(self, pairs: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of documents whose gains and scores are few enough to be held at once; single ones at least."""
        many = self.begins[pairs[:, 0] + 1] - self.begins[pairs[:, 0]]
        load = np.append(0, np.cumsum(many))[ends] + self.n_items * np.arange(1, len(ends) + 1)
        low = 0
        while low < len(ends):
            done = load[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(load, done + LOAD, "right")))
            yield low, high
            low = high

    def scores(self, pairs: np.ndarray, sizes: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Scores of documents by items, in 64-bit integers."""
        of, term, tf = np.repeat(np.arange(len(sizes)), sizes), pairs[:, 0], pairs[:, 1]
        gain = self.weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[of]))
        many = self.begins[term + 1] - self.begins[term]
        before = np.cumsum(many) - many
        item = self.items[np.arange(int(many.sum())) + np.repeat(self.begins[term] - before, many)]
        out = np.zeros(len(sizes) * self.n_items, np.int64)
        np.add.at(out, np.repeat(of * self.n_items, many) + item, np.repeat(gain, many))
        return out.reshape(len(sizes), self.n_items)


class Best:
    """The best ``k`` of each item so far: of higher score, then of smaller first id, nulls last."""

    ORDER = [("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")]

    def __init__(self, n_items: int, k: int):
        self.k, self.held, self.least = k, None, np.ones(n_items, np.int64)

    def take(self, scores: np.ndarray, rows: pa.RecordBatch) -> None:
        n = len(scores)
        cut = np.partition(scores, n - self.k, axis=0)[n - self.k] if n > self.k else self.least
        item, row = np.nonzero((scores >= np.maximum(cut, self.least)).T)  # those equal to the last one stay in
        if not len(item):
            return
        new = pa.table({"item": item, "score": scores[row, item], "class": rows["class"].take(pa.array(row)), "doc_id": rows["doc_id"].take(pa.array(row))})
        both = (new if self.held is None else pa.concat_tables([self.held, new])).sort_by(self.ORDER)
        number = both["item"].to_numpy()
        begins = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
        place = np.arange(len(number)) - np.repeat(begins, np.diff(np.append(begins, len(number))))
        self.held = both.filter(pa.array(place < self.k)).combine_chunks()
        last = both.filter(pa.array(place == self.k - 1))
        self.least[last["item"].to_numpy()] = last["score"].to_numpy()


def best(found: DataFrame, items: Items, k: int) -> DataFrame:
    """``(item, score, class, doc_id)``: of the classes that a task sees, the best ``k`` of each item."""
    shared = found.sparkSession.sparkContext.broadcast(items)
    schema = found.select(F.lit(0).cast("long").alias("item"), F.lit(0).cast("long").alias("score"), "class", "doc_id").schema

    def work(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        tops = Best(own.n_items, k)
        for batch in stream:
            if not batch.num_rows:
                continue
            data, offsets = text_bytes(batch["bag"])
            pairs = np.frombuffer(data[offsets[0] : offsets[-1]], "<u4").reshape(-1, 2).astype(np.int64)
            ends, m = (np.array(offsets[1:]) - offsets[0]) // 8, batch["m"].to_numpy()
            begins = np.append(0, ends[:-1])
            for low, high in own.slices(pairs, ends):
                scores = own.scores(pairs[begins[low] : ends[high - 1]], (ends - begins)[low:high], m[low:high])
                tops.take(scores, batch.slice(low, high - low))
        if tops.held is not None:
            yield from tops.held.to_batches()

    bound_batches(found.sparkSession)
    return found.select("class", "m", "bag", "doc_id").mapInArrow(work, schema)


def search_block(docs: DataFrame, pairs: list, k: int, id_type: str) -> DataFrame:
    """The best documents for the items of one block, given as ``(item, item_id, term)``."""
    spark = docs.sparkSession
    number = {item: i for i, item in enumerate(sorted({p["item"] for p in pairs}))}
    names = {number[p["item"]]: p["item_id"] for p in pairs}
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(p["term"]) for p in pairs}))}
    of_term: list[list[int]] = [[] for _ in vocabulary]
    for p in pairs:
        of_term[vocabulary[bytes(p["term"])]].append(number[p["item"]])
    found, found_path = written(bags(docs, vocabulary).withColumn("row", F.monotonically_increasing_id()), "bags")
    documents, terms = found.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = [0] * len(vocabulary)
    for row in frequencies(found, len(vocabulary)).collect():  # a row for each term of the block at most
        weights[row["term"]] = math.floor(1000 * math.log((2 * documents + 2) / (2 * row["df"] + 1)))
    members, members_path = written(classes(found, documents, max(1, terms), k), "bag-classes")
    ahead = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    tops = best(members.where("member = 1"), Items(of_term, weights, len(names)), k).withColumn("place", F.row_number().over(ahead))
    chosen, chosen_path = written(tops.where(F.col("place") <= k).select("item", "score", F.col("class").alias("of")), "best-classes")
    expanded = chosen.join(members.select("class", "doc_id"), F.col("of") == F.col("class")).select("item", "score", "doc_id")
    ranked = expanded.withColumn("rank", F.row_number().over(ahead)).where(F.col("rank") <= k)
    known = spark.createDataFrame(sorted(names.items()), f"of long, item_id {id_type}")
    result, _ = written(ranked.join(known, F.col("item") == F.col("of")).select("item_id", "rank", "doc_id", "score"), "ranks")
    discard(spark, found_path, members_path, chosen_path)
    return result


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of each item, those with a score above zero."""
    spark = docs.sparkSession
    docs, id_type = docs.select("doc_id", "text"), items.schema["item_id"].dataType.simpleString()
    each, each_path = written(item_terms(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")), "item-terms")
    n_blocks = max(1, -(-each.count() // block_terms))
    # Cut by hash into as many blocks again as needed, so that chance never puts more than the bound into one.
    n_blocks = n_blocks if n_blocks == 1 else 2 * n_blocks
    found = []
    for block in range(n_blocks):
        pairs = each.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == block).collect()
        if pairs:
            found.append(search_block(docs, pairs, k, id_type))
    discard(spark, each_path)
    none = spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long")
    return reduce(DataFrame.union, found) if found else none
