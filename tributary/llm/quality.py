"""Quality classifier: a byte-level convolutional network.

A document is cut into overlapping chunks of bytes that cover all of it. Learned filters run over every chunk, each
filter's strongest answer in the chunk is kept, a small hidden layer reads those, and the mean and maximum of the
hidden units over the document's chunks give one probability. Only the bytes of the text are read.

Training runs in numpy on a sample whose size is bounded by parameters; scoring runs on executors in Arrow batches.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_arrow, free_names, give_back, text_bytes, text_or_empty

CHUNK, STRIDE, WIDTH = 512, 480, 6
FILTERS, EMBEDDING, HIDDEN = 16, 8, 16
BLOCK = 512
UPDATES = 500
MAX_TRAIN_ROWS, MAX_TRAIN_BYTES = 4000, 32 * 1024 * 1024
THRESHOLD = 0.7


class Network(NamedTuple):
    """Weights; ``constant`` replaces them when there was nothing to learn from."""

    weights: dict[str, np.ndarray] | None
    constant: float = 1.0


def chunk_starts(length: int) -> np.ndarray:
    """Where the chunks begin; the last one reaches the end of the text."""
    return np.arange(max(1, -(-(length - (CHUNK - STRIDE)) // STRIDE))) * STRIDE


def chunk_matrix(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One row of bytes for each chunk; zero past the end of its document."""
    at = starts[:, None] + np.arange(CHUNK + WIDTH - 1)
    inside = at < ends[:, None]
    return np.where(inside, data[np.where(inside, at, 0)] if len(data) else 0, 0).astype(np.uint8)


def filter_tables(w: dict[str, np.ndarray]) -> np.ndarray:
    """What each byte adds to each filter at each offset in it."""
    return np.einsum("bd,wdk->wbk", w["embedding"], w["filters"]).astype(np.float32)


def pair_tables(tables: np.ndarray) -> list[np.ndarray]:
    """The same for two neighbouring bytes at once: half as many lookups."""
    k = tables.shape[2]
    return [(tables[j][:, None, :] + tables[j + 1][None, :, :]).reshape(-1, k) for j in range(0, WIDTH, 2)]


def convolve(chunks: np.ndarray, pairs: list[np.ndarray]) -> np.ndarray:
    both = chunks[:, :-1].astype(np.int32) * 256 + chunks[:, 1:]
    answer = pairs[0][both[:, :CHUNK]]
    for j in range(1, len(pairs)):
        answer += pairs[j][both[:, 2 * j : 2 * j + CHUNK]]
    return answer


def strongest(chunks: np.ndarray, pairs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Where each filter answers most strongly in each chunk, and that answer."""
    answer = convolve(chunks, pairs)
    where = answer.argmax(axis=1)
    return where, np.take_along_axis(answer, where[:, None, :], axis=1)[:, 0]


def fill(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The share of each chunk that holds text."""
    return (np.minimum(ends - starts, CHUNK) / CHUNK).astype(np.float32)[:, None]


def head(w: dict[str, np.ndarray], pooled: np.ndarray, filled: np.ndarray, first: np.ndarray):
    """Hidden units of the chunks, their mean and maximum in each document, and the logits."""
    seen = np.concatenate([np.maximum(pooled + w["bias"], 0), filled], axis=1)
    hidden = np.maximum(seen @ w["hidden"] + w["hidden_bias"], 0)
    count = np.diff(np.append(first, len(pooled)))[:, None]
    mean = np.add.reduceat(hidden, first, axis=0) / count
    most = np.maximum.reduceat(hidden, first, axis=0)
    return seen, hidden, count, most, np.concatenate([mean, most], axis=1) @ w["out"] + w["out_bias"]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(data, starts, ends, first, labels, weights, updates: int = UPDATES, batch: int = 64, rate: float = 4e-3, seed: int = 11) -> dict:
    """Adam on the weighted log loss, as many updates for any input.

    Chunks begin at ``starts`` in ``data``, their documents end at ``ends``; ``first`` is each document's first chunk.
    """
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[-2])).astype(np.float32)
    w = {
        "embedding": draw(256, EMBEDDING) * 4, "filters": draw(WIDTH, EMBEDDING, FILTERS), "bias": np.zeros(FILTERS, np.float32),
        "hidden": draw(FILTERS + 1, HIDDEN), "hidden_bias": np.full(HIDDEN, 0.1, np.float32),
        "out": draw(2 * HIDDEN, 1)[:, 0], "out_bias": np.zeros(1, np.float32),
    }
    m, v, step = {k: np.zeros_like(x) for k, x in w.items()}, {k: np.zeros_like(x) for k, x in w.items()}, 0
    last = np.append(first[1:], len(starts))
    while step < updates:
        order = rng.permutation(len(first))
        for at in range(0, len(order), batch):
            docs = order[at : at + batch]
            rows = np.concatenate([np.arange(first[d], last[d]) for d in docs])
            sizes = last[docs] - first[docs]
            own_first, of = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(docs)), sizes)
            x = chunk_matrix(data, starts[rows], ends[rows])
            pairs, cells = pair_tables(filter_tables(w)), range(0, len(x), BLOCK)
            best = [strongest(x[i : i + BLOCK], pairs) for i in cells]
            where, pooled = (np.concatenate(parts) for parts in zip(*best))
            seen, hidden, count, most, logit = head(w, pooled, fill(starts[rows], ends[rows]), own_first)
            d_logit = ((sigmoid(logit) - labels[docs]) * weights[docs] / len(docs)).astype(np.float32)
            mean = np.add.reduceat(hidden, own_first, axis=0) / count
            g = {"out": np.concatenate([mean, most], axis=1).T @ d_logit, "out_bias": d_logit.sum(keepdims=True)}
            d_mean, d_most = np.outer(d_logit, w["out"][:HIDDEN]) / count, np.outer(d_logit, w["out"][HIDDEN:])
            top = hidden == most[of]
            d_hidden = (d_mean[of] + d_most[of] * top / np.add.reduceat(top, own_first, axis=0, dtype=np.float32)[of]) * (hidden > 0)
            g["hidden"], g["hidden_bias"] = seen.T @ d_hidden, d_hidden.sum(axis=0)
            d_pooled = (d_hidden @ w["hidden"].T)[:, :FILTERS] * (seen[:, :FILTERS] > 0)
            g["bias"] = d_pooled.sum(axis=0)
            # Only the position where a filter answered most strongly learns.
            d_table = np.zeros((WIDTH, 256, FILTERS), np.float32)
            for j in range(WIDTH):
                np.add.at(d_table[j], (np.take_along_axis(x, where + j, axis=1), np.arange(FILTERS)[None, :]), d_pooled)
            g["embedding"] = np.einsum("wbk,wdk->bd", d_table, w["filters"])
            g["filters"] = np.einsum("bd,wbk->wdk", w["embedding"], d_table)
            step += 1
            for k in w:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                pace = rate * max(0.02, 1 - step / updates) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                w[k] = (w[k] - pace * m[k] / (np.sqrt(v[k]) + 1e-8)).astype(np.float32)
    return w


def labelled(labels: DataFrame) -> DataFrame:
    """``(_id, _label)`` for each doc_id whose label is 0 or 1 and not in dispute."""
    return (
        labels.where("quality in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").alias("_id"))
        .agg(F.min("quality").alias("_label"), F.max("quality").alias("_most"))
        .where("_label = _most").drop("_most")
    )


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS, max_bytes: int = MAX_TRAIN_BYTES, updates: int = UPDATES) -> Network:
    """Learn from at most ``max_rows`` labelled documents, as many of either label, and at most ``max_bytes`` of text.

    The documents are those with the smallest hash of their id, one row for an id that repeats (that with the smallest
    hash of its text), each with all chunks of its whole text; of either label as many as fit half the bytes, passing
    over single texts that are larger than that. Rows count by how frequent their label is among all of ``labels``, so
    scores are probabilities for the whole table. Without labels every score is 1; with one label only, or with documents
    of one label only, every score is the label (for the latter the more frequent one).
    """
    known = labelled(labels)
    share = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    if len(share) < 2:
        return Network(None, float(next(iter(share), 1)))
    half = max(1, max_rows // 2)
    picked = None
    for label in (0, 1):
        some = known.where(F.col("_label") == label).orderBy(F.xxhash64(F.lit(7), "_id"), "_id").limit(half)
        picked = some if picked is None else picked.union(some)
    # At most max_rows ids, so they fit any broadcast; the texts do not move before that.
    texts = docs.select(F.col("doc_id").alias("_doc"), text_or_empty().alias("_text")).join(F.broadcast(picked), F.col("_doc") == F.col("_id"))
    fitting = texts.where(F.octet_length("_text") <= max_bytes // 2)
    one = fitting.groupBy("_id", "_label").agg(F.min_by("_text", F.struct(F.xxhash64("_text"), F.octet_length("_text"))).alias("_text"))
    so_far = Window.partitionBy("_label").orderBy(F.xxhash64(F.lit(7), "_id"), "_id").rowsBetween(Window.unboundedPreceding, 0)
    sample = one.withColumn("_bytes", F.sum(F.octet_length("_text")).over(so_far)).where(F.col("_bytes") <= max_bytes // 2)
    rows = sample.select("_id", "_label", F.encode("_text", "utf-8").alias("_text")).collect()
    rows.sort(key=lambda r: (r["_label"], r["_id"]))
    if len({r["_label"] for r in rows}) < 2:
        return Network(None, float(max(share, key=share.get)))
    y = np.array([r["_label"] for r in rows], np.float32)
    per_class = {c: share[c] / sum(share.values()) / (y == c).mean() for c in (0, 1)}
    lengths = np.array([len(r["_text"]) for r in rows])
    data = np.frombuffer(b"".join(r["_text"] for r in rows), np.uint8)
    begins = np.cumsum(lengths) - lengths
    of_each = [a + chunk_starts(n) for a, n in zip(begins, lengths)]
    sizes = np.array([len(c) for c in of_each])
    starts, ends = np.concatenate(of_each), np.repeat(begins + lengths, sizes)
    weights = train(data, starts, ends, np.cumsum(sizes) - sizes, y, np.where(y == 1, per_class[1], per_class[0]), updates)
    del rows, data
    give_back()  # the driver lives on through all later stages
    return Network(weights)


def score_texts(net: Network, column: pa.Array) -> np.ndarray:
    """The probability that each text is good; a null text counts as empty."""
    if net.weights is None:
        return np.full(len(column), net.constant)
    data, offsets = text_bytes(column)
    data, w = np.frombuffer(data, np.uint8), net.weights
    pairs = pair_tables(filter_tables(w))
    starts = [a + chunk_starts(b - a) for a, b in zip(offsets, offsets[1:])]
    ends = np.repeat(np.array(offsets[1:]), [len(s) for s in starts])
    first = np.cumsum([0] + [len(s) for s in starts[:-1]])
    starts = np.concatenate(starts)
    pooled = np.concatenate([
        convolve(chunk_matrix(data, starts[i : i + BLOCK], ends[i : i + BLOCK]), pairs).max(axis=1) for i in range(0, len(starts), BLOCK)
    ])
    return sigmoid(head(w, pooled, fill(starts, ends), first)[-1].astype(np.float64))


def score(docs: DataFrame, net: Network, out: str = "score") -> DataFrame:
    """``docs`` with one more column ``out``. Every row is scored, rows alike get the same score; nothing is shuffled.

    Null and empty texts are scored as an empty chunk. A column that is already called ``out`` is replaced.
    """
    rest = docs.drop(out)
    schema = rest.select("*", F.lit(0.0).alias(out)).schema
    shared = docs.sparkSession.sparkContext.broadcast(tuple(net))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(score_texts(Network(*shared.value), batch["text"]))], [*batch.schema.names, out])

    return by_arrow(rest, schema, work)


def learnable(labels: DataFrame) -> DataFrame:
    """The labels that training may see: crc32 of the id as text, modulo 4, is not 2."""
    return labels.where(~held_out())


def held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def keep_good(docs: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score at least ``threshold``, with the columns they came with."""
    (name,) = free_names(docs, "quality_score")
    return score(docs, net, name).where(F.col(name) >= threshold).drop(name)
