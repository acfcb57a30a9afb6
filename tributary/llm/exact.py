"""Exact dedup by skew-safe combining, with DataFrame operations only.

Equal texts are counted in three steps, and every step groups on the digest *and* the whole text, so contents are
compared and a digest collision can never merge two texts:

1. each task combines its own rows (the map side of the first aggregation);
2. a salt taken from the row splits every digest into groups, which are merged per salt;
3. the salt winners of a digest, at most one for each salt and text, are combined into the final group.

A group of any size thus sends one row per task and salt. The verdicts go back to the documents on the digest alone
where that stands for one text, as step 3 has shown; documents of a digest that stands for several are matched on
their texts as well.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_hash, text_or_empty, written

SALTS = 8


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def groups(docs: DataFrame, digest: Callable[[Column], Column] = sha256_hex, salts: int = SALTS) -> DataFrame:
    """``(digest, text, keep_id, group_size)`` for each distinct text."""
    salt = F.pmod(F.xxhash64(F.lit(19), "doc_id"), F.lit(salts))
    rows = docs.select("doc_id", text_or_empty().alias("text")).select(digest(F.col("text")).alias("digest"), salt.alias("salt"), "text", "doc_id")
    merged = rows.groupBy("digest", "salt", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return merged.groupBy("digest", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def exact_duplicates(docs: DataFrame, digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, a row for each row of ``docs``.

    Null counts as the empty text. The largest doc_id of equal texts stays; a null doc_id stays only where the group has
    no other (``keep_id`` is null then). Of rows that repeat with the doc_id that stays, one is kept. Other columns are
    not read, whatever their names.
    """
    found = groups(docs, digest)
    contents = found.groupBy("digest").agg(F.count("*").alias("contents"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"))
    per_digest, _ = written(contents, "groups")
    own = docs.select("doc_id", digest(text_or_empty()).alias("digest"), F.monotonically_increasing_id().alias("tie"))
    rows, _ = written(own, "digests")
    plain = per_digest.where("contents = 1").drop("contents")
    verdicts = rows.join(plain, "digest").select("doc_id", "tie", F.col("digest").alias("group"), "digest", "keep_id", "group_size")
    shared = per_digest.where("contents > 1").select("digest")
    if not shared.isEmpty():
        verdicts = verdicts.union(contested(docs, digest, shared))
    # A total order among the rows of a group, so one row is kept even where rows repeat.
    # It is written, so that the join below is free to split a hot group.
    best, _ = written(verdicts.groupBy(F.col("group").alias("of")).agg(F.max(F.struct("doc_id", "tie")).alias("best")), "best")
    return verdicts.join(best, F.col("group") == F.col("of")).select(
        "doc_id", "keep_id", "group_size", (F.struct("doc_id", "tie").eqNullSafe(F.col("best"))).alias("kept"), F.col("digest").alias("text_sha256")
    )


def contested(docs: DataFrame, digest: Callable[[Column], Column], shared: DataFrame) -> DataFrame:
    """Verdicts for documents whose digest stands for several texts: they meet on the text too."""
    rows = docs.select("doc_id", text_or_empty().alias("text")).select("doc_id", "text", digest(F.col("text")).alias("digest"))
    rows, _ = written(rows.join(shared, "digest", "left_semi").select("*", F.monotonically_increasing_id().alias("tie")), "contested")
    found, _ = written(groups(rows, digest).select("*", F.monotonically_increasing_id().alias("no")), "contested-groups")
    return rows.join(found, ["digest", "text"]).select(
        "doc_id", "tie", F.concat_ws(":", "digest", F.col("no").cast("string")).alias("group"), "digest", "keep_id", "group_size"
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without copies: of equal texts, one row of the largest doc_id stays, with all its columns.

    A null doc_id loses to any other. Among rows of one doc_id the largest row hash stays.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # max_by skips rows whose order is null; a struct never is.
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id").alias("id"), row_hash(docs).alias("mark"))
    merged = docs.select(text_or_empty().alias("content"), F.struct(order.alias("order"), F.struct(*columns).alias("row")).alias("candidate"))
    local = merged.select(sha256_hex(F.col("content")).alias("digest"), F.pmod(F.xxhash64(F.lit(19), "candidate.order"), F.lit(SALTS)).alias("salt"), "content", "candidate")
    salted = local.groupBy("digest", "salt", "content").agg(F.max_by("candidate", "candidate.order").alias("candidate"))
    final = salted.groupBy("digest", "content").agg(F.max_by("candidate", "candidate.order").alias("candidate"))
    return final.select("candidate.row.*")
