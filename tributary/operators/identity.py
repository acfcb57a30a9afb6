"""Identity resolution: crosswalk, lookup, golden record, linkage, erasure."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import hash_number, salted
from .scale import distributed_rank, latest_per_key, skew_safe_join

UNKNOWN_MEMBER = "-1"


@dataclass(frozen=True)
class KeySource:
    """One source system's native keys and how they enter the identity space."""

    name: str
    keys: DataFrame
    column: str
    priority: int
    prefix: str
    overlap: float = 0.0


def build_crosswalk(sources: Sequence[KeySource]) -> DataFrame:
    """IDN-01: ``(customer_id, source_system, native_key, source_priority_rank)``.

    The first source mints one customer per key. In every later one, a key whose hash
    falls under ``overlap`` is mapped onto a customer of the earlier sources, the others
    mint their own. The pick is the customer at a hashed position in a distributed rank of
    the pool, so the outcome depends on the keys alone and nothing passes one task.
    """
    rows, pool = None, None
    for source in sources:
        keys = source.keys.select(F.col(source.column).cast("string").alias("native_key")).where("native_key is not null").distinct()
        minted_id = F.concat(F.lit(source.prefix), F.col("native_key"))
        if pool is None or source.overlap <= 0:
            mapped = keys.select(minted_id.alias("customer_id"), "native_key")
            minted = mapped.select("customer_id")
        else:
            share = hash_number(salted(f"overlap:{source.name}", F.col("native_key")), 8)
            taken = share < int(source.overlap * 16**8)
            size = pool.agg(F.count("*")).scalar()
            position = hash_number(salted(f"pick:{source.name}", F.col("native_key")), 15)
            # One frame for both kinds of keys, so the source is read once; positions below 1 meet nobody and spread like hashes.
            placed = keys.withColumn("_pos", F.when(taken, position % size + 1).otherwise(-position))
            ranked = distributed_rank(pool.withColumnRenamed("customer_id", "_picked"), "_picked", f"pool:{source.name}", "_pos")
            owner = F.coalesce(F.col("_picked"), F.when(F.col("_pos") < 1, minted_id))
            mapped = placed.join(ranked, "_pos", "left").select(owner.alias("customer_id"), "native_key").where("customer_id is not null")
            minted = keys.where(~taken).select(minted_id.alias("customer_id"))
        tagged = mapped.select(
            "customer_id",
            F.lit(source.name).alias("source_system"),
            "native_key",
            F.lit(source.priority).alias("source_priority_rank"),
        )
        rows = tagged if rows is None else rows.unionByName(tagged)
        pool = minted if pool is None else pool.unionByName(minted)
    return rows


def customer_identifiers(df: DataFrame, columns: Sequence[str], prefix: str = "C") -> DataFrame:
    """IDN-02: distinct identifiers with the customer prefix over several columns."""
    ids = F.explode(F.array(*[F.col(c) for c in columns])).alias("name_id")
    return df.select(ids).where(F.col("name_id").startswith(prefix)).distinct()


def crosswalk_summary(xwalk: DataFrame) -> DataFrame:
    """IDN-03: rows per source, customers, customers present in more than one source."""
    rows = xwalk.groupBy(F.concat(F.lit("rows:"), F.col("source_system")).alias("metric")).agg(F.count("*").alias("value"))
    per_customer = (
        xwalk.groupBy("customer_id", "source_system").count().groupBy("customer_id").agg(F.count("*").alias("n_sources"))
    )
    totals = per_customer.agg(
        F.count("*").alias("customers"), F.count_if(F.col("n_sources") > 1).alias("multi_source_customers")
    ).unpivot([], ["customers", "multi_source_customers"], "metric", "value")
    return rows.unionByName(totals)


def source_slice(xwalk: DataFrame, source: str) -> DataFrame:
    return xwalk.where(F.col("source_system") == source).select("native_key", "customer_id")


def resolve_identity(df: DataFrame, xwalk: DataFrame, source: str, key: str, **skew) -> DataFrame:
    """IDN-04: add ``customer_id`` for one source's native key; unresolved rows keep NULL."""
    native = df.withColumn("_native", F.col(key).cast("string"))
    return skew_safe_join(native, source_slice(xwalk, source), "_native", "native_key", **skew).drop("_native")


def resolve_identity_private(
    masked: DataFrame, raw: DataFrame, row_id: str, raw_key: str, xwalk: DataFrame, source: str, **skew
) -> DataFrame:
    """IDN-05: resolve rows whose key is masked, through the raw table's key by row id.

    The raw table may hold redelivered copies of a row; they are collapsed first so the
    result keeps the masked table's grain. The raw key is not in the result.
    """
    lookup = raw.groupBy(F.col(row_id).alias("_row")).agg(F.max(raw_key).alias("_raw"))
    keyed = masked.join(lookup, F.col(row_id) == F.col("_row"), "left").drop("_row")
    return resolve_identity(keyed, xwalk, source, "_raw", weights=(raw, raw_key), **skew).drop("_raw")


def primary_owner(disp: DataFrame, relation: str = "OWNER") -> DataFrame:
    """IDN-06: exactly one client per account, so joining it never fans out."""
    return disp.where(F.col("type") == relation).groupBy("account_id").agg(F.min("client_id").alias("client_id"))


def survivorship(xwalk: DataFrame, candidates: Sequence[DataFrame]) -> DataFrame:
    """IDN-07: one golden record per customer.

    Candidates carry ``customer_id, source_priority_rank, native_key`` and whatever
    attributes their source has. Lowest rank wins, then the latest ``updated_at``, then
    the native key. Every customer of the crosswalk is kept.
    """
    pool = candidates[0]
    for other in candidates[1:]:
        pool = pool.unionByName(other, allowMissingColumns=True)
    order = [
        F.col("source_priority_rank").asc(),
        F.col("updated_at").desc_nulls_last(),
        F.col("native_key").asc(),
    ]
    golden = latest_per_key(pool, ["customer_id"], order)
    return xwalk.select("customer_id").distinct().join(golden, "customer_id", "left")


def link_without_replacement(population: DataFrame, key: str, customers: DataFrame) -> DataFrame:
    """IDN-09: give each row of a keyless population its own customer.

    Both sides get a position in a hash order; equal positions meet. The link is 1:1 and
    covers exactly the smaller side.
    """
    people = distributed_rank(population, key, "linkage:population", "_pos")
    owners = distributed_rank(customers.select("customer_id"), "customer_id", "linkage:customers", "_pos")
    return people.join(owners, "_pos").drop("_pos")


def unknown_member(df: DataFrame) -> DataFrame:
    """IDN-10: unresolved dimension keys point at the unknown member."""
    return df.withColumn("customer_id", F.coalesce(F.col("customer_id"), F.lit(UNKNOWN_MEMBER)))


def relink_unknown(df: DataFrame, xwalk: DataFrame, source: str, key: str) -> DataFrame:
    """IDN-10: retry rows of the unknown member, or of none, against a newer crosswalk; known rows pass untouched."""
    unresolved = F.coalesce(F.col("customer_id") == UNKNOWN_MEMBER, F.lit(True))
    known = df.where(~unresolved)
    waiting = df.where(unresolved).drop("customer_id")
    return known.unionByName(unknown_member(resolve_identity(waiting, xwalk, source, key)).select(*df.columns))


def erase_customers(table: DataFrame, erased: DataFrame, **skew) -> DataFrame:
    """IDN-11: the table without the given customers; unresolved rows stay.

    An outer join with a flag instead of an anti join: it can spread NULL and hot customers.
    """
    gone = erased.select(F.col("customer_id").alias("_gone_id")).distinct().withColumn("_gone", F.lit(True))
    return skew_safe_join(table, gone, "customer_id", "_gone_id", **skew).where(F.col("_gone").isNull()).drop("_gone")


def primary_link(disp: DataFrame) -> tuple[DataFrame, DataFrame]:
    """PRP-08: (one primary account per client, the remaining links). Owners are preferred."""
    order = Window.partitionBy("client_id").orderBy((F.col("type") == "OWNER").desc(), F.col("account_id"))
    ranked = disp.withColumn("_rank", F.row_number().over(order))
    return ranked.where("_rank = 1").drop("_rank"), ranked.where("_rank > 1").drop("_rank")
