"""Data-quality checks. All checks of a table compile into one aggregate over one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import Contract

class QualityGateFailed(RuntimeError):
    pass


def _long(counted: DataFrame, names: Sequence[str], label: str, value: str) -> DataFrame:
    return counted.unpivot([], [F.col(n) for n in names], label, value)


def currency_tags(df: DataFrame, table: str, money: Sequence[tuple[str, str]]) -> DataFrame:
    """DQ-01: values without a currency tag, per monetary column; a missing tag column counts every value."""
    checks = []
    for amount, tag in money:
        untagged = F.col(tag).isNull() if tag in df.columns else F.lit(True)
        checks.append(F.count_if(F.col(amount).isNotNull() & untagged).alias(amount))
    return _long(df.agg(*checks), [m for m, _ in money], "money_column", "untagged").select(
        F.lit(table).alias("table_name"), "money_column", "untagged"
    )


def require_currency_tags(checked: DataFrame) -> None:
    """Block the Gold build when any monetary value has no tag; the check table has one row per column."""
    failed = checked.where("untagged > 0").collect()
    if failed:
        raise QualityGateFailed("; ".join(f"{r.table_name}.{r.money_column}: {r.untagged} untagged" for r in failed))


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """DQ-02: NULLs per contracted column."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _long(counted, columns, "column_name", "nulls").select(F.lit(table).alias("table_name"), "column_name", "nulls")


def unique(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """DQ-02: key values held by more than one row, and the rows beyond the first; NULL counts as a value."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    return repeated.agg(
        F.count("*").alias("duplicate_keys"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("surplus_rows")
    ).select(F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"), "duplicate_keys", "surplus_rows")


def held_to(df: DataFrame, table: str, contract: Contract) -> DataFrame:
    """DQ-02: one row per clause of a declared contract and the rows that break it.

    Rows are counted per key first, so NULLs and repeats come from one scan and one shuffle
    that combines on the map side.
    """
    clauses = [F.sum(f"_null_{c}").alias(f"not_null:{c}") for c in contract.required]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in contract.required]
    if contract.key:
        rows = df.groupBy(*contract.key).agg(F.count("*").alias("_n"), *nulls)
        clauses.append(F.sum(F.col("_n") - 1).alias("unique:" + ",".join(contract.key)))
    else:
        rows = df.agg(*nulls)
    counted = rows.agg(*clauses)
    names = [F.coalesce(F.col(f"`{c}`"), F.lit(0).cast("bigint")).alias(c) for c in counted.columns]
    checked = counted.select(*names)
    return checked.unpivot([], [F.col(f"`{c}`") for c in checked.columns], "clause", "broken_rows").select(
        F.lit(table).alias("table_name"), "clause", "broken_rows"
    )


def require_contracts(checked: DataFrame) -> None:
    """Block the build when a contract is broken; the check table has one row per clause."""
    failed = checked.where("broken_rows > 0").collect()
    if failed:
        raise QualityGateFailed("; ".join(f"{r.table_name} {r.clause}: {r.broken_rows} rows" for r in failed))


def reconcile(counts: DataFrame) -> DataFrame:
    """DQ-03: rows may only shrink from one layer to the next."""
    return counts.withColumn(
        "reconciled",
        F.coalesce(F.col("silver_row_count") <= F.col("bronze_row_count"), F.lit(False)),
    )


def null_rate(
    df: DataFrame, table: str, columns: Sequence[str], warn: float, block: float, scope: Column | None = None
) -> DataFrame:
    """DQ-04 / DQ-05: NULL share per column with a verdict; ``scope`` leaves rows out of the check."""
    rows = df if scope is None else df.where(scope)
    rates = rows.agg(*[F.round(F.avg(F.col(c).isNull().cast("double")), 9).alias(c) for c in columns])
    verdict = F.when(F.col("null_rate") > block, "BLOCK").when(F.col("null_rate") > warn, "WARN").otherwise("OK")
    return _long(rates, columns, "column_name", "null_rate").select(
        F.lit(table).alias("table_name"), "column_name", "null_rate", verdict.alias("verdict")
    )


def balance_reconcile(df: DataFrame, kind: str, before: str, signed_amount: Column, after: str) -> DataFrame:
    """DQ-06: rows where before + amount is not after, per type; reported, never repaired."""
    off = (F.col(before) + signed_amount) != F.col(after)
    return df.groupBy(kind).agg(F.count("*").alias("rows_checked"), F.count_if(off).alias("mismatches"))


def encoding(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """DQ-07: values that are not valid UTF-8 or carry the replacement character."""
    bad = [
        F.count_if(~F.is_valid_utf8(F.col(c)) | F.contains(F.col(c), F.lit("�"))).alias(c) for c in columns
    ]
    counted = df.agg(F.count("*").alias("_rows"), *bad)
    return counted.unpivot(["_rows"], [F.col(c) for c in columns], "column_name", "bad_values").select(
        "column_name", F.col("_rows").alias("rows_checked"), "bad_values"
    )


def linkage_coverage(customers: DataFrame, linked: DataFrame, key: str = "customer_id") -> DataFrame:
    """DQ-08: share of customers with at least one linked row."""
    found = linked.select(key).distinct().withColumn("_hit", F.lit(1))
    return customers.join(found, key, "left").agg(
        F.count("*").alias("customers"),
        F.count("_hit").alias("linked"),
        F.round(F.avg(F.coalesce(F.col("_hit"), F.lit(0)).cast("double")), 9).alias("coverage"),
    )


def disagreement(df: DataFrame, left: Column, right: Column) -> DataFrame:
    """DQ-09: how often two independent signals differ where both are known."""
    both = df.where(left.isNotNull() & right.isNotNull())
    return both.agg(
        F.count("*").alias("compared"),
        F.count_if(left != right).alias("disagreements"),
        F.round(F.avg((left != right).cast("double")), 9).alias("disagreement_rate"),
    )


def unknown_growth(per_run: DataFrame, run: str, scope: str, unknown: str) -> DataFrame:
    """DQ-10: unknown-member count against the previous run of the same scope."""
    from pyspark.sql import Window

    previous = F.lag(unknown).over(Window.partitionBy(scope).orderBy(run))
    return per_run.withColumn("previous_unknown", previous).withColumn(
        "verdict", F.when(F.col(unknown) > F.col("previous_unknown"), "WARN").otherwise("OK")
    )


def grain(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """DQ-11: rows against distinct keys; a ratio above 1 is a fan-out."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return per_key.agg(F.sum("_n").alias("row_count"), F.count("*").alias("key_count")).select(
        F.lit(table).alias("table_name"),
        "row_count",
        "key_count",
        F.round(F.try_divide(F.col("row_count").cast("double"), F.col("key_count")), 9).alias("fan_out"),
    )


def no_raw_identifier(serving: DataFrame, table: str, columns: Sequence[str], raw: DataFrame, raw_key: str) -> DataFrame:
    """DQ-12: how many distinct values of each text column equal a raw identifier; must all be 0."""
    values = serving.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])).alias("x")
    ).select("x.*").where("v is not null").distinct()
    keys = raw.select(F.col(raw_key).cast("string").alias("v")).distinct().withColumn("_leak", F.lit(1))
    return (
        values.join(keys, "v", "left")
        .groupBy("column_name")
        .agg(F.count("_leak").alias("leaked_values"))
        .select(F.lit(table).alias("table_name"), "column_name", "leaked_values")
    )


def suffix_leaks(serving: DataFrame, table: str, columns: Sequence[str], raw: DataFrame, raw_key: str, shown: int = 4) -> DataFrame:
    """DQ-12: values of masked columns that are longer than the mask allows and end as a raw identifier does.

    A masked column shows the last ``shown`` characters at most. A longer value whose last
    characters are those of some raw identifier, itself longer, gives more of it away. Only distinct suffixes are compared.
    """
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])).alias("x")
    long = serving.select(each).select("x.*").where(F.length("v") > shown).distinct()
    key = F.col(raw_key).cast("string")
    # Of a raw key every ending longer than the mask is listed; keys are short.
    endings = raw.select(key.alias("k")).where(F.length("k") > shown).distinct().select(
        F.explode(F.transform(F.sequence(F.lit(shown + 1), F.length("k")), lambda n: F.right(F.col("k"), n))).alias("v")
    ).distinct().withColumn("_leak", F.lit(1))
    found = long.join(endings, "v", "left").groupBy("column_name").agg(F.count("_leak").alias("leaked_values"))
    named = serving.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    return named.join(found, "column_name", "left").select(
        F.lit(table).alias("table_name"), "column_name", F.coalesce("leaked_values", F.lit(0)).alias("leaked_values")
    )
