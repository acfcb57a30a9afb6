"""Dimensions and facts (GLD-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import MONEY
from ..operators.identity import primary_owner, resolve_identity, resolve_identity_private, source_slice
from ..operators.scale import skew_safe_join
from ..schemas import FX_RATE

# The static rate table. A NULL rate marks a currency that is never converted.
FX_RATES = [
    ("MYR", "1.0000", "2026-07-05", "reporting currency"),
    ("CZK", "0.2050", "2026-07-05", "static illustrative rate"),
    ("EUR", "5.0000", "2026-07-05", "static illustrative rate"),
    ("unitless", None, "2026-07-05", "no real currency known, not convertible"),
]


def fx_rates(spark: SparkSession) -> DataFrame:
    """GLD-02: the one place a rate comes from.

    An inline table, not a parallelized list: the optimizer knows how small it is.
    """
    values = ", ".join(
        f"('{code}', {rate or 'null'}, date'{day}', '{note}')" for code, rate, day, note in FX_RATES
    )
    raw = spark.sql(f"select * from values {values} as t(currency_code, rate_to_myr, rate_as_of, note)")
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FX_RATE])


def dim_date(spark_range: DataFrame) -> DataFrame:
    """GLD-01: every day between the ``first_day`` and ``last_day`` of a one-row frame."""
    days = spark_range.select(F.explode(F.sequence("first_day", "last_day")).alias("date_key"))
    return days.select(
        "date_key",
        F.year("date_key").alias("year"),
        F.month("date_key").alias("month"),
        F.day("date_key").alias("day"),
        F.date_format("date_key", "MMMM").alias("month_name"),
        F.date_format("date_key", "EEEE").alias("day_of_week"),
    )


def to_reporting_currency(df: DataFrame, amount: str, currency: str, out: str, fx: DataFrame) -> DataFrame:
    """GLD-03: add the converted amount; unknown or NULL rates give NULL, the native amount stays.

    Few currencies share all rows, so a shuffle by currency would be badly skewed: the
    rates are broadcast after a check of their size, or joined with salted keys.
    """
    rates = fx.select(F.col("currency_code").alias("_code"), "rate_to_myr")
    return (
        skew_safe_join(df, rates, currency, "_code")
        .withColumn(out, (F.col(amount).cast(MONEY) * F.col("rate_to_myr")).cast("decimal(28,6)"))
        .drop("rate_to_myr")
    )


def latest_balance(trans: DataFrame, fx: DataFrame) -> DataFrame:
    """GLD-04 / GLD-11: balance after the last transaction of each account, native and converted."""
    last = F.max_by(F.struct("balance", "currency"), F.struct("date", "trans_id")).alias("_last")
    latest = trans.groupBy("account_id").agg(last).select(
        "account_id", F.col("_last.balance").alias("current_balance"), F.col("_last.currency").alias("currency")
    )
    return to_reporting_currency(latest, "current_balance", "currency", "current_balance_myr", fx)


def dim_campaign_response(campaign: DataFrame) -> DataFrame:
    """GLD-05."""
    return campaign.select(
        "customer_id", "job", "marital", "education", "credit_in_default",
        "avg_yearly_balance", "prior_campaign_outcome", "subscribed_term_deposit",
    )


def with_period(df: DataFrame) -> DataFrame:
    return df.withColumns({"txn_year": F.year("txn_ts"), "txn_month": F.month("txn_ts")})


def fact_txn(
    card: DataFrame, card_bronze: DataFrame, trans: DataFrame, disp: DataFrame, xwalk: DataFrame, fx: DataFrame, **skew
) -> DataFrame:
    """GLD-06: card and account transactions, one row each, in one reporting currency.

    Owner and identity are resolved per account first, so the account transactions are
    joined once, to a side with one row per account.
    """
    cards = resolve_identity_private(card, card_bronze, "txn_id", "nameOrig", xwalk, "paysim", **skew).select(
        "txn_id", "customer_id", "txn_ts", "txn_type", "amount", "currency", "is_fraud", F.lit("paysim").alias("source_system")
    )
    owners = resolve_identity(primary_owner(disp), xwalk, "berka", "client_id", **skew).select("account_id", "customer_id")
    accounts = skew_safe_join(trans, owners.withColumnRenamed("account_id", "_account"), "account_id", "_account", **skew).select(
        F.col("trans_id").alias("txn_id"), "customer_id", F.col("date").alias("txn_ts"), F.col("type").alias("txn_type"),
        "amount", "currency", F.lit(False).alias("is_fraud"), F.lit("berka").alias("source_system"),
    )
    fact = to_reporting_currency(cards.unionByName(accounts), "amount", "currency", "amount_myr", fx)
    return with_period(fact)


def fact_card_fraud(card: DataFrame, card_bronze: DataFrame, xwalk: DataFrame, fx: DataFrame, **skew) -> DataFrame:
    """GLD-07: fraud rows only, by the fraud label; the rule-engine flag plays no part."""
    fraud = card.where("is_fraud").select("txn_id", "txn_ts", "txn_type", "amount", "currency")
    resolved = resolve_identity_private(fraud, card_bronze, "txn_id", "nameOrig", xwalk, "paysim", **skew)
    return with_period(to_reporting_currency(resolved, "amount", "currency", "amount_myr", fx)).select(
        "txn_id", "customer_id", "txn_ts", "txn_type", "amount", "currency", "amount_myr", "txn_year", "txn_month"
    )


def fraud_of_transactions(txns: DataFrame) -> DataFrame:
    """GLD-07 from the transaction fact, which has resolved the customers of all cards already."""
    return txns.where("source_system = 'paysim' and is_fraud").select(
        "txn_id", "customer_id", "txn_ts", "txn_type", "amount", "currency", "amount_myr", "txn_year", "txn_month"
    )


def fact_loan_application(application: DataFrame, xwalk: DataFrame, **skew) -> DataFrame:
    """GLD-08."""
    return resolve_identity(application, xwalk, "home_credit", "sk_id_curr", **skew).select(
        "customer_id", "sk_id_curr", "target", "amt_income_total", "name_income_type", "created_at"
    )


def fact_previous_application(previous: DataFrame, xwalk: DataFrame, **skew) -> DataFrame:
    """GLD-09."""
    return resolve_identity(previous, xwalk, "home_credit", "sk_id_curr", **skew).select(
        "sk_id_prev", "customer_id", "sk_id_curr", "name_contract_status", "days_decision"
    )


def fact_crm_case(cases: DataFrame, xwalk: DataFrame, **skew) -> DataFrame:
    """GLD-10."""
    return resolve_identity(cases, xwalk, "berka", "client_id", **skew).select("case_id", "customer_id", "case_type", "opened_at")


def bridge_customer_account(disp: DataFrame, xwalk: DataFrame, **skew) -> DataFrame:
    """IDN-08: N:N bridge with the kind of relation."""
    return resolve_identity(disp, xwalk, "berka", "client_id", **skew).select(
        "customer_id", "account_id", F.col("type").alias("relation_type")
    )


def installment_behavior(installments: DataFrame) -> DataFrame:
    """GLD-12 part: an unpaid instalment is late and underpaid; lateness averages the paid-late rows only."""
    late_by = F.col("days_entry_payment") - F.col("days_instalment")
    is_late = F.col("days_entry_payment").isNull() | (late_by > 0)
    underpaid = F.col("amt_payment").isNull() | (F.col("amt_payment") < F.col("amt_instalment"))
    return installments.groupBy("sk_id_curr").agg(
        F.count("*").alias("installment_count"),
        F.round(F.avg(is_late.cast("double")), 9).alias("late_payment_rate"),
        F.round(F.avg(underpaid.cast("double")), 9).alias("underpayment_rate"),
        F.round(F.avg(F.when(late_by > 0, late_by)), 9).alias("avg_days_late"),
    )


def card_utilization(balances: DataFrame) -> DataFrame:
    """GLD-12 part: zero limit gives NULL, a credit balance gives 0, over the limit stays above 1."""
    used = F.try_divide(F.col("amt_balance").cast("double"), F.col("amt_credit_limit_actual").cast("double"))
    # Fixed-point terms: the average no longer depends on the order rows arrive in.
    clamped = F.when(used < 0, F.lit(0.0)).otherwise(used).cast("decimal(28,12)")
    return balances.groupBy("sk_id_curr").agg(
        F.count_if(F.col("sk_dpd") > 0).alias("cc_months_dpd"),
        F.round(F.try_divide(F.sum(clamped).cast("double"), F.count(clamped).cast("double")), 9).alias("cc_avg_utilization"),
        F.max("sk_dpd").cast("bigint").alias("cc_max_dpd"),
    )


def pos_dpd(balances: DataFrame) -> DataFrame:
    """GLD-12 part."""
    return balances.groupBy("sk_id_curr").agg(
        F.count_if(F.col("sk_dpd") > 0).alias("pos_months_dpd"), F.max("sk_dpd").cast("bigint").alias("pos_max_dpd")
    )


def fact_repayment_behavior(
    installments: DataFrame, card_balances: DataFrame, pos_balances: DataFrame, xwalk: DataFrame
) -> DataFrame:
    """GLD-12: three independent customer aggregates side by side.

    Every source is reduced to one row per loan customer before any join, so nothing can
    fan out and every join side has unique keys.
    """
    combined = (
        installment_behavior(installments)
        .join(card_utilization(card_balances), "sk_id_curr", "full")
        .join(pos_dpd(pos_balances), "sk_id_curr", "full")
    )
    # greatest() skips NULLs: NULL only when both sides are NULL.
    worst = combined.withColumn("max_dpd", F.greatest("cc_max_dpd", "pos_max_dpd"))
    keys = source_slice(xwalk, "home_credit").withColumnRenamed("native_key", "sk_id_curr")
    return worst.join(keys, "sk_id_curr").select(
        "customer_id", "installment_count", "late_payment_rate", "underpayment_rate", "avg_days_late",
        "cc_months_dpd", "cc_avg_utilization", "pos_months_dpd", "max_dpd",
    )
