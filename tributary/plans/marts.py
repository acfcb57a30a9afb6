"""The marts: one per business question (MRT-*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_double, ratio
from ..operators.scale import exact_quantiles, skew_safe_join

ACTIVE_DAYS = 90
SLA_HOURS = 48
INFLOW_TYPES = ("CASH_IN", "DEPOSIT", "PRIJEM")
OUTCOME_RANK = {"success": 1, "unknown": 2, "failure": 3}


def customer_360(customers: DataFrame, txns: DataFrame, loans: DataFrame, campaign: DataFrame) -> DataFrame:
    """MRT-01: product mix and value per customer; every side is one row per customer before it is joined."""
    txn = txns.groupBy("customer_id").agg(F.count("*").alias("txn_count"), F.sum("amount_myr").alias("txn_value"))
    loan = loans.groupBy("customer_id").agg(F.count("*").alias("loan_count"))
    deposit = campaign.groupBy("customer_id").agg(
        F.max(F.coalesce(F.col("subscribed_term_deposit"), F.lit(False)).cast("bigint")).alias("has_term_deposit")
    )
    wide = (
        customers.select("customer_id")
        .join(txn, "customer_id", "left")
        .join(loan, "customer_id", "left")
        .join(deposit, "customer_id", "left")
        .fillna(0, ["txn_count", "loan_count", "has_term_deposit"])
    )
    held = (F.col("loan_count") > 0).cast("bigint") + (F.col("txn_count") > 0).cast("bigint") + F.col("has_term_deposit")
    return wide.select(
        "customer_id", "txn_count", "loan_count", "has_term_deposit",
        F.coalesce(as_double(F.col("txn_value")), F.lit(0.0)).alias("total_txn_value"),
        held.alias("product_count"),
    )


def fraud_daily(fraud: DataFrame) -> DataFrame:
    """MRT-02."""
    return fraud.groupBy(F.to_date("txn_ts").alias("txn_date"), "txn_type").agg(
        F.count("*").alias("fraud_txn_count"), as_double(F.sum("amount")).alias("fraud_txn_value")
    )


def fraud_mom(fraud: DataFrame) -> DataFrame:
    """MRT-02b: month against the previous calendar month, per type; months without fraud count as zero.

    A type that drops to zero has a row for the month after its last fraud, up to the last month of the table. The
    self-join is on an aggregate with one row per month and type.
    """
    month = F.trunc(F.col("txn_ts"), "MM")
    monthly = fraud.groupBy(month.alias("txn_month"), "txn_type").agg(
        F.count("*").alias("fraud_txn_count"), F.sum("amount").alias("_value")
    )
    prior = monthly.select(
        F.add_months("txn_month", 1).alias("txn_month"), "txn_type",
        F.col("fraud_txn_count").alias("prior_count"), F.col("_value").alias("_prior_value"),
    ).where(F.col("txn_month") <= monthly.agg(F.max("txn_month")).scalar())
    both = monthly.join(prior, ["txn_month", "txn_type"], "full").fillna(0, ["fraud_txn_count", "prior_count"])
    value, prior_value = F.coalesce(F.col("_value"), F.lit(0)), F.coalesce(F.col("_prior_value"), F.lit(0))
    return both.select(
        "txn_month", "txn_type", "fraud_txn_count", as_double(value).alias("fraud_txn_value"),
        "prior_count", as_double(prior_value).alias("prior_value"),
        (F.col("fraud_txn_count") - F.col("prior_count")).alias("count_delta"),
        as_double(value - prior_value).alias("value_delta"),
    )


def fraud_followup_events(fraud: DataFrame, cases: DataFrame) -> DataFrame:
    """MRT-03 per event: was the customer's first follow-up case opened within the window after it."""
    first = (
        cases.where("case_type = 'Fraud Follow-up' and customer_id is not null")
        .groupBy("customer_id").agg(F.min("opened_at").alias("crm_last_touched"))
    )
    deadline = F.col("txn_ts") + F.make_dt_interval(F.lit(0), F.lit(SLA_HOURS))
    within = F.col("crm_last_touched").between(F.col("txn_ts"), deadline)
    first = first.withColumnRenamed("customer_id", "_customer")
    return skew_safe_join(fraud, first, "customer_id", "_customer").select(
        "txn_id", "customer_id", "txn_ts", "crm_last_touched", F.coalesce(within, F.lit(False)).alias("within_sla")
    )


def fraud_followup(fraud: DataFrame, cases: DataFrame) -> DataFrame:
    """MRT-03 summary."""
    return fraud_followup_events(fraud, cases).agg(
        F.count("*").alias("fraud_event_count"), F.count_if("within_sla").alias("within_sla_count")
    ).withColumn("within_sla_pct", ratio(F.col("within_sla_count") * 100, F.col("fraud_event_count")))


def loan_funnel(loans: DataFrame, previous: DataFrame) -> DataFrame:
    """MRT-04: applications at their own grain; approval and lag from the customers' earlier loans.

    Earlier loans are reduced to one row per customer before they meet the applications.
    """
    month = F.date_format("created_at", "yyyy-MM")
    dated = loans.select("sk_id_curr", month.alias("app_month"))
    per_customer = previous.groupBy("sk_id_curr").agg(
        F.count("*").alias("_n"),
        F.count_if(F.col("name_contract_status") == "Approved").alias("_approved"),
        F.sum(F.abs("days_decision")).alias("_days"),
        F.count("days_decision").alias("_dated"),
    )
    return (
        dated.join(per_customer, "sk_id_curr", "left")
        .groupBy("app_month")
        .agg(
            F.count("*").alias("application_count"),
            ratio(F.sum("_approved") * 100, F.sum("_n")).alias("approval_rate_pct"),
            ratio(F.sum("_days"), F.sum("_dated")).alias("avg_days_to_decision"),
        )
    )


def segment_thresholds(loans: DataFrame, balances: DataFrame) -> DataFrame:
    """MRT-14: the percentiles that define income bands and a healthy balance."""
    income = exact_quantiles(loans, "amt_income_total", {"income_p25": 0.25, "income_p75": 0.75})
    deposit = exact_quantiles(balances, "current_balance_myr", {"balance_p50": 0.5})
    return income.select(
        "income_p25", "income_p75", F.lit(deposit.select("balance_p50").scalar()).alias("balance_p50")
    )


def threshold(thresholds: DataFrame, name: str) -> Column:
    """One frozen threshold as a scalar subquery; it is never collected."""
    return thresholds.agg(F.max(name)).scalar()


def with_income_band(loans: DataFrame, thresholds: DataFrame) -> DataFrame:
    income = F.col("amt_income_total")
    band = (
        F.when(income < threshold(thresholds, "income_p25"), "LOW")
        .when(income > threshold(thresholds, "income_p75"), "HIGH")
        .otherwise("MEDIUM")
    )
    return loans.withColumn("income_band", band)


def risk_segment(loans: DataFrame, campaign: DataFrame, thresholds: DataFrame) -> DataFrame:
    """MRT-05: defaults, and disagreement of the two default signals, per customer and band."""
    signal = campaign.groupBy("customer_id").agg(F.max("credit_in_default").alias("credit_in_default"))
    differs = F.col("target").cast("int") != F.col("credit_in_default").cast("int")
    return (
        with_income_band(loans, thresholds)
        .join(signal, "customer_id", "left")
        .groupBy("customer_id", "income_band", "name_income_type")
        .agg(F.count_if(F.col("target") == 1).alias("is_default"), F.count_if(differs).alias("default_signal_disagreement"))
    )


def default_rate_by_segment(loans: DataFrame, thresholds: DataFrame) -> DataFrame:
    """MRT-05b."""
    return with_income_band(loans, thresholds).groupBy("income_band", "name_income_type").agg(
        F.count("*").alias("applications"), F.round(F.avg(F.col("target").cast("double")), 9).alias("default_rate")
    )


def last_activity(txns: DataFrame) -> DataFrame:
    """Newest transaction per resolved customer; combines on the map side."""
    return txns.where("customer_id is not null").groupBy("customer_id").agg(F.max("txn_ts").alias("last_txn_ts"))


def days_idle(as_of: str) -> Column:
    return F.date_diff(F.lit(as_of).cast("date"), F.col("last_txn_ts").cast("date")).cast("bigint")


def active_high_risk(loans: DataFrame, txns: DataFrame, thresholds: DataFrame, as_of: str) -> DataFrame:
    """MRT-05b: defaulting customers with a transaction in the active window."""
    active = last_activity(txns).where(days_idle(as_of).between(0, ACTIVE_DAYS - 1))
    return (
        with_income_band(loans, thresholds).where("target = 1 and customer_id is not null")
        .join(active, "customer_id")
        .select("customer_id", "sk_id_curr", "income_band", "name_income_type", "last_txn_ts")
    )


def cross_sell(
    customers: DataFrame, txns: DataFrame, loans: DataFrame, bridge: DataFrame, balances: DataFrame,
    campaign: DataFrame, thresholds: DataFrame,
) -> DataFrame:
    """MRT-06: customers with a healthy deposit and neither loan nor card; one row per qualifying account.

    The threshold and the two absences cut the accounts down before activity and campaign join.
    """
    healthy = balances.where(F.col("current_balance_myr") >= threshold(thresholds, "balance_p50"))
    deposits = (
        skew_safe_join(
            bridge.where("customer_id is not null"),
            healthy.select(F.col("account_id").alias("_account"), "current_balance_myr"),
            "account_id", "_account", "inner",
        )
        .join(customers.select("customer_id"), "customer_id", "left_semi")
    )
    # One pass over the fact: who holds a card, and when a customer was last seen.
    card = F.col("source_system") == "paysim"
    seen = txns.where("customer_id is not null").groupBy("customer_id").agg(F.max("txn_ts").alias("last_txn_ts"), F.bool_or(card).alias("_card"))
    targets = deposits.join(loans.select("customer_id"), "customer_id", "left_anti")
    response = campaign.select("customer_id", "prior_campaign_outcome", "subscribed_term_deposit")
    return (
        targets.join(seen, "customer_id", "left")
        .where(~F.coalesce("_card", F.lit(False)))
        .join(response, "customer_id", "left")
        .select(
            "customer_id", "account_id", as_double(F.col("current_balance_myr"), 6).alias("current_balance"), "last_txn_ts",
            "prior_campaign_outcome", "subscribed_term_deposit",
        )
    )


def cross_sell_ranked(targets: DataFrame, as_of: str) -> DataFrame:
    """MRT-06b: all active targets, best earlier response first, then the larger balance. Callers limit."""
    outcome = F.coalesce(
        *[F.when(F.col("prior_campaign_outcome") == name, F.lit(rank)) for name, rank in OUTCOME_RANK.items()], F.lit(4)
    )
    order = ["response_rank", F.col("current_balance").desc(), "customer_id", "account_id"]
    return (
        targets.where(days_idle(as_of).between(0, ACTIVE_DAYS - 1))
        .withColumn("response_rank", outcome)
        .orderBy(*order)
    )


def dormancy(customers: DataFrame, txns: DataFrame, as_of: str) -> DataFrame:
    """MRT-07: no transaction ever, or none for the whole window."""
    idle = days_idle(as_of)
    return (
        customers.select("customer_id")
        .join(last_activity(txns), "customer_id", "left")
        .withColumn("days_since_last_txn", idle)
        .where(F.col("last_txn_ts").isNull() | (F.col("days_since_last_txn") >= ACTIVE_DAYS))
        .select("customer_id", F.lit(as_of[:7]).alias("as_of_month"), "last_txn_ts", "days_since_last_txn")
    )


def total_deposits(balances: DataFrame) -> Column:
    return balances.agg(as_double(F.coalesce(F.sum("current_balance_myr"), F.lit(0)))).scalar()


def daily_flows(txns: DataFrame, balances: DataFrame) -> DataFrame:
    """MRT-08: money in, out and net per day; a day without one direction has 0 there."""
    inflow = F.col("txn_type").isin(*INFLOW_TYPES)
    flows = txns.groupBy(F.to_date("txn_ts").alias("txn_date")).agg(
        F.coalesce(F.sum(F.when(inflow, F.col("amount_myr"))), F.lit(0)).alias("_in"),
        F.coalesce(F.sum(F.when(~inflow, F.col("amount_myr"))), F.lit(0)).alias("_out"),
    )
    return flows.select(
        "txn_date", as_double(F.col("_in")).alias("total_in"), as_double(F.col("_out")).alias("total_out"),
        as_double(F.col("_in") - F.col("_out")).alias("net_flow"), total_deposits(balances).alias("total_deposits_snapshot"),
    )


def daily_flows_pivot(txns: DataFrame) -> DataFrame:
    """MRT-08, pivot form: a missing direction is NULL in its column and 0 in the net."""
    direction = F.when(F.col("txn_type").isin(*INFLOW_TYPES), "in").otherwise("out")
    flows = (
        txns.withColumn("direction", direction)
        .groupBy(F.to_date("txn_ts").alias("txn_date"))
        .pivot("direction", ["in", "out"])
        .agg(F.sum("amount_myr"))
    )
    net = F.coalesce(F.col("in"), F.lit(0)) - F.coalesce(F.col("out"), F.lit(0))
    return flows.select(
        "txn_date", as_double(F.col("in")).alias("total_in"), as_double(F.col("out")).alias("total_out"), as_double(net).alias("net_flow")
    )


def spending_distribution(txns: DataFrame, loans: DataFrame, thresholds: DataFrame) -> DataFrame:
    """MRT-09: spending by type, income band and month.

    Transactions are summed per customer before the band is joined, which also takes the
    weight off a very active customer.
    """
    per_customer = txns.groupBy("customer_id", "txn_type", F.date_format("txn_ts", "yyyy-MM").alias("txn_month")).agg(
        F.count("*").alias("_n"), F.sum("amount_myr").alias("_value")
    )
    bands = with_income_band(loans, thresholds).where("customer_id is not null").groupBy("customer_id").agg(
        F.min("income_band").alias("income_band")
    )
    return (
        per_customer.join(bands, "customer_id", "left")
        .groupBy("txn_type", F.coalesce("income_band", F.lit("NONE")).alias("segment"), "txn_month")
        .agg(F.sum("_n").alias("txn_count"), as_double(F.sum("_value")).alias("txn_value"))
    )


def repayment_risk(behavior: DataFrame, loans: DataFrame) -> DataFrame:
    """MRT-11: behaviour next to the outcome."""
    outcome = loans.select("customer_id", F.col("target").alias("target_default"))
    return behavior.join(outcome, "customer_id")


def repayment_signal(risk: DataFrame) -> DataFrame:
    """MRT-11b: mean behaviour by outcome. Terms are fixed-point, so the mean is independent of row order."""

    def mean(c: str) -> Column:
        term = F.col(c).cast("decimal(28,9)")
        return F.round(F.try_divide(F.sum(term).cast("double"), F.count(term).cast("double")), 6).alias(c)

    return risk.groupBy("target_default").agg(
        F.count("*").alias("customers"), mean("late_payment_rate"), mean("underpayment_rate"), mean("cc_avg_utilization"), mean("max_dpd")
    )


def contact_aggregate(campaign: DataFrame) -> DataFrame:
    """The key-free grain shared by the cold and hot tiers."""
    return campaign.groupBy(
        "job", "education", F.col("poutcome").alias("prior_campaign_outcome"),
        F.year("created_at").alias("contact_year"), F.weekofyear("created_at").alias("contact_week"),
    ).agg(
        F.count("*").alias("contact_count"),
        ratio(F.sum("balance"), F.count("balance"), 6).alias("avg_yearly_balance"),
        F.count_if(F.col("y") == "yes").alias("subscribed_count"),
    )


def cold_tier(campaign: DataFrame, cutover: str) -> DataFrame:
    """MRT-12: history before the cutover, without any customer key."""
    return contact_aggregate(campaign.where(F.col("created_at") < F.lit(cutover).cast("timestamp_ntz")))


def hot_cold_union(campaign: DataFrame, cutover: str) -> DataFrame:
    """MRT-13: both tiers at one grain, told apart by a tag; the cutover itself is hot."""
    hot = contact_aggregate(campaign.where(F.col("created_at") >= F.lit(cutover).cast("timestamp_ntz")))
    return cold_tier(campaign, cutover).withColumn("tier", F.lit("cold")).unionByName(hot.withColumn("tier", F.lit("hot")))


def topk_customers(mart: DataFrame, by: str, k: int) -> DataFrame:
    """MRT-15: evidence rows; each task keeps k rows, nothing is sorted globally."""
    return mart.orderBy(F.col(by).desc(), "customer_id").limit(k)


def source_health(counts: DataFrame, marks: DataFrame, stages: DataFrame) -> DataFrame:
    """MRT-10: per source table: layer counts, last mark, reconciliation, stage status."""
    mark = marks.select(F.col("key").alias("table_name"), F.col("value").alias("last_watermark"))
    stage = stages.select(F.col("key").alias("table_name"), F.col("value").alias("stage_status"))
    return (
        counts.join(mark, "table_name", "left").join(stage, "table_name", "left")
        .withColumn("reconciled", F.coalesce(F.col("silver_row_count") <= F.col("bronze_row_count"), F.lit(False)))
    )



