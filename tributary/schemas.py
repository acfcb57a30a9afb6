"""Declared table schemas and the helpers that hold a frame to one."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def schema(**columns: str) -> StructType:
    """Column names and type names; needs no running session."""
    declared = StructType()
    for name, kind in columns.items():
        declared = declared.add(name, kind)
    return declared


FX_RATE = schema(currency_code="string", rate_to_myr="decimal(10,4)", rate_as_of="date", note="string")
CONTROL_STATE = schema(key="string", value="string", written_at="timestamp_ntz")
HEALTH = schema(
    table_name="string", bronze_row_count="long", silver_row_count="long", last_watermark="string",
    stage_status="string", reconciled="boolean", run_id="string",
)

# Serving contracts: what an analyst sees of each Gold table. Column names and their order.
SERVING = {
    "fact_txn": schema(
        txn_id="string", customer_id="string", txn_ts="timestamp_ntz", txn_type="string", amount="double", currency="string",
        is_fraud="boolean", source_system="string", amount_myr="double", txn_year="integer", txn_month="integer",
    ),
    "fact_card_fraud": schema(
        txn_id="string", customer_id="string", txn_ts="timestamp_ntz", txn_type="string", amount="double", currency="string",
        amount_myr="double", txn_year="integer", txn_month="integer",
    ),
    "fact_loan_application": schema(
        customer_id="string", sk_id_curr="string", target="integer", amt_income_total="double", name_income_type="string",
        created_at="timestamp_ntz",
    ),
    "dim_customer": schema(
        customer_id="string", source_priority_rank="string", birth_date="string", gender="string", district_id="string"
    ),
    "dim_customer_xwalk": schema(customer_id="string", source_system="string", native_key="string", source_priority_rank="string"),
    "dim_date": schema(date_key="date", year="integer", month="integer", day="integer", month_name="string", day_of_week="string"),
    "dim_fx_rate": schema(currency_code="string", rate_to_myr="double", rate_as_of="string", note="string"),
    "dim_campaign_response": schema(
        customer_id="string", job="string", marital="string", education="string", credit_in_default="boolean",
        avg_yearly_balance="long", prior_campaign_outcome="string", subscribed_term_deposit="boolean",
    ),
    "fact_crm_case": schema(case_id="string", customer_id="string", case_type="string", opened_at="string"),
    "fact_previous_application": schema(
        # Keys are text here, as everywhere in the lake.
        sk_id_prev="string", customer_id="string", sk_id_curr="string", name_contract_status="string", days_decision="long"
    ),
    "fact_account_balance": schema(account_id="string", current_balance="double", current_balance_myr="double", currency="string"),
    "bridge_customer_account": schema(customer_id="string", account_id="string", relation_type="string"),
    "fact_repayment_behavior": schema(
        customer_id="string", installment_count="long", late_payment_rate="double", underpayment_rate="double",
        avg_days_late="double", cc_months_dpd="long", cc_avg_utilization="double", pos_months_dpd="long", max_dpd="long",
    ),
}


class Contract(NamedTuple):
    """What every row of a table has to satisfy: columns that are never NULL, and one key that is unique."""

    required: tuple[str, ...]
    key: tuple[str, ...] = ()


CONTRACTS = {
    "dim_customer": Contract(("customer_id",), ("customer_id",)),
    "dim_customer_xwalk": Contract(("customer_id", "source_system", "native_key"), ("source_system", "native_key")),
    "dim_date": Contract(("date_key",), ("date_key",)),
    "dim_fx_rate": Contract(("currency_code",), ("currency_code",)),
    "dim_campaign_response": Contract(("customer_id",), ("customer_id",)),
    "bridge_customer_account": Contract(("account_id", "relation_type")),
    "fact_txn": Contract(("txn_id", "txn_ts", "source_system", "currency"), ("source_system", "txn_id")),
    "fact_card_fraud": Contract(("txn_id", "txn_ts", "currency"), ("txn_id",)),
    "fact_loan_application": Contract(("sk_id_curr",), ("sk_id_curr",)),
    "fact_previous_application": Contract(("sk_id_prev",), ("sk_id_prev",)),
    "fact_crm_case": Contract(("case_id",), ("case_id",)),
    "fact_account_balance": Contract(("account_id", "currency"), ("account_id",)),
    "fact_repayment_behavior": Contract(("customer_id",)),
    "mart_customer_360": Contract(("customer_id",), ("customer_id",)),
    "mart_fraud_daily": Contract(("txn_date",)),
    "mart_fraud_followup": Contract(("fraud_event_count",)),
    "mart_loan_funnel": Contract(("app_month",), ("app_month",)),
    "mart_risk_segment": Contract(("customer_id",)),
    "mart_cross_sell": Contract(("customer_id",)),
    "mart_dormancy": Contract(("customer_id",)),
    "mart_daily_flows": Contract(("txn_date",), ("txn_date",)),
    "mart_repayment_risk": Contract(("customer_id",)),
}


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def conform_to(df: DataFrame, target: StructType) -> DataFrame:
    """SNK-09: select exactly the declared columns, cast to their declared types."""
    by_lower = {c.lower(): c for c in df.columns}
    require_columns(df.toDF(*[c.lower() for c in df.columns]), [f.name for f in target])
    return df.select(*[F.col(by_lower[f.name]).cast(f.dataType).alias(f.name) for f in target])


def schema_drift(spark: SparkSession, known: StructType, landed: StructType) -> DataFrame:
    """PRM-05: every column that was added, removed or retyped against the last good schema."""
    fields = "column_name string, known_type string, landed_type string"
    old = spark.createDataFrame([(f.name, f.dataType.simpleString(), None) for f in known], fields)
    new = spark.createDataFrame([(f.name, None, f.dataType.simpleString()) for f in landed], fields)
    merged = old.unionByName(new).groupBy("column_name").agg(
        F.max("known_type").alias("known_type"), F.max("landed_type").alias("landed_type")
    )
    change = (
        F.when(F.col("known_type").isNull(), "added")
        .when(F.col("landed_type").isNull(), "removed")
        .when(F.col("known_type") != F.col("landed_type"), "retyped")
    )
    return merged.withColumn("change", change).where(F.col("change").isNotNull())
