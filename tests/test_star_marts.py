import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tributary.lake import Lake
from tributary.operators.control import write_once
from tributary.plans import marts, star

XWALK = "customer_id string, source_system string, native_key string, source_priority_rank int"
FACT = "customer_id string, txn_ts timestamp_ntz, txn_type string, amount decimal(18,2), amount_myr decimal(28,6), source_system string, is_fraud boolean, txn_id string"


def ts(text):
    return dt.datetime.fromisoformat(text)


def txn(customer, when, kind="VYDAJ", amount="1.00", source="berka", fraud=False, txn_id="t"):
    return (customer, ts(when), kind, Decimal(amount), Decimal(amount), source, fraud, txn_id)


def test_conversion(spark):
    df = spark.createDataFrame([("a", 10.0, "CZK"), ("b", 10.0, "unitless"), ("c", 10.0, "XXX"), ("d", 10.0, None), ("e", None, "MYR")], "id string, amount double, ccy string")
    got = star.to_reporting_currency(df, "amount", "ccy", "myr", star.fx_rates(spark))
    assert {r.id: r.myr for r in got.collect()} == {"a": Decimal("2.050000"), "b": None, "c": None, "d": None, "e": None}
    assert got.count() == 5 and "amount" in got.columns


def test_latest_balance_breaks_ties(spark):
    trans = spark.createDataFrame(
        [("a", "1", ts("2024-01-01"), Decimal("1"), "CZK"), ("a", "3", ts("2024-01-02"), Decimal("3"), "CZK"), ("a", "2", ts("2024-01-02"), Decimal("2"), "CZK")],
        "account_id string, trans_id string, date timestamp_ntz, balance decimal(18,2), currency string",
    )
    assert star.latest_balance(trans, star.fx_rates(spark)).first().current_balance == Decimal("3.00")


def test_dim_date_edges(spark):
    span = spark.createDataFrame([(dt.date(2024, 2, 28), dt.date(2024, 3, 1))], "first_day date, last_day date")
    got = [(r.date_key.isoformat(), r.month_name, r.day_of_week) for r in star.dim_date(span).orderBy("date_key").collect()]
    assert got == [("2024-02-28", "February", "Wednesday"), ("2024-02-29", "February", "Thursday"), ("2024-03-01", "March", "Friday")]


def test_installments(spark):
    df = spark.createDataFrame(
        [
            ("paid", -10, -12, Decimal("5"), Decimal("5")),
            ("paid", -10, -4, Decimal("5"), Decimal("4")),
            ("never", -10, None, Decimal("5"), None),
        ],
        "sk_id_curr string, days_instalment int, days_entry_payment int, amt_instalment decimal(18,2), amt_payment decimal(18,2)",
    )
    got = {r.sk_id_curr: tuple(r)[1:] for r in star.installment_behavior(df).collect()}
    assert got == {"paid": (2, 0.5, 0.5, 6.0), "never": (1, 1.0, 1.0, None)}


def test_utilization(spark):
    df = spark.createDataFrame(
        [("z", Decimal("5"), Decimal("0"), 0), ("n", Decimal("-5"), Decimal("10"), 1), ("o", Decimal("20"), Decimal("10"), 2), ("u", None, Decimal("10"), None)],
        "sk_id_curr string, amt_balance decimal(18,2), amt_credit_limit_actual decimal(18,2), sk_dpd int",
    )
    got = {r.sk_id_curr: (r.cc_months_dpd, r.cc_avg_utilization, r.cc_max_dpd) for r in star.card_utilization(df).collect()}
    assert got == {"z": (0, None, 0), "n": (1, 0.0, 1), "o": (1, 2.0, 2), "u": (0, None, None)}


def test_repayment_worst_dpd_and_grain(spark):
    inst = spark.createDataFrame([(k, -1, -1, Decimal(1), Decimal(1)) for k in "abcd"], "sk_id_curr string, days_instalment int, days_entry_payment int, amt_instalment decimal(18,2), amt_payment decimal(18,2)")
    card = spark.createDataFrame([("a", Decimal(1), Decimal(1), 5), ("b", Decimal(1), Decimal(1), 2), ("x", Decimal(1), Decimal(1), 9)], "sk_id_curr string, amt_balance decimal(18,2), amt_credit_limit_actual decimal(18,2), sk_dpd int")
    pos = spark.createDataFrame([("b", 7), ("c", 0)], "sk_id_curr string, sk_dpd int")
    xwalk = spark.createDataFrame([(f"C{k}", "home_credit", k, 3) for k in "abcd"], XWALK)
    got = {r.customer_id: r.max_dpd for r in star.fact_repayment_behavior(inst, card, pos, xwalk).collect()}
    assert got == {"Ca": 5, "Cb": 7, "Cc": 0, "Cd": None}  # x has no customer and stays out


def test_fact_txn_joint_account_does_not_fan_out(spark):
    card = spark.createDataFrame([("1", ts("2024-01-01"), "error", Decimal(1), "MYR", True)], "txn_id string, txn_ts timestamp_ntz, txn_type string, amount decimal(18,2), currency string, is_fraud boolean")
    bronze = spark.createDataFrame([("1", "C1")], "txn_id string, nameOrig string")
    trans = spark.createDataFrame([("9", "acc", ts("1999-05-01"), "PRIJEM", Decimal(10), "CZK")], "trans_id string, account_id string, date timestamp_ntz, type string, amount decimal(18,2), currency string")
    disp = spark.createDataFrame([("acc", "c1", "OWNER"), ("acc", "c2", "DISPONENT")], "account_id string, client_id string, type string")
    xwalk = spark.createDataFrame([("X", "paysim", "C1", 4), ("O", "berka", "c1", 1), ("D", "berka", "c2", 1)], XWALK)
    got = star.fact_txn(card, bronze, trans, disp, xwalk, star.fx_rates(spark))
    assert {(r.txn_id, r.customer_id, float(r.amount_myr), r.txn_year, r.txn_month) for r in got.collect()} == {("1", "X", 1.0, 2024, 1), ("9", "O", 2.05, 1999, 5)}
    assert got.count() == 2 and "nameOrig" not in got.columns


def test_fraud_fact_reads_the_label_not_the_rule_flag(spark):
    card = spark.createDataFrame([("1", True, False), ("2", False, True), ("3", None, True)], "txn_id string, is_fraud boolean, is_flagged_fraud boolean").withColumns(
        {"txn_ts": F.lit("2024-01-01").cast("timestamp_ntz"), "txn_type": F.lit("x"), "amount": F.lit(1).cast("decimal(18,2)"), "currency": F.lit("MYR")}
    )
    bronze = spark.createDataFrame([("1", "C1"), ("2", "C1"), ("3", "C1")], "txn_id string, nameOrig string")
    got = star.fact_card_fraud(card, bronze, spark.createDataFrame([], XWALK), star.fx_rates(spark))
    assert [(r.txn_id, r.customer_id) for r in got.collect()] == [("1", None)]


def test_customer_360_zeroes_and_no_fan_out(spark):
    customers = spark.createDataFrame([("a",), ("b",)], "customer_id string")
    txns = spark.createDataFrame([txn("a", "2024-01-01", amount="2.50"), txn("a", "2024-01-02"), txn(None, "2024-01-02")], FACT)
    loans = spark.createDataFrame([("a",), ("a",)], "customer_id string")
    campaign = spark.createDataFrame([("a", True), ("a", None)], "customer_id string, subscribed_term_deposit boolean")
    assert rows(marts.customer_360(customers, txns, loans, campaign)) == [("a", 2, 2, 1, 3.5, 3), ("b", 0, 0, 0, 0.0, 0)]


def test_followup_window_edges(spark):
    fraud = spark.createDataFrame([(i, "a", ts(t)) for i, t in enumerate(["2024-01-03 00:00:00", "2024-01-01 00:00:00", "2023-12-31 23:59:59", "2024-01-03 00:00:01"])] + [(9, None, ts("2024-01-01"))], "txn_id int, customer_id string, txn_ts timestamp_ntz")
    cases = spark.createDataFrame([("a", "Fraud Follow-up", ts("2024-01-03 00:00:00")), ("a", "Fraud Follow-up", ts("2024-01-09")), ("a", "General Inquiry", ts("2023-01-01")), (None, "Fraud Follow-up", ts("2024-01-01"))], "customer_id string, case_type string, opened_at timestamp_ntz")
    got = {r.txn_id: r.within_sla for r in marts.fraud_followup_events(fraud, cases).collect()}
    assert got == {0: True, 1: True, 2: False, 3: False, 9: False}
    summary = marts.fraud_followup(fraud, cases).first()
    assert tuple(summary) == (5, 2, 40.0)


def test_followup_without_fraud(spark):
    fraud = spark.createDataFrame([], "txn_id int, customer_id string, txn_ts timestamp_ntz")
    cases = spark.createDataFrame([], "customer_id string, case_type string, opened_at timestamp_ntz")
    assert tuple(marts.fraud_followup(fraud, cases).first()) == (0, 0, None)


def test_funnel_counts_applications_at_their_own_grain(spark):
    loans = spark.createDataFrame([("1", ts("2024-01-05")), ("2", ts("2024-01-09")), ("3", ts("2024-02-01"))], "sk_id_curr string, created_at timestamp_ntz")
    previous = spark.createDataFrame([("1", "Approved", -10), ("1", "Refused", -20), ("1", "Approved", None), ("9", "Approved", -1)], "sk_id_curr string, name_contract_status string, days_decision bigint")
    assert rows(marts.loan_funnel(loans, previous)) == [("2024-01", 2, round(200 / 3, 9), 15.0), ("2024-02", 1, None, None)]


def test_month_over_month_gap_counts_as_zero(spark):
    fraud = spark.createDataFrame([txn("a", "2024-01-10", "T", "5.00"), txn("a", "2024-03-10", "T", "7.00"), txn("a", "2024-03-11", "T", "1.00"), txn("a", "2024-04-11", "T", "1.00")], FACT)
    got = {r.txn_month.month: (r.prior_count, r.count_delta, r.value_delta) for r in marts.fraud_mom(fraud).collect()}
    assert got == {1: (0, 1, 5.0), 2: (1, -1, -5.0), 3: (0, 2, 8.0), 4: (2, -1, -7.0)}


def test_flows_missing_direction_is_zero_and_pivot_null(spark):
    txns = spark.createDataFrame([txn("a", "2024-01-01", "PRIJEM", "5.00"), txn("a", "2024-01-02", "VYDAJ", "3.00")], FACT)
    balances = spark.createDataFrame([(Decimal("4.5"),), (None,)], "current_balance_myr decimal(28,6)")
    assert [tuple(r)[1:] for r in marts.daily_flows(txns, balances).orderBy("txn_date").collect()] == [(5.0, 0.0, 5.0, 4.5), (0.0, 3.0, -3.0, 4.5)]
    assert [tuple(r)[1:] for r in marts.daily_flows_pivot(txns).orderBy("txn_date").collect()] == [(5.0, None, 5.0), (None, 3.0, -3.0)]


@pytest.mark.parametrize("last, dormant", [("2023-11-02", True), ("2023-11-03", False), (None, True)])
def test_dormancy_boundary(spark, last, dormant):
    customers = spark.createDataFrame([("a",)], "customer_id string")
    txns = spark.createDataFrame([txn("a" if last else "b", last or "2024-01-30")], FACT)
    assert (marts.dormancy(customers, txns, "2024-01-31").count() == 1) is dormant


def test_cross_sell_absence_and_ranking(spark):
    customers = spark.createDataFrame([(c,) for c in "abcd"], "customer_id string")
    txns = spark.createDataFrame([txn("a", "2024-01-20"), txn("b", "2024-01-20", source="paysim"), txn("d", "2023-01-01")], FACT)
    loans = spark.createDataFrame([("c",), (None,)], "customer_id string")
    bridge = spark.createDataFrame([(c, f"acc{c}", "OWNER") for c in "abcd"] + [("a", "poor", "OWNER"), (None, "acca", "OWNER")], "customer_id string, account_id string, relation_type string")
    balances = spark.createDataFrame([(f"acc{c}", Decimal(10 + i)) for i, c in enumerate("abcd")] + [("poor", Decimal(1))], "account_id string, current_balance_myr decimal(28,6)")
    campaign = spark.createDataFrame([("a", "success", True)], "customer_id string, prior_campaign_outcome string, subscribed_term_deposit boolean")
    limits = spark.createDataFrame([(Decimal(10),)], "balance_p50 decimal(28,6)")
    targets = marts.cross_sell(customers, txns, loans, bridge, balances, campaign, limits)
    assert rows(targets.select("customer_id", "account_id")) == [("a", "acca"), ("d", "accd")]
    ranked = marts.cross_sell_ranked(targets, "2024-01-31")
    assert [(r.customer_id, r.response_rank) for r in ranked.collect()] == [("a", 1)]


def test_thresholds_freeze(spark, lake: Lake):
    loans = spark.createDataFrame([(Decimal(v),) for v in range(1, 9)], "amt_income_total decimal(18,2)")
    balances = spark.createDataFrame([(Decimal(v),) for v in (1, 2, 3)], "current_balance_myr decimal(28,6)")
    first = marts.segment_thresholds(loans, balances)
    assert [float(v) for v in first.first()] == [2.0, 6.0, 2.0]
    assert write_once(lake, first, "gold", "limits")
    assert not write_once(lake, marts.segment_thresholds(loans.union(loans.selectExpr("amt_income_total * 100")), balances), "gold", "limits")
    frozen = lake.read("gold", "limits")
    banded = marts.with_income_band(loans, frozen)
    assert {r[0]: r[1] for r in banded.groupBy("income_band").count().collect()} == {"LOW": 1, "MEDIUM": 5, "HIGH": 2}


def test_risk_segment_disagreement_needs_both_signals(spark):
    loans = spark.createDataFrame([("a", 1, Decimal(5), "w"), ("b", 0, Decimal(5), "w"), ("c", 1, Decimal(5), "w"), (None, 1, Decimal(5), "w")], "customer_id string, target int, amt_income_total decimal(18,2), name_income_type string")
    campaign = spark.createDataFrame([("a", False), ("b", False), ("c", None)], "customer_id string, credit_in_default boolean")
    limits = spark.createDataFrame([(Decimal(1), Decimal(9))], "income_p25 decimal(18,2), income_p75 decimal(18,2)")
    got = {r.customer_id: (r.is_default, r.default_signal_disagreement) for r in marts.risk_segment(loans, campaign, limits).collect()}
    assert got == {"a": (1, 1), "b": (0, 0), "c": (1, 0), None: (1, 0)}


def test_hot_cold_split_is_exact(spark):
    df = spark.createDataFrame([("j", "e", "p", Decimal(1), "yes", ts("1998-12-31 23:59:59")), ("j", "e", "p", Decimal(3), "no", ts("1999-01-01"))], "job string, education string, poutcome string, balance decimal(18,2), y string, created_at timestamp_ntz")
    both = marts.hot_cold_union(df, "1999-01-01")
    assert {(r.tier, r.contact_count, r.subscribed_count) for r in both.collect()} == {("cold", 1, 1), ("hot", 1, 0)}
    assert not [c for c in both.columns if "customer" in c]
