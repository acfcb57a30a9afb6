"""The stage jobs end to end: Bronze in the source systems' shapes, through to the marts."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tributary.lake import Lake
from tributary.operators import upsert
from tributary.plans import jobs, registry
from tributary.plans.workspace import Workspace
from tributary.schemas import CONTRACTS, schema
from tributary.session import shared_dir
from tributary.sources import pulls

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ws(spark):
    return Workspace(spark, SF)


@pytest.fixture(scope="module")
def built(spark, ws):
    lake = Lake(spark, f"{shared_dir(spark)}/tests/jobs-{uuid.uuid4().hex}")
    e = ws.entities

    def put(df, source, table, times=1):
        for _ in range(times):  # Bronze legally holds redelivered copies
            lake.append(df, "bronze", source, table)

    ref = lambda c, p: F.concat(F.lit(p), F.col(c))
    put(e.client().select(ref("client_id", "CT").alias("Id"), F.col("client_id").alias("berka_client_id__c"), F.col("birth_number").alias("birth_number__c"), F.col("district_id").alias("berka_district_id__c")), "salesforce", "contact", 2)
    accounts = e.disp().select("account_id").distinct()
    put(accounts.select(ref("account_id", "AC").alias("Id"), F.col("account_id").alias("berka_account_id__c"), F.lit("1").alias("berka_district_id__c"), F.lit("M").alias("berka_frequency__c"), F.lit("1995-01-01").alias("berka_account_open_date__c")), "salesforce", "account")
    put(e.disp().select(F.col("disp_id").alias("berka_disp_id__c"), ref("client_id", "CT").alias("ContactId"), ref("account_id", "AC").alias("AccountId"), F.col("type").alias("berka_disp_type__c")), "salesforce", "accountcontactrelation")
    t = e.trans_bronze()
    put(t.select(F.col("trans_id").alias("berka_trans_id__c"), F.col("account_id").alias("berka_account_id__c"), F.col("trans_date").cast("string").alias("trans_date__c"), F.col("trans_type").alias("trans_type__c"), F.lit("x").alias("operation__c"), F.col("amount").cast("string").alias("amount__c"), F.col("balance").cast("string").alias("balance__c"), F.lit(None).cast("string").alias("k_symbol__c"), F.lit("AB").alias("bank__c"), F.col("partner_account").alias("partner_account__c")), "salesforce", "transaction", 2)
    put(e.district().select(F.col("district_id").alias("berka_district_id__c"), F.col("name").alias("district_name__c"), F.col("region").alias("region__c")), "salesforce", "district")
    put(e.crm_case_surrogate().select(F.col("case_id").alias("Id"), F.col("contact_ref").alias("ContactId"), F.col("opened_at").cast("string").alias("CreatedDate"), F.col("case_type").alias("Type")), "salesforce", "case")
    upper = lambda df: df.toDF(*[c.upper() if not c.endswith("_at") else c for c in df.columns])
    put(upper(e.application().drop("currency")), "postgres", "application")
    put(upper(e.previous_application()).withColumn("SK_ID_PREV", F.col("SK_ID_PREV").cast("bigint")), "postgres", "previous_application")
    put(e.previous_application().select(F.col("sk_id_prev").alias("SK_ID_BUREAU"), F.col("sk_id_curr").alias("SK_ID_CURR")), "postgres", "bureau")
    put(upper(e.installments_bronze()), "postgres", "installments_payments")
    put(upper(e.card_balance_bronze()), "postgres", "credit_card_balance")
    put(upper(e.pos_balance_bronze()), "postgres", "pos_cash_balance")
    put(e.card_bronze(), "mssql", "paysim_transactions", 2)
    put(ws.campaign_keyed().drop("campaign_row"), "teradata", "bank_marketing")
    put(spark.createDataFrame([("acc-12345", "b", "l")], "id string, bank_id string, label string"), "obp", "accounts", 2)
    nested = "id string, this_account struct<id:string>, details struct<completed:string,description:string,value:struct<amount:string,currency:string>>"
    put(spark.createDataFrame([("t1", ("acc-12345",), ("2024", "d", ("1.5", "EUR"))), ("t2", ("acc-12345",), ("2024", "d", ("bad", "EUR")))], nested), "obp", "transactions")
    for run in ("r1", "r1"):  # the whole chain twice: the second run must change nothing
        rejects = {**jobs.silver_crm(lake, run, 2), **jobs.silver_sales(lake, run, 2)}
        jobs.silver_fraud(lake, run, 2)
        jobs.silver_marketing(lake)
        jobs.silver_core_banking(lake, run, 2)
        jobs.currency_gate(lake)
        jobs.gold_dimensions(lake, ws.gold("crosswalk"), ws.fx, "2024-01-01", "2024-12-31")
        jobs.gold_facts(lake)
        jobs.gold_marts(lake, registry.AS_OF)
        jobs.health(lake, [("mssql", "paysim_transactions", "card_txn"), ("postgres", "bureau", "bureau"), ("x", "missing", "missing")], run)
    return lake, rejects


def test_rejects_are_counted(built):
    lake, rejects = built
    assert rejects["client"] == 2 * 15 and rejects["bureau"] > 0
    assert lake.read("silver", "quarantine_client_birth_number").count() == rejects["client"]


def test_silver_has_one_row_per_key(built):
    lake, _ = built
    for table, keys in [("client", ["client_id"]), ("trans", ["trans_id"]), ("card_txn", ["txn_id"]), ("obp_accounts", ["account_id"]), *[(t, list(k)) for t, k in jobs.LOAN_CHILDREN.items()]]:
        df = upsert.read_upserted(lake, table)
        assert df.count() == df.select(*keys).distinct().count() > 0


def test_api_tables(built):
    lake, _ = built
    assert lake.read("silver", "obp_accounts").first().account_id_last4 == "2345"
    got = {r.transaction_id: (r.account_id, r.amount) for r in lake.read("silver", "obp_transactions").collect()}
    assert got == {"t1": ("acc-12345", 1.5), "t2": ("acc-12345", None)}


@pytest.mark.parametrize(
    "mart, key",
    [
        ("mart_customer_360", "customer_360"), ("mart_fraud_daily", "fraud_daily"), ("mart_fraud_followup", "fraud_followup"),
        ("mart_loan_funnel", "loan_funnel"), ("mart_risk_segment", "risk_segment"), ("mart_cross_sell", "cross_sell"),
        ("mart_dormancy", "dormancy"), ("mart_daily_flows", "daily_flows"), ("mart_spending", "spending_distribution"),
    ],
)
def test_marts_equal_the_checked_queries(built, ws, mart, key):
    lake, _ = built
    expected = registry.QUERIES[key](ws)
    assert rows(lake.read("gold", mart).select(*expected.columns)) == rows(expected)


def test_facts_do_not_double_on_a_second_run(built):
    lake, _ = built
    fact = lake.read("gold", "fact_txn")
    assert fact.count() == fact.select("source_system", "txn_id").distinct().count() == 2500
    assert "nameOrig" not in fact.columns and "_raw" not in fact.columns


def test_health_ledger(built):
    lake, _ = built
    got = {r.table_name: (r.bronze_row_count, r.reconciled) for r in lake.read("gold", "mart_source_health").collect()}
    assert got["paysim_transactions"] == (2000, True) and got["missing"] == (None, False) and len(got) == 3


def test_contracts_hold(built):
    lake, _ = built
    report = jobs.contract_gate(lake)
    assert {r.table_name for r in report.select("table_name").collect()} == set(CONTRACTS)
    with pytest.raises(ValueError):
        jobs.contract_gate(lake, [])


def test_pull_land_promote(spark):
    lake = Lake(spark, f"{shared_dir(spark)}/tests/feeds-{uuid.uuid4().hex}")
    declared = schema(id="long", changed_at="timestamp_ntz")
    a, b = [jobs.Feed("core", t, declared, file_set="daily") for t in ("a", "b")]

    def data(*ids):
        return spark.createDataFrame([(i, f"2024-01-{i:02d} 00:00:00") for i in ids], "id long, changed_at string").withColumn("changed_at", F.col("changed_at").cast("timestamp_ntz"))

    def pull(feed, table, day):
        rows = pulls.pull_since(table, "changed_at", jobs.mark(lake, feed, "timestamp_ntz"))
        return jobs.extract(lake, rows, feed, day, f"{day} 02:00:00", changed="changed_at")

    assert pull(a, data(), "2024-01-03") == []
    assert pull(a, data(1, 2), "2024-01-03") == ["2024-01-03"]
    verdict = lambda run: {(r.table_name, r.dt): r.verdict for r in jobs.promote_all(lake, [a, b], run).collect()}
    assert verdict("r1") == {("a", "2024-01-03"): "file set incomplete"}
    pull(b, data(1), "2024-01-03")
    assert verdict("r2") == {("a", "2024-01-03"): "promoted", ("b", "2024-01-03"): "promoted"}
    pull(a, data(1, 2, 5), "2024-01-06")
    pull(b, data(1, 6), "2024-01-06")
    assert set(verdict("r3").values()) == {"promoted"}
    assert rows(lake.read("bronze", "core", "a").select("id", F.col("dt").cast("string"))) == [(1, "2024-01-03"), (2, "2024-01-03"), (2, "2024-01-06"), (5, "2024-01-06")]
    assert verdict("r4") == {}


def test_erasure_reaches_every_table(built, ws):
    lake, _ = built
    xwalk = ws.gold("crosswalk")
    erased = xwalk.where("source_system = 'home_credit' and native_key in ('1', '13', '25')").select("customer_id")
    keys = {(r.kind, r.key) for r in jobs._gone_keys(lake, erased).collect()}
    before = {p: stamp for p, _, stamp in lake.files.data_files(lake.path("gold", "fact_txn"))}
    report = {r.table_name: (r.rows_before, r.rows_after) for r in jobs.erase(lake, erased, "erase-1").collect()}
    assert report["gold.fact_loan_application"][0] - report["gold.fact_loan_application"][1] == erased.count()
    gone = {r[0] for r in erased.collect()}
    for table in [*jobs.CUSTOMER_TABLES, *jobs.CUSTOMER_FACTS, "dim_customer_xwalk"]:
        assert lake.read("gold", table).where(F.col("customer_id").isin(*gone)).count() == 0
    assert lake.read("silver", "application").where("sk_id_curr in ('1', '13', '25')").count() == 0
    for layer, table, kind, column in jobs._erasure_targets(lake):
        named = {str(r[0]) for r in lake.read(layer, table).select(column).collect()}
        assert not named & {k for of, k in keys if of == kind}, table
    assert {"silver.bureau", "silver.quarantine_bureau_orphans", "silver.trans", "silver.account", "gold.fact_account_balance"} <= set(report)
    after = {p: stamp for p, _, stamp in lake.files.data_files(lake.path("gold", "fact_txn"))}
    hit = {p.rsplit("/", 1)[0] for p in before.keys() - after.keys()}
    assert all(after[p] == before[p] for p in before if p.rsplit("/", 1)[0] not in hit)  # other partitions keep their files
    again = {r.table_name: (r.rows_before, r.rows_after) for r in jobs.erase(lake, erased, "erase-2").collect()}
    assert all(x == y for x, y in again.values())
