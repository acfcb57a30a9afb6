"""Stage jobs over a lake: pull and landing, promotion, Bronze to Silver per source system, then Gold and the marts.

Each function reads the lake's tables, composes operators and writes tables. Order and
retries are left to whatever runs them; every job may be run again for the same run id.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import MONEY, mask_last4
from ..lake import Lake
from ..operators import conform, fileindex, identity, increments, promotion, quality, upsert
from ..operators.buckets import BUCKET, with_bucket
from ..operators.control import read_state, record_state, write_once
from ..schemas import CONTRACTS
from ..operators.scale import skew_safe_join
from ..sources import landing
from . import marts, star

# Field names of the CRM objects and the loan tables.
CONTACT = {"berka_client_id__c": "client_id", "birth_number__c": "birth_number", "berka_district_id__c": "district_id"}
ACCOUNT = {
    "berka_account_id__c": "account_id", "berka_district_id__c": "district_id",
    "berka_frequency__c": "frequency", "berka_account_open_date__c": "date",
}
RELATION = {"berka_disp_id__c": "disp_id", "ContactId": "contact_ref", "AccountId": "account_ref", "berka_disp_type__c": "type"}
TRANSACTION = {
    "berka_trans_id__c": "trans_id", "berka_account_id__c": "account_id", "trans_date__c": "date", "trans_type__c": "type",
    "operation__c": "operation", "amount__c": "amount", "balance__c": "balance", "k_symbol__c": "k_symbol",
    "bank__c": "bank", "partner_account__c": "partner_account",
}
DISTRICT = {"berka_district_id__c": "district_id", "district_name__c": "name", "region__c": "region"}
CASE = {"Id": "case_id", "ContactId": "contact_ref", "CreatedDate": "opened_at", "Type": "case_type"}
MODIFIED = "SystemModstamp"
APPLICATION = [
    "sk_id_curr", "target", "amt_income_total", "name_income_type", "organization_type", "created_at", "updated_at", "is_deleted",
]
LOAN_CHILDREN = {
    "bureau": ("sk_id_bureau",),
    "installments_payments": ("sk_id_prev", "num_instalment_version", "num_instalment_number"),
    "credit_card_balance": ("sk_id_prev", "months_balance"),
    "pos_cash_balance": ("sk_id_prev", "months_balance"),
}
MONETARY = {"card_txn": ["amount"], "trans": ["amount", "balance"], "application": ["amt_income_total"], "campaign_response": ["avg_yearly_balance"]}


# Where a customer appears: by customer id, or by the native key of one source.
CUSTOMER_TABLES = [
    "dim_customer", "dim_campaign_response", "bridge_customer_account", "fact_loan_application", "fact_previous_application",
    "fact_crm_case", "fact_repayment_behavior", "mart_customer_360", "mart_risk_segment", "mart_cross_sell", "mart_dormancy",
    "mart_repayment_risk",
]
CUSTOMER_FACTS = ["fact_txn", "fact_card_fraud"]
NATIVE_TABLES = {
    "client": ("berka", "client_id"), "disp": ("berka", "client_id"), "crm_case": ("berka", "client_id"),
    "application": ("home_credit", "sk_id_curr"), "previous_application": ("home_credit", "sk_id_curr"),
    **{table: ("home_credit", "sk_id_curr") for table in LOAN_CHILDREN},
}


# Tables that name a customer by a transaction of theirs, or by an account.
KEYED_TABLES = {
    "card_txn": ("paysim txn", "txn_id"), "trans": ("berka txn", "trans_id"), "account": ("account", "account_id"),
    "campaign_response": ("customer", "customer_id"),
}


class Feed(NamedTuple):
    """How one table of a source arrives. Tables of a source with the same ``file_set`` are promoted together per date."""

    source: str
    table: str
    declared: StructType
    fmt: str = "parquet"
    mode: str = "batch"
    multiline: bool = False
    file_set: str | None = None


def extract(lake: Lake, pulled: DataFrame, feed: Feed, date: str, written_at: str, changed: str | None = None, seq: str | None = None) -> list[str]:
    """SRC-01..05, SNK-01: pulled rows become one landed date, then the mark moves; gives the dates landed.

    The mark is the newest change among the rows that landed, never the clock, and is written last:
    a run that died before pulls the same rows again. An empty pull lands nothing and leaves the mark.
    """
    rows = pulled.select(*[F.col(f.name).cast(f.dataType) for f in feed.declared]).withColumn("dt", F.lit(date))
    if rows.isEmpty():
        return []
    landed = landing.land(lake, rows, feed.source, feed.table, written_at, feed.fmt, seq, [date])
    mark = seq or changed
    if mark:
        newest = landing.scan_landing(lake, feed.source, feed.table, feed.declared, feed.fmt, landed).agg(F.max(mark).cast("string").alias("value"))
        state = newest.select(F.lit(f"{feed.source}.{feed.table}").alias("key"), "value", F.lit(written_at).alias("written_at"))
        record_state(lake, "marks", state)
    return landed


def mark(lake: Lake, feed: Feed, kind: str) -> Column:
    """The mark of a feed as a scalar subquery; NULL before the first pull."""
    mine = read_state(lake, "marks").where(F.col("key") == f"{feed.source}.{feed.table}")
    return mine.agg(F.max("value").cast(kind)).scalar()


def waiting_dates(lake: Lake, feeds: Sequence[Feed]) -> dict[tuple[str, str], list[str]]:
    """PRM-10: per source and file set, the landed dates on which a table of the set is still missing."""
    sets: dict[tuple[str, str], list[str]] = {}
    for feed in feeds:
        if feed.file_set:
            sets.setdefault((feed.source, feed.file_set), []).append(feed.table)
    waiting = {}
    for (source, name), tables in sets.items():
        arrived = reduce(DataFrame.unionByName, [landing.list_partitions(lake, source, t) for t in tables]).where("has_success")
        late = promotion.complete_sets(arrived, tables).where("not complete")
        waiting[source, name] = [r.dt for r in late.select("dt").toLocalIterator()]
    return waiting


def promote_all(lake: Lake, feeds: Sequence[Feed], run_id: str) -> DataFrame:
    """PRM-08..10: every pending date of every feed; the verdicts of this run.

    A date that fails stays pending and stops neither other dates nor other feeds.
    """
    waiting = waiting_dates(lake, feeds)
    verdicts = [
        promotion.promote(
            lake, f.source, f.table, f.declared, f.fmt, run_id, waiting.get((f.source, f.file_set), ()), f.mode, f.multiline
        )
        for f in feeds
    ]
    return reduce(DataFrame.unionByName, verdicts)


def contract_gate(lake: Lake, tables: Sequence[str] = tuple(CONTRACTS)) -> DataFrame:
    """DQ-02: the contracts of those Gold tables that exist; raises when one is broken, else gives the clauses."""
    checked = [quality.held_to(lake.read("gold", t), t, CONTRACTS[t]) for t in tables if lake.exists("gold", t)]
    if not checked:
        raise ValueError("no Gold table to check")
    report = reduce(DataFrame.unionByName, checked)
    quality.require_contracts(report)
    return report


def _bronze(lake: Lake, source: str, table: str) -> DataFrame:
    """A Bronze table without its load columns, names in lower case unless they are CRM fields."""
    return lake.read("bronze", source, table).drop("dt", "load_id")


def _lower(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def _text_keys(df: DataFrame) -> DataFrame:
    """Native keys are text everywhere, so they meet the crosswalk without casts in joins."""
    return df.withColumns({c: F.col(c).cast("string") for c in df.columns if c.startswith("sk_id_")})


def _crm(lake: Lake, table: str, names: dict[str, str]) -> DataFrame:
    return _crm_names(_bronze(lake, "salesforce", table), names)


def _crm_names(raw: DataFrame, names: dict[str, str]) -> DataFrame:
    """Renamed CRM object; its modification stamp, when delivered, decides which copy is latest."""
    wanted = {**names, **({MODIFIED: "updated_at"} if MODIFIED in raw.columns else {})}
    return conform.project(raw, wanted)


def _conform_transactions(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "date": F.col("date").try_cast("timestamp_ntz"),
            "amount": F.col("amount").try_cast(MONEY),
            "balance": F.col("balance").try_cast(MONEY),
            "partner_account": mask_last4(F.col("partner_account")),
            "currency": F.lit("CZK"),
        }
    )


def _records(lake: Lake, table: str, record: str, native: str) -> DataFrame:
    """Record id to native key; redelivered copies of a record collapse to one row."""
    raw = _bronze(lake, "salesforce", table)
    return raw.groupBy(F.col("Id").alias(record)).agg(F.max(native).alias(native))


def silver_crm(lake: Lake, run_id: str, buckets: int = 64) -> dict[str, int]:
    """Clients, accounts, links, transactions, districts and cases; returns rejects per table."""
    def put(df: DataFrame, table: str, key: str) -> None:
        upsert.upsert(lake, df, table, [key], run_id, buckets)

    tagged = conform.tag_birth_number(_crm(lake, "contact", CONTACT)).withColumnRenamed("decode_error", conform.VERDICT)
    put(conform.clean(tagged), "client", "client_id")
    rejected = upsert.quarantine(lake, tagged.where(F.col(conform.VERDICT).isNotNull()), "client_birth_number", run_id)

    contacts = _records(lake, "contact", "contact_id", "berka_client_id__c").withColumnRenamed("berka_client_id__c", "client_id")
    accounts = _records(lake, "account", "record_id", "berka_account_id__c").withColumnRenamed("berka_account_id__c", "account_id")
    links = conform.resolve_surrogates(
        _crm(lake, "accountcontactrelation", RELATION),
        [(contacts, "contact_ref", "contact_id", "client_id"), (accounts, "account_ref", "record_id", "account_id")],
    )
    cases = conform.resolve_surrogates(_crm(lake, "case", CASE), [(contacts, "contact_ref", "contact_id", "client_id")])
    trans = _conform_transactions(_crm(lake, "transaction", TRANSACTION))
    put(_crm(lake, "account", ACCOUNT), "account", "account_id")
    put(_crm(lake, "district", DISTRICT), "district", "district_id")
    put(links, "disp", "disp_id")
    put(trans, "trans", "trans_id")
    put(cases.withColumn("opened_at", F.col("opened_at").try_cast("timestamp_ntz")), "crm_case", "case_id")
    return {"client": rejected}


def silver_sales(lake: Lake, run_id: str, buckets: int = 64) -> dict[str, int]:
    """Applications, previous applications, and the child tables with their orphans set aside."""
    application = conform.prune(_text_keys(_lower(_bronze(lake, "postgres", "application"))), APPLICATION)
    application = application.withColumns({"amt_income_total": F.col("amt_income_total").cast(MONEY), "currency": F.lit("unitless")})
    upsert.upsert(lake, application, "application", ["sk_id_curr"], run_id, buckets)
    previous = _text_keys(_lower(_bronze(lake, "postgres", "previous_application")))
    upsert.upsert(lake, previous, "previous_application", ["sk_id_prev"], run_id, buckets)
    applicants = upsert.read_upserted(lake, "application")
    rejected = {}
    for table, keys in LOAN_CHILDREN.items():
        if not lake.exists("bronze", "postgres", table):
            continue
        child = _text_keys(_lower(_bronze(lake, "postgres", table)))
        # The verdicts feed two tables, so they are written once instead of joined twice.
        lake.write_snapshot(conform.tag_orphans(child, "sk_id_curr", applicants, "sk_id_curr"), "staging", "tagged", table, run_id)
        tagged = lake.read("staging", "tagged", table, run_id)
        upsert.upsert(lake, conform.clean(tagged), table, list(keys), run_id, buckets)
        rejected[table] = upsert.quarantine(lake, tagged.where(F.col(conform.VERDICT).isNotNull()), f"{table}_orphans", run_id)
        lake.unstage("tagged", table, run_id)
    return rejected


def silver_fraud(lake: Lake, run_id: str, buckets: int = 64) -> None:
    bronze = _bronze(lake, "mssql", "paysim_transactions")
    upsert.upsert(lake, conform.conform_card_txn(bronze), "card_txn", ["txn_id"], run_id, buckets)


def silver_marketing(lake: Lake) -> None:
    """Baseline with the change log laid over it; the log carries row images."""
    state = _bronze(lake, "teradata", "bank_marketing")
    if lake.exists("bronze", "teradata", "bank_marketing_cdc"):
        events = _bronze(lake, "teradata", "bank_marketing_cdc")
        state = conform.overlay_changes(state, events, "customer_id")
    rows = conform.conform_campaign(state).withColumn("avg_yearly_balance", F.col("avg_yearly_balance").cast(MONEY))
    # The overlay is the whole current state, so customers deleted at the source leave as well.
    lake.write_snapshot(conform.dedup_latest(rows, ["customer_id"]), "silver", "campaign_response")


def silver_core_banking(lake: Lake, run_id: str, buckets: int = 64) -> None:
    """API accounts and transactions; account ids stay raw as keys, a derived column is masked."""
    accounts = _bronze(lake, "obp", "accounts").select(
        F.col("id").alias("account_id"), "bank_id", "label", mask_last4(F.col("id")).alias("account_id_last4")
    )
    transactions = _bronze(lake, "obp", "transactions").select(
        F.col("id").alias("transaction_id"),
        F.col("this_account.id").alias("account_id"),
        F.col("details.completed").alias("txn_ts"),
        F.col("details.description").alias("description"),
        F.col("details.value.amount").try_cast("double").alias("amount"),
        F.col("details.value.currency").alias("currency"),
    )
    upsert.upsert(lake, accounts, "obp_accounts", ["account_id"], run_id, buckets)
    upsert.upsert(lake, transactions, "obp_transactions", ["transaction_id"], run_id, buckets)


def _silver(lake: Lake, table: str) -> DataFrame:
    return lake.read("silver", table).drop(BUCKET)


def currency_gate(lake: Lake) -> None:
    """Stops the Gold build when a monetary value has no currency tag."""
    checked = None
    for table, columns in MONETARY.items():
        part = quality.currency_tags(_silver(lake, table), table, [(c, "currency") for c in columns])
        checked = part if checked is None else checked.unionByName(part)
    quality.require_currency_tags(checked)


def gold_dimensions(lake: Lake, xwalk: DataFrame, fx: DataFrame, first_day: str, last_day: str) -> None:
    lake.write_snapshot(xwalk, "gold", "dim_customer_xwalk", partition_by=["source_system"])
    xwalk = lake.read("gold", "dim_customer_xwalk")
    lake.write_snapshot(fx, "gold", "dim_fx_rate")
    span = lake.spark.sql(f"select date'{first_day}' as first_day, date'{last_day}' as last_day")
    lake.write_snapshot(star.dim_date(span), "gold", "dim_date")
    ranked = xwalk.select("customer_id", "source_system", "native_key", "source_priority_rank")

    def candidates(source: str, table: DataFrame, key: str, columns: list[str]) -> DataFrame:
        if "updated_at" not in table.columns:
            table = table.withColumn("updated_at", F.lit(None).cast("string"))
        attributes = table.select(F.col(key).alias("native_key"), *columns, F.col("updated_at").cast("string").alias("updated_at"))
        return ranked.where(F.col("source_system") == source).join(attributes, "native_key", "left").drop("source_system")

    core = candidates("berka", _silver(lake, "client"), "client_id", ["birth_date", "gender", "district_id"])
    loans = candidates("home_credit", _silver(lake, "application"), "sk_id_curr", [])
    golden = identity.survivorship(xwalk, [core, loans])
    lake.write_snapshot(
        golden.select("customer_id", "source_priority_rank", "birth_date", "gender", "district_id"), "gold", "dim_customer"
    )
    lake.write_snapshot(star.dim_campaign_response(_silver(lake, "campaign_response")), "gold", "dim_campaign_response")
    lake.write_snapshot(star.bridge_customer_account(_silver(lake, "disp"), xwalk), "gold", "bridge_customer_account")


# The feeds of the transaction fact: Bronze table, Silver table, its key, and the source system of its rows in the fact.
TXN_FEEDS = {
    ("mssql", "paysim_transactions"): ("card_txn", "txn_id", "paysim"),
    ("salesforce", "transaction"): ("trans", "trans_id", "berka"),
}
PERIOD = ("txn_year", "txn_month")


def transaction_facts(lake: Lake) -> None:
    """Transactions and fraud from all of Silver. Periods that no longer exist are gone afterwards; all loads are taken."""
    xwalk, fx = lake.read("gold", "dim_customer_xwalk"), lake.read("gold", "dim_fx_rate")
    taken = {feed: increments.all_loads(lake, *feed) for feed in TXN_FEEDS}
    raw_cards = _bronze(lake, "mssql", "paysim_transactions")
    txns = star.fact_txn(_silver(lake, "card_txn"), raw_cards, _silver(lake, "trans"), _silver(lake, "disp"), xwalk, fx)
    lake.write_snapshot(txns, "gold", "fact_txn", partition_by=PERIOD)
    lake.write_snapshot(star.fraud_of_transactions(lake.read("gold", "fact_txn")), "gold", "fact_card_fraud", partition_by=PERIOD)
    for feed, loads in taken.items():
        known = set(increments.new_loads(lake, "fact_txn", *feed))
        increments.take(lake, "fact_txn", *feed, [x for x in loads if x in known], "full")


def gold_facts(lake: Lake) -> None:
    """All facts, built anew."""
    transaction_facts(lake)
    xwalk, fx = lake.read("gold", "dim_customer_xwalk"), lake.read("gold", "dim_fx_rate")
    lake.write_snapshot(star.fact_loan_application(_silver(lake, "application"), xwalk), "gold", "fact_loan_application")
    previous = star.fact_previous_application(_silver(lake, "previous_application"), xwalk)
    lake.write_snapshot(previous, "gold", "fact_previous_application")
    lake.write_snapshot(star.fact_crm_case(_silver(lake, "crm_case"), xwalk), "gold", "fact_crm_case")
    lake.write_snapshot(star.latest_balance(_silver(lake, "trans"), fx), "gold", "fact_account_balance")
    behavior = star.fact_repayment_behavior(
        _silver(lake, "installments_payments"), _silver(lake, "credit_card_balance"), _silver(lake, "pos_cash_balance"), xwalk
    )
    lake.write_snapshot(behavior, "gold", "fact_repayment_behavior")


def follow_transactions(lake: Lake, run_id: str, buckets: int = 64) -> dict[str, int]:
    """New loads of both transaction feeds into Silver, then into the transaction and fraud facts; loads and periods.

    Of Bronze only the new loads are read, of Silver only the buckets of their keys, and of the facts only the periods
    in which a changed transaction stood or stands. Customers come from the crosswalk as it is; ``relink_facts`` follows a
    changed one. Without facts yet, everything is built.
    """
    loads = {feed: increments.new_loads(lake, "fact_txn", *feed) for feed in TXN_FEEDS}
    pending = {feed: found for feed, found in loads.items() if found}
    if not pending:
        return {"loads": 0, "periods": 0}
    raw = {feed: increments.rows_of(lake, *feed, found).drop("dt", "load_id") for feed, found in pending.items()}
    changed, current = [], {}
    for feed, rows in raw.items():
        table, key, system = TXN_FEEDS[feed]
        conformed = conform.conform_card_txn(rows) if system == "paysim" else _conform_transactions(_crm_names(rows, TRANSACTION))
        upsert.upsert(lake, conformed, table, [key], run_id, buckets)
        ids = conformed.select(key).where(F.col(key).isNotNull()).distinct()
        keys = with_bucket(ids, [key], lake.layout("silver", table)["buckets"])
        touched = F.broadcast(keys.select(BUCKET).distinct())  # at most a row for each bucket
        current[table] = lake.read("silver", table).join(touched, BUCKET, "left_semi").join(keys, [BUCKET, key], "left_semi").drop(BUCKET)
        changed.append(ids.select(F.lit(system).alias("source_system"), F.col(key).alias("txn_id")))
    if not lake.exists("gold", "fact_txn"):
        transaction_facts(lake)
        return {"loads": sum(map(len, pending.values())), "periods": lake.read("gold", "fact_txn").select(*PERIOD).distinct().count()}
    # A feed without new loads takes part with no rows; its files are not read.
    cards = current.get("card_txn", _silver(lake, "card_txn").where("false"))
    trans = current.get("trans", _silver(lake, "trans").where("false"))
    bronze = raw.get(("mssql", "paysim_transactions"), _bronze(lake, "mssql", "paysim_transactions").where("false"))
    fresh = star.fact_txn(cards, bronze, trans, _silver(lake, "disp"), lake.read("gold", "dim_customer_xwalk"), lake.read("gold", "dim_fx_rate"))
    lake.write_snapshot(fresh, "staging", "fresh", "fact_txn", run_id)
    fresh = lake.read("staging", "fresh", "fact_txn", run_id)
    keys = reduce(DataFrame.unionByName, changed)
    periods = increments.follow(lake, "fact_txn", ["source_system", "txn_id"], keys, fresh, PERIOD, run_id)
    frauds = keys.where("source_system = 'paysim'").select("txn_id")
    increments.follow(lake, "fact_card_fraud", ["txn_id"], frauds, star.fraud_of_transactions(fresh), PERIOD, run_id)
    for feed, found in pending.items():
        increments.take(lake, "fact_txn", *feed, found, run_id)
    lake.unstage("fresh", "fact_txn", run_id)
    return {"loads": sum(map(len, pending.values())), "periods": periods}


def follow_crosswalk(lake: Lake, xwalk: DataFrame, run_id: str) -> dict[str, int]:
    """IDN-10: a newer crosswalk takes the place of the old one, and fact rows it can link now are linked.

    Only keys that the old crosswalk did not have are looked up, and only files that may hold an unresolved row of theirs
    are written. Rows that have a customer keep it. Returns the rows linked by fact.
    """
    old = lake.read("gold", "dim_customer_xwalk").select("source_system", "native_key")
    added = lake.stage(lambda: xwalk.join(old, ["source_system", "native_key"], "left_anti"), "relink", run_id, "added")
    linked = relink_facts(lake, added, run_id)
    lake.write_snapshot(lake.stage(lambda: xwalk, "relink", run_id, "xwalk"), "gold", "dim_customer_xwalk", partition_by=["source_system"])
    lake.unstage("relink", run_id, "added")
    lake.unstage("relink", run_id, "xwalk")
    return linked


def relink_facts(lake: Lake, added: DataFrame, run_id: str) -> dict[str, int]:
    """IDN-10: links rows without a customer, or of the unknown member, through the given crosswalk rows."""
    cards = _bronze(lake, "mssql", "paysim_transactions").groupBy("txn_id").agg(F.max("nameOrig").alias("native_key"))
    owners = identity.primary_owner(_silver(lake, "disp")).withColumnRenamed("client_id", "native_key")
    of = {name: identity.source_slice(added, name) for name in ("paysim", "berka")}
    txns = _silver(lake, "trans").select(F.col("trans_id").alias("txn_id"), "account_id").join(owners.join(of["berka"], "native_key"), "account_id")
    cases = _silver(lake, "crm_case").select("case_id", F.col("client_id").alias("native_key")).join(of["berka"], "native_key")
    paid = cards.join(of["paysim"], "native_key").select(F.concat(F.lit("paysim|"), "txn_id").alias("key"), "customer_id")
    both = paid.unionByName(txns.select(F.concat(F.lit("berka|"), "txn_id").alias("key"), "customer_id"))
    own = F.col("txn_id")
    facts = {
        "fact_txn": (F.concat("source_system", F.lit("|"), own), both),
        "fact_card_fraud": (F.concat(F.lit("paysim|"), own), paid),
        "fact_crm_case": (F.col("case_id"), cases.select(F.col("case_id").alias("key"), "customer_id")),
    }
    linked = {}
    for table, (key, lookup) in facts.items():
        if lake.exists("gold", table):
            linked[table] = _relink(lake, table, key, lookup, run_id)
    return linked


def _relink(lake: Lake, table: str, key: Column, lookup: DataFrame, run_id: str) -> int:
    plan = ("relink", run_id, table)
    unresolved = F.coalesce(F.col("customer_id") == identity.UNKNOWN_MEMBER, F.lit(True))
    names = lookup.select(F.col("key").alias("_key"), F.col("customer_id").alias("_customer"))

    def open_rows() -> DataFrame:
        """The rows that can be linked now; a fact has few without a customer, so they are found by column first."""
        column = "case_id" if table == "fact_crm_case" else "txn_id"
        rows = lake.read("gold", table).where(unresolved).select(F.col(column).alias("id"), key.alias("_key"))
        return rows.join(names, "_key").select("id", "_key", "_customer")

    found = lake.stage(open_rows, *plan, "found")

    def kept(rows: DataFrame) -> DataFrame:
        by_key = found.select(F.col("_key").alias("_found"), "_customer").distinct()
        met = skew_safe_join(rows.withColumn("_key", key), by_key, "_key", "_found")
        now = F.when(unresolved & F.col("_customer").isNotNull(), F.col("_customer")).otherwise(F.col("customer_id"))
        return met.withColumn("customer_id", now).select(*rows.columns)

    column = "case_id" if table == "fact_crm_case" else "txn_id"
    hit = [] if lake.is_staged(*plan, "rows") else fileindex.files_with(lake, "gold", table, key=column, values=found.select("id"))
    fileindex.rewrite_files(lake, "gold", table, files=hit, keep=kept, plan=(*plan, "rows"))
    n = found.count()
    lake.unstage(*plan)
    return n


def gold_marts(lake: Lake, as_of: str) -> None:
    """All marts from the Gold tables; the segment thresholds are those of the first run."""
    gold = {
        name: lake.read("gold", name)
        for name in (
            "dim_customer", "dim_campaign_response", "bridge_customer_account", "fact_txn", "fact_card_fraud", "fact_loan_application",
            "fact_previous_application", "fact_crm_case", "fact_account_balance", "fact_repayment_behavior",
        )
    }
    customers, txns, loans = gold["dim_customer"], gold["fact_txn"], gold["fact_loan_application"]
    campaign, fraud, cases = gold["dim_campaign_response"], gold["fact_card_fraud"], gold["fact_crm_case"]
    balances = gold["fact_account_balance"]
    write_once(lake, lambda: marts.segment_thresholds(loans, balances), "gold", "segment_thresholds")
    limits = lake.read("gold", "segment_thresholds")
    built = {
        "mart_customer_360": marts.customer_360(customers, txns, loans, campaign),
        "mart_fraud_daily": marts.fraud_daily(fraud),
        "mart_fraud_followup": marts.fraud_followup(fraud, cases),
        "mart_loan_funnel": marts.loan_funnel(loans, gold["fact_previous_application"]),
        "mart_risk_segment": marts.risk_segment(loans, campaign, limits),
        "mart_cross_sell": marts.cross_sell(customers, txns, loans, gold["bridge_customer_account"], balances, campaign, limits),
        "mart_dormancy": marts.dormancy(customers, txns, as_of),
        "mart_daily_flows": marts.daily_flows(txns, balances),
        "mart_spending": marts.spending_distribution(txns, loans, limits),
        "mart_repayment_risk": marts.repayment_risk(gold["fact_repayment_behavior"], loans),
    }
    for name, mart in built.items():
        lake.write_snapshot(mart, "gold", name)


def _erasure_targets(lake: Lake) -> list[tuple[str, str, str, str]]:
    """``(layer, table, kind of key, column)`` of the tables that name customers, in the order they are cleaned."""
    silver = {**KEYED_TABLES, **NATIVE_TABLES}
    for path in lake.files.glob(lake.path("silver", "quarantine_*")):
        table = path.rstrip("/").rsplit("/", 1)[1]
        names = lake.read("silver", table).columns if lake.exists("silver", table) else []
        found = [k for k in (*NATIVE_TABLES.values(), ("customer", "customer_id")) if k[1] in names]
        silver |= {table: k for k in found[:1]}
    gold = {"fact_account_balance": ("account", "account_id")}
    gold |= {t: ("customer", "customer_id") for t in [*CUSTOMER_TABLES, *CUSTOMER_FACTS, "dim_customer_xwalk"]}
    return [(layer, t, *k) for layer, tables in (("silver", silver), ("gold", gold)) for t, k in tables.items()]


def erase(lake: Lake, erased: DataFrame, run_id: str) -> DataFrame:
    """IDN-11: remove customers from every Silver and Gold table that names them; counts per table.

    A table names a customer by id, by a native key, by a transaction of theirs or by an account whose holders all leave.
    Only files that may hold such a key are read and written, as the key index tells. The crosswalk goes last, since native
    keys come from it, and the keys are written before anything is removed: a run that dies is repeated under the same run
    id. Bronze keeps its verbatim copies until the source's own retention removes them.
    """
    gone = lake.stage(lambda: _gone_keys(lake, erased), "erase", run_id, "keys")
    report: list[tuple[str, int | None, int]] = []
    for layer, table, kind, key in _erasure_targets(lake):
        plan = ("erase", run_id, layer, table)
        if not lake.exists(layer, table) and not lake.is_staged(*plan):
            continue
        keys = gone.where(F.col("kind") == kind).select(F.col("key").alias("customer_id"))

        def kept(rows: DataFrame) -> DataFrame:
            renamed = rows.withColumnRenamed(key, "customer_id") if key != "customer_id" else rows
            return identity.erase_customers(renamed, keys).select(*renamed.columns).toDF(*rows.columns)

        before = None if lake.is_staged(*plan) else upsert.rows_in(lake, layer, table)
        hit = [] if lake.is_staged(*plan) else fileindex.files_with(lake, layer, table, key=key, values=keys)
        fileindex.rewrite_files(lake, layer, table, files=hit, keep=kept, plan=plan)
        report.append((f"{layer}.{table}", before, upsert.rows_in(lake, layer, table)))
    lake.unstage("erase", run_id, "keys")
    return lake.spark.createDataFrame(report, "table_name string, rows_before bigint, rows_after bigint")


def _gone_keys(lake: Lake, erased: DataFrame) -> DataFrame:
    """``(kind, key)``: all keys under which the erased customers appear."""
    customers = erased.select("customer_id").where("customer_id is not null").distinct()
    found = [customers.select(F.lit("customer").alias("kind"), F.col("customer_id").alias("key"))]
    xwalk = lake.read("gold", "dim_customer_xwalk").join(customers, "customer_id", "left_semi")
    found.append(xwalk.select(F.col("source_system").alias("kind"), F.col("native_key").alias("key")))
    if lake.exists("gold", "fact_txn"):
        txns = lake.read("gold", "fact_txn").join(customers, "customer_id", "left_semi")
        found.append(txns.select(F.concat("source_system", F.lit(" txn")).alias("kind"), F.col("txn_id").alias("key")))
    if lake.exists("gold", "bridge_customer_account"):
        found.append(accounts_left(lake.read("gold", "bridge_customer_account"), customers).select(F.lit("account").alias("kind"), F.col("account_id").alias("key")))
    return reduce(DataFrame.unionByName, found).distinct()


def accounts_left(bridge: DataFrame, customers: DataFrame) -> DataFrame:
    """The accounts whose holders are all among ``customers``; a holder who is not known keeps an account."""
    marked = bridge.join(customers.select(F.col("customer_id").alias("_gone")), F.col("customer_id") == F.col("_gone"), "left")
    return marked.groupBy("account_id").agg(F.count_if(F.col("_gone").isNull()).alias("stay")).where("stay = 0").select("account_id")


def health(lake: Lake, pairs: list[tuple[str, str, str]], run_id: str) -> None:
    """Append one ledger row per ``(source, bronze table, silver table)``; a missing table is unreconciled."""
    counts = None
    for source, bronze, silver in pairs:
        def rows(layer: str, *parts: str):
            if not lake.exists(layer, *parts):
                return F.lit(None).cast("bigint")
            return lake.read(layer, *parts).agg(F.count("*")).scalar()

        row = lake.spark.range(1).select(
            F.lit(bronze).alias("table_name"),
            rows("bronze", source, bronze).alias("bronze_row_count"),
            rows("silver", silver).alias("silver_row_count"),
        )
        counts = row if counts is None else counts.unionByName(row)
    # Pulls mark a table under its source's name as well.
    names = {f"{source}.{bronze}": bronze for source, bronze, _ in pairs}
    marks = read_state(lake, "marks").replace(names, subset=["key"])
    state = marts.source_health(counts, marks, read_state(lake, "stages"))
    lake.overwrite_partitions(state.withColumn("run_id", F.lit(run_id)), "gold", "mart_source_health", partition_by=["run_id"])
