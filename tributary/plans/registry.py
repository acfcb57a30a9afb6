"""Every operator bound to the given tables: ``key -> callable(spark, sf_dir)``."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import as_double, decode_birth_number, mask_last4, stable_row_id
from ..operators import conform, control, identity, maintenance, prepare, promotion, quality, upsert
from ..schemas import CONTRACTS, FX_RATE, HEALTH, SERVING, conform_to, schema, schema_drift
from ..sources import files, landing, pulls
from ..streaming import jobs
from . import jobs as stages
from . import marts, star
from .workspace import Workspace

AS_OF = "2024-01-31"
CORE_AS_OF = "2001-08-01"
CUTOVER = "1999-01-01"
LANDED_AT = "2024-02-01 00:00:00"
RELANDED_AT = "2024-02-02 00:00:00"
CHANGES = schema(seq="long", op="string", pk_value="string", changed_at="string", label="string", amount="double")

# Dates whose landed drop is damaged on purpose after landing.
NO_MARKER, EDITED, EXTRA_COLUMN, RETYPED, SHORT, NO_MANIFEST = (
    "2024-01-05", "2024-01-09", "2024-01-13", "2024-01-17", "2024-01-21", "2024-01-25"
)

QUERIES: dict[str, Callable[[Workspace], DataFrame]] = {}


def query(fn: Callable[[Workspace], DataFrame]) -> Callable[[Workspace], DataFrame]:
    """Register under the function's name; a trailing underscore only avoids an import's name."""
    QUERIES[fn.__name__.removesuffix("_")] = fn
    return fn


def bound() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: fn(Workspace(spark, sf_dir))

    return {name: bind(fn) for name, fn in QUERIES.items()}


def money(df: DataFrame, *columns: str, digits: int = 2) -> DataFrame:
    return df.withColumns({c: as_double(F.col(c), digits) for c in columns})


# ---------------------------------------------------------------- sources

@query
def incremental_pull_interval(ws):
    events = ws.entities.table("events")
    pulled = pulls.pull_interval(events, "ts", "2024-01-10 00:00:00", "2024-01-11 00:00:00")
    return pulled.select("event_id", "ts", "user_id", "value")


@query
def incremental_pull_watermark(ws):
    events = ws.entities.table("events")
    earlier = pulls.pull_interval(events, "ts", "2023-12-01 00:00:00", "2024-01-20 00:00:00")
    mark = earlier.agg(F.max("ts")).scalar()
    return pulls.pull_since(events, "ts", mark).select("event_id", "ts", "user_id", "value")


@query
def incremental_pull_full(ws):
    return pulls.high_water_mark(pulls.pull_full(ws.entities.table("orders")), "o_orderdate")


@query
def incremental_pull_projected(ws):
    return pulls.pull_object(
        ws.entities.table("events"), ["event_id", "user_id", "ts"], "ts",
        since="2024-01-05 00:00:00", until="2024-01-25 00:00:00", extra=F.col("event_type") != "view",
    )


@query
def cdc_poll(ws):
    log = ws.entities.change_log()
    offset = log.where(F.col("changed_at") < F.lit("2024-01-25").cast("timestamp_ntz")).agg(F.max("seq")).scalar()
    return pulls.poll_changes(log, offset).select("seq", "op", "pk_value", "changed_at")


@query
def initial_snapshot(ws):
    lake = ws.scratch("initial_snapshot")
    baseline = ws.entities.change_baseline()
    first = pulls.initial_snapshot(lake, baseline, "campaign", "baseline")
    second = pulls.initial_snapshot(lake, baseline.withColumn("label", F.lit("late")), "campaign", "baseline")
    return lake.read("bronze", "campaign", "baseline").withColumns({"first_wrote": F.lit(first), "second_wrote": F.lit(second)})


def landed_changes(ws: Workspace, name: str, source: str = "campaign", table: str = "changes"):
    lake = ws.scratch(name)
    landing.land(lake, ws.entities.landed_changes(), source, table, LANDED_AT, "json", seq="seq")
    return lake


@query
def landing_scan(ws):
    lake = landed_changes(ws, "landing_scan")
    rows = landing.scan_landing(lake, "campaign", "changes", CHANGES, "json")
    return rows.select("dt", "seq", "op", "pk_value", "label", "amount")


@query
def landing_write(ws):
    lake = landed_changes(ws, "landing_write")
    # Landing a date again replaces that date.
    again = ws.entities.landed_changes().where(F.col("dt") == "2024-01-03")
    landing.land(lake, again, "campaign", "changes", RELANDED_AT, "json", seq="seq")
    listed = landing.list_partitions(lake, "campaign", "changes")
    manifests = landing.read_manifests(lake, "campaign", "changes").drop("written_at", "reconciled", "checksum")
    return listed.join(manifests, promotion.PARTITION)


@query
def delimited_scan(ws):
    lake = ws.scratch("delimited")
    path = lake.path("landing", "legacy", "customer")
    ws.entities.table("customer").write.option("header", True).option("sep", ";").option("quoteAll", True).csv(path)
    declared = schema(c_custkey="long", c_name="string", c_nationkey="integer", c_acctbal="double", c_mktsegment="string")
    return files.read_delimited(ws.spark, path, ["c_custkey", "c_acctbal"], declared)


# ---------------------------------------------------------------- sinks

@query
def bronze_append(ws):
    """A promoted date dropped again with other content is appended next to the first copy."""
    lake = landed_changes(ws, "bronze_append")
    promotion.promote(lake, "campaign", "changes", CHANGES, "json", "run-1")
    again = ws.entities.landed_changes().where(F.col("dt") == "2024-01-15").withColumn("amount", F.col("amount") + 1)
    landing.land(lake, again, "campaign", "changes", RELANDED_AT, "json", seq="seq")
    promotion.promote(lake, "campaign", "changes", CHANGES, "json", "run-2")
    bronze = lake.read("bronze", "campaign", "changes")
    return bronze.groupBy(F.col("dt").cast("string").alias("dt")).agg(
        F.count("*").alias("row_count"), F.count_distinct("load_id").alias("loads"),
        as_double(F.sum(F.col("amount").cast("decimal(18,2)"))).alias("amount"),
    )


@query
def scd1_overwrite(ws):
    lake = ws.scratch("scd1")
    customers = ws.entities.table("customer")
    lake.write_snapshot(customers.withColumn("c_acctbal", F.lit(0.0)), "gold", "customer")
    lake.write_snapshot(customers, "gold", "customer")
    return lake.read("gold", "customer")


@query
def partitioned_fact_write(ws):
    """Writing the fact twice leaves it once."""
    lake = ws.scratch("fact_write")
    fact = ws.gold("fact_txn")
    for _ in range(2):
        lake.overwrite_partitions(fact, "gold", "fact_txn", partition_by=["txn_year", "txn_month"])
    return lake.read("gold", "fact_txn").groupBy("txn_year", "txn_month").agg(
        F.count("*").alias("txn_count"), as_double(F.sum("amount")).alias("amount")
    )


@query
def upsert_single_key(ws):
    lake = ws.scratch("upsert_single")
    baseline = ws.entities.change_baseline().select(
        F.col("customer_key").alias("pk_value"), "label", "amount", F.lit("2023-01-01").cast("timestamp_ntz").alias("updated_at")
    )
    changes = ws.entities.change_log().select("pk_value", "label", "amount", F.col("changed_at").alias("updated_at"))
    upsert.upsert(lake, baseline, "state", ["pk_value"], "run-1", buckets=16)
    upsert.upsert(lake, changes, "state", ["pk_value"], "run-2", buckets=16)
    return upsert.read_upserted(lake, "state")


@query
def upsert_composite_key(ws):
    lake = ws.scratch("upsert_composite")
    lines = ws.entities.table("lineitem").withColumnRenamed("l_shipdate", "updated_at")
    tiebreak = ("l_partkey", "l_suppkey", "l_extendedprice")
    keys = ["l_orderkey", "l_linenumber"]
    upsert.upsert(lake, lines.where("l_returnflag <> 'R'"), "lines", keys, "run-1", buckets=16, tiebreak=tiebreak)
    upsert.upsert(lake, lines.where("l_returnflag = 'R'"), "lines", keys, "run-2", buckets=16, tiebreak=tiebreak)
    return upsert.read_upserted(lake, "lines").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice", "l_partkey", "updated_at"
    )


@query
def quarantine_write(ws):
    lake = ws.scratch("quarantine")
    upsert.split_write(lake, ws.child_tagged("installments"), "installments_split", "run-1")
    return lake.read("silver", "installments_split").groupBy("outcome", "reason").agg(
        F.count("*").alias("row_count"), as_double(F.sum("amt_instalment")).alias("amount")
    )


@query
def control_state_latest(ws):
    log = ws.entities.table("events").selectExpr("event_type as key", "cast(event_id as string) as value", "ts as written_at")
    return control.latest_state(log)


@query
def serving_view_typed(ws):
    view = conform_to(ws.gold("fact_loan_application"), SERVING["fact_loan_application"])
    view.createOrReplaceTempView("serving_fact_loan_application")
    return ws.spark.table("serving_fact_loan_application")


# ---------------------------------------------------------------- promotion

def damaged_landing(ws: Workspace, name: str):
    """All days landed, then some of them damaged the way transport damages drops."""
    lake = landed_changes(ws, name)
    base = lake.path("landing", "campaign", "changes")
    rows = ws.entities.landed_changes()

    def rewrite(date: str, change) -> None:
        day = change(rows.where(F.col("dt") == date).drop("dt"))
        day.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{base}/dt={date}")

    rewrite(EDITED, lambda df: df.withColumn("amount", F.col("amount") + 1))
    lake.files.delete(f"{base}/dt={NO_MARKER}/_SUCCESS")
    for date, change in (
        (EXTRA_COLUMN, lambda df: df.withColumn("channel", F.lit("web"))),
        (RETYPED, lambda df: df.withColumn("amount", F.col("amount").cast("string"))),
    ):
        landing.land(lake, change(rows.where(F.col("dt") == date)), "campaign", "changes", RELANDED_AT, "json", seq="seq")
    rewrite(SHORT, lambda df: df.where("op <> 'D'"))
    _drop_control(lake, "manifests", landing.MANIFEST, F.col("dt") == NO_MANIFEST)
    # The short drop keeps honest checksums, so only the row count can expose it.
    _drop_control(lake, "checksums", landing.CHECKSUM, F.col("dt") == SHORT)
    honest = landing.payload_checksums(lake, "campaign", "changes", [SHORT])
    lake.append(honest.withColumn("written_at", F.lit(RELANDED_AT).cast("timestamp_ntz")), "control", "checksums")
    return lake


def _drop_control(lake, topic: str, ddl: str, gone) -> None:
    kept = lake.spark.read.schema(ddl).parquet(lake.path("control", topic)).where(~gone)
    lake.write_snapshot(kept, "staging", "control", topic)
    lake.write_snapshot(lake.read("staging", "control", topic, schema=ddl), "control", topic)


def _all_dates(lake) -> list[str]:
    return [landing._dt_of(p) for p in lake.files.glob(lake.path("landing", "campaign", "changes") + "/dt=*")]


@query
def partition_verdicts(ws):
    lake = damaged_landing(ws, "verdicts")
    judged = promotion.judge(lake, "campaign", "changes", CHANGES, "json", _all_dates(lake))
    return judged.select("dt", "verdict", "row_count")


@query
def payload_checksum(ws):
    lake = damaged_landing(ws, "checksum")
    report = promotion.checksum_report(lake, "campaign", "changes")
    return report.select("dt", (F.col("bad_files") == 0).alias("payload_intact"))


@query
def rowcount_reconcile(ws):
    lake = damaged_landing(ws, "rowcount")
    report = promotion.row_count_report(lake, "campaign", "changes", CHANGES, "json")
    return report.select("dt", "rows_promised", "rows_found", (F.col("rows_promised") == F.col("rows_found")).alias("reconciled"))


@query
def schema_drift_(ws):
    """The drift of a new drop of orders against the last good Bronze schema."""
    lake = ws.scratch("drift")
    orders = ws.entities.table("orders")
    lake.write_snapshot(orders, "bronze", "core", "orders")
    changed = orders.drop("o_orderpriority").withColumns(
        {"o_channel": F.lit("web"), "o_totalprice": F.col("o_totalprice").cast("string")}
    )
    lake.write_snapshot(changed, "landing", "core", "orders")
    drift = schema_drift(ws.spark, lake.read("bronze", "core", "orders").schema, lake.read("landing", "core", "orders").schema)
    held_back = lake.read("landing", "core", "orders").agg(F.count("*")).scalar()
    return drift.select("column_name", "change", held_back.alias("rows_held_back"))


@query
def promote_landing(ws):
    """Two runs in a row: good days once in Bronze, damaged days still waiting."""
    lake = damaged_landing(ws, "promote")
    promotion.promote(lake, "campaign", "changes", CHANGES, "json", "run-1")
    promotion.promote(lake, "campaign", "changes", CHANGES, "json", "run-2")
    bronze = lake.read("bronze", "campaign", "changes")
    return bronze.select("seq", "op", "pk_value", "label", "amount", F.col("dt").cast("string").alias("dt"))


@query
def extract_to_bronze(ws):
    """Two scheduled runs from pull to Bronze; the second starts at the mark of the first, less the overlap."""
    lake = ws.scratch("extract")
    events = ws.entities.table("events").select("event_id", "ts", "user_id", "value")
    feed = stages.Feed("app", "events", events.schema, file_set="app")
    for run, upto in (("2024-01-15", events.where(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))), ("2024-01-16", events)):
        pulled = pulls.pull_since(upto, "ts", stages.mark(lake, feed, "timestamp_ntz"))
        stages.extract(lake, pulled, feed, run, f"{run} 01:00:00", changed="ts")
        stages.promote_all(lake, [feed], run)
    return lake.read("bronze", "app", "events").select("event_id", "ts", "user_id", "value", F.col("dt").cast("string").alias("dt"))


@query
def pending_partitions(ws):
    lake = damaged_landing(ws, "pending")
    promotion.promote(lake, "campaign", "changes", CHANGES, "json", "run-1")
    return promotion.pending_partitions(lake, "campaign", "changes").select("dt", "has_success")


@query
def redelivered_skip(ws):
    """The same content dropped again, on its own date and on a later one, is recognised and not appended."""
    lake = landed_changes(ws, "redelivered")
    promotion.promote(lake, "campaign", "changes", CHANGES, "json", "run-1")
    day = ws.entities.landed_changes().where(F.col("dt") == "2024-01-03")
    landing.land(lake, day, "campaign", "changes", RELANDED_AT, "json", seq="seq")
    landing.land(lake, day.withColumn("dt", F.lit("2024-02-02")), "campaign", "changes", RELANDED_AT, "json", seq="seq")
    promotion.promote(lake, "campaign", "changes", CHANGES, "json", "run-2")
    ledger = promotion.read_ledger(lake)
    return ledger.groupBy("verdict").agg(F.count("*").alias("drops"), F.sum("row_count").alias("row_count"))


@query
def redelivered_same_run(ws):
    """Two drops with the same content, both pending: one is promoted, the other recognised."""
    lake = ws.scratch("redelivered_same_run")
    rows = ws.entities.landed_changes()
    twice = rows.unionByName(rows.where(F.col("dt") == "2024-01-03").withColumn("dt", F.lit("2024-02-02")))
    landing.land(lake, twice, "campaign", "changes", LANDED_AT, "json", seq="seq")
    return promotion.promote(lake, "campaign", "changes", CHANGES, "json", "run-1").select("dt", "verdict", "row_count")


@query
def promote_bad_values(ws):
    """A day whose whole-number column holds fractions is held back; typing it would make them NULL."""
    lake = ws.scratch("bad_values")
    rows = ws.entities.landed_changes()
    landing.land(lake, rows.where(F.col("dt") != "2024-01-05"), "campaign", "changes", LANDED_AT, "json", seq="seq")
    halves = rows.where(F.col("dt") == "2024-01-05").withColumn("seq", F.col("seq") + 0.5)
    landing.land(lake, halves, "campaign", "changes", LANDED_AT, "json", seq="seq")
    return promotion.promote(lake, "campaign", "changes", CHANGES, "json", "run-1").select("dt", "verdict", "row_count")


@query
def promote_parquet_verdicts(ws):
    """Parquet drops, one day retyped and one with a second file of another shape; no other day suffers."""
    lake = ws.scratch("parquet_verdicts")
    rows = ws.entities.landed_changes()
    landing.land(lake, rows.where(F.col("dt") != "2024-01-05"), "campaign", "changes", LANDED_AT, "parquet", seq="seq")
    retyped = rows.where(F.col("dt") == "2024-01-05").withColumn("amount", F.col("amount").cast("string"))
    landing.land(lake, retyped, "campaign", "changes", LANDED_AT, "parquet", seq="seq")
    extra = rows.where(F.col("dt") == "2024-01-08").withColumn("channel", F.lit("web")).drop("dt")
    extra.write.mode("append").parquet(lake.path("landing", "campaign", "changes") + "/dt=2024-01-08")
    declared = rows.drop("dt").schema
    return promotion.promote(lake, "campaign", "changes", declared, "parquet", "run-1").select("dt", "verdict", "row_count")


@query
def cdc_exactly_once(ws):
    """Bronze holds the log up to a date; a poll redelivers the whole log, its last days twice."""
    log = ws.entities.change_log()
    bronze = log.where(F.col("changed_at") < F.lit("2024-01-20").cast("timestamp_ntz"))
    poll = log.unionByName(log.where(F.col("changed_at") >= F.lit("2024-01-15").cast("timestamp_ntz")))
    tagged = promotion.only_new_changes(poll, bronze).withColumns({"source": F.lit("campaign"), "table_name": F.lit("changes")})
    return tagged.select("source", "table_name", "seq", "op", "pk_value", "changed_at")


@query
def promote_changes(ws):
    """A change log promoted twice: later drops repeat older events among new ones, and Bronze holds each once."""
    lake = ws.scratch("promote_changes")
    rows = ws.entities.landed_changes()
    first = F.col("dt") < "2024-01-20"
    landing.land(lake, rows.where(first), "campaign", "changes", LANDED_AT, "json", seq="seq")
    promotion.promote(lake, "campaign", "changes", CHANGES, "json", "run-1", mode="changes")
    again = rows.where(F.col("dt") >= "2024-01-15").withColumn("dt", F.lit("2024-02-02"))
    landing.land(lake, rows.where(~first).unionByName(again), "campaign", "changes", RELANDED_AT, "json", seq="seq")
    promotion.promote(lake, "campaign", "changes", CHANGES, "json", "run-2", mode="changes")
    return lake.read("bronze", "campaign", "changes").select("seq", "op", "pk_value", "label", "amount")


def outside_drops(ws: Workspace, name: str, verbatim: bool = False):
    """The change log as drops of somebody else: payloads with a ``_manifest.json`` in each date's folder."""
    lake = ws.scratch(name)
    base = lake.path("landing", "campaign", "changes")
    rows = ws.entities.landed_changes()
    writer = rows.write
    if verbatim:  # responses of at most a hundred documents, a file each
        document = F.to_json(F.struct(*[F.col(c) for c in rows.columns if c != "dt"]), {"ignoreNullFields": "false"})
        page = rows.groupBy("dt", F.floor(F.col("seq") / 100).alias("page")).agg(F.collect_list(document).alias("documents"))
        writer = page.select("dt", F.concat(F.lit("[\n"), F.array_join("documents", ",\n"), F.lit("\n]\n")).alias("value")).write.option("maxRecordsPerFile", 1)
    writer.partitionBy("dt").options(**landing.NO_MARKER, ignoreNullFields="false").format("text" if verbatim else "json").save(base)
    for dt, n in rows.groupBy("dt").count().toLocalIterator():  # one row per date
        promised = {"rows_landed": n - (dt == SHORT), "api_reported_total": n + (dt == EDITED) - (dt == SHORT)}
        lake.files.write_text(f"{base}/dt={dt}/_manifest.json", json.dumps(promised))
        lake.files.touch(f"{base}/dt={dt}/_SUCCESS")
    return lake


@query
def manifest_reconcile(ws):
    """A drop whose source reported more rows than it sent, and one whose manifest counts fewer than it holds."""
    lake = outside_drops(ws, "manifest_reconcile")
    return promotion.promote(lake, "campaign", "changes", CHANGES, "json", "run-1").select("dt", "verdict", "row_count")


@query
def promote_api_payload(ws):
    """Verbatim array payloads: every element of the drops that reconcile is a Bronze row."""
    lake = outside_drops(ws, "api_payload", verbatim=True)
    promotion.promote(lake, "campaign", "changes", CHANGES, "json", "run-1", multiline=True)
    bronze = lake.read("bronze", "campaign", "changes")
    return bronze.select("seq", "op", "pk_value", "label", "amount", F.col("dt").cast("string").alias("dt"))


@query
def fileset_complete(ws):
    arrivals = ws.entities.table("events").select(
        F.concat(F.lit("s"), (F.col("user_id") % 10).cast("string")).alias("source"),
        F.to_date("ts").cast("string").alias("dt"), F.col("event_type").alias("table_name"),
    )
    return promotion.complete_sets(arrivals, ["signup", "view", "error"])


# ---------------------------------------------------------------- conforming

@query
def conform_project(ws):
    return conform.project(
        ws.entities.table("customer"),
        {"c_custkey": "client_id", "c_name": "name", "c_nationkey": "district_id", "c_mktsegment": "segment"},
    )


@query
def conform_prune(ws):
    keep = ["sk_id_curr", "target", "amt_income_total", "name_income_type", "organization_type", "currency"]
    return money(conform.prune(ws.entities.application(), keep), "amt_income_total")


@query
def conform_trans(ws):
    return money(ws.trans(), "amount", "balance")


@query
def conform_card_txn(ws):
    return money(ws.card_txn(), "amount")


@query
def conform_campaign(ws):
    return money(conform.conform_campaign(ws.entities.campaign_keyless()), "avg_yearly_balance")


@query
def mask_last4_(ws):
    customers = ws.entities.table("customer").select("c_custkey", F.col("c_custkey").cast("string").alias("account_no"), "c_name")
    return customers.withColumns(
        {"account_no_last4": mask_last4(F.col("account_no")), "c_name": mask_last4(F.col("c_name"))}
    )


@query
def birth_number_decode(ws):
    born = decode_birth_number(F.col("birth_number"))
    return ws.entities.client().select("client_id", born.alias("born")).select("client_id", "born.birth_date", "born.gender", "born.error")


@query
def birth_number_quarantine(ws):
    tagged = conform.tag_birth_number(ws.entities.client()).withColumnRenamed("decode_error", conform.VERDICT)
    return conform.rejects(tagged).select("client_id", "district_id", "reason")


@query
def orphan_clean(ws):
    tagged = conform.tag_orphans(ws.entities.previous_application(), "sk_id_curr", ws.entities.application(), "sk_id_curr")
    return conform.clean(tagged)


@query
def orphan_rejects(ws):
    tagged = conform.tag_orphans(ws.entities.previous_application(), "sk_id_curr", ws.entities.application(), "sk_id_curr")
    return conform.rejects(tagged)


@query
def resolve_surrogate_ids(ws):
    cases = ws.entities.crm_case_surrogate()
    return conform.resolve_surrogates(cases, [(ws.entities.contact(), "contact_ref", "record_id", "client_id")])


@query
def flatten_nested_json(ws):
    """Account transactions as an API delivers them, nested in JSON text, then lifted out."""
    payload = ws.entities.table("events").select(
        F.to_json(
            F.struct(
                F.col("event_id").cast("string").alias("id"),
                F.struct(F.col("user_id").cast("string").alias("id")).alias("this_account"),
                F.struct(
                    F.col("event_type").alias("description"),
                    F.struct(F.col("value").cast("string").alias("amount"), F.lit("MYR").alias("currency")).alias("value"),
                ).alias("details"),
                F.col("props"),
            )
        ).alias("payload")
    )
    ddl = (
        "id string, this_account struct<id: string>, "
        "details struct<description: string, value: struct<amount: string, currency: string>>, props string"
    )
    return conform.flatten_json(payload, "payload", ddl, {
        "transaction_id": "_json.id",
        "account_id": "_json.this_account.id",
        "description": "_json.details.description",
        "amount": "try_cast(_json.details.value.amount as double)",
        "currency": "_json.details.value.currency",
        "k": "from_json(_json.props, 'k bigint').k",
    })


@query
def dedup_latest(ws):
    lines = ws.entities.table("lineitem").withColumnRenamed("l_shipdate", "updated_at")
    latest = conform.dedup_latest(lines, ["l_orderkey", "l_linenumber"], tiebreak=("l_partkey", "l_suppkey", "l_extendedprice"))
    return latest.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "updated_at")


@query
def cdc_latest_state(ws):
    return conform.latest_change_state(ws.entities.change_log())


@query
def cdc_baseline_overlay(ws):
    return conform.overlay_changes(ws.entities.change_baseline(), ws.entities.change_log(), "customer_key")


@query
def conform_table_spec(ws):
    """Spec-driven tables, written by upsert and read back."""
    lake = ws.scratch("specs")
    specs = [
        (conform.TableSpec("trans", ("trans_id",), mask=("partner_account",)), ws.entities.trans_bronze()),
        (conform.TableSpec("previous", ("sk_id_prev",)), ws.entities.previous_application()),
    ]
    counts = None
    for spec, bronze in specs:
        rows = conform.clean(conform.conform_spec(bronze, spec))
        upsert.upsert(lake, rows, spec.name, list(spec.keys), "run-1", buckets=16, tiebreak=spec.keys)
        table = upsert.read_upserted(lake, spec.name)
        masked = F.count_if(F.length(spec.mask[0]) > 4) if spec.mask else F.lit(0).cast("bigint")
        shown = F.count(spec.mask[0]) if spec.mask else F.lit(0).cast("bigint")
        part = table.agg(F.count("*").alias("row_count"), shown.alias("masked_values"), masked.alias("unmasked_values"))
        part = part.withColumn("table_name", F.lit(spec.name))
        counts = part if counts is None else counts.unionByName(part)
    return counts


@query
def active_rows(ws):
    return money(conform.active_rows(ws.entities.application()), "amt_income_total").select("sk_id_curr", "amt_income_total", "is_deleted")


# ---------------------------------------------------------------- identity

@query
def build_crosswalk(ws):
    return ws.build_crosswalk()


@query
def customer_identifiers(ws):
    return identity.customer_identifiers(ws.entities.card_bronze(), ["nameOrig", "nameDest"])


@query
def crosswalk_summary(ws):
    return identity.crosswalk_summary(ws.gold("crosswalk"))


@query
def resolve_identity(ws):
    return identity.resolve_identity(ws.entities.crm_case(), ws.gold("crosswalk"), "berka", "client_id")


@query
def resolve_identity_private(ws):
    cards = ws.card_txn().select("txn_id", "txn_type", "name_orig_masked")
    return identity.resolve_identity_private(cards, ws.entities.card_bronze(), "txn_id", "nameOrig", ws.gold("crosswalk"), "paysim")


@query
def dim_customer(ws):
    return ws.build_dim_customer()


@query
def bridge_customer_account(ws):
    return ws.build_bridge()


@query
def sampled_linkage(ws):
    return ws.campaign_keyed().select("campaign_row", "customer_id")


def _partial_xwalk(ws):
    """An older crosswalk that does not know the customers minted by the core bank yet."""
    return ws.gold("crosswalk").where("not customer_id like 'CUST\\\\_BK\\\\_%'")


@query
def unknown_member(ws):
    resolved = identity.resolve_identity(ws.entities.crm_case(), _partial_xwalk(ws), "berka", "client_id")
    return identity.unknown_member(resolved).groupBy("customer_id").agg(F.count("*").alias("cases"))


@query
def relink_unknown(ws):
    older = identity.unknown_member(
        identity.resolve_identity(ws.entities.crm_case(), _partial_xwalk(ws), "berka", "client_id")
    )
    return identity.relink_unknown(older, ws.gold("crosswalk"), "berka", "client_id").select("case_id", "client_id", "customer_id")


@query
def erase_customers(ws):
    """Customers who defaulted and asked to be forgotten disappear from every Gold table that names them.

    Account balances go where all holders of the account go. Tables are written, and only files with a hit are rewritten.
    """
    lake = ws.scratch("erase")
    erased = ws.gold("fact_loan_application").where("target = 1").select("customer_id").distinct()
    tables = {n: t for n, t in gold_tables(ws).items() if "customer_id" in t.columns or n == "fact_account_balance"}
    for name, table in tables.items():
        lake.write_snapshot(table, "gold", name, partition_by=stages.PERIOD if name in stages.CUSTOMER_FACTS else ())
    accounts = stages.accounts_left(lake.read("gold", "bridge_customer_account"), erased)
    lake.write_snapshot(accounts, "staging", "accounts")
    stages.erase(lake, erased, "run-1")
    report = None
    for name, table in tables.items():
        key, gone = ("account_id", lake.read("staging", "accounts")) if name == "fact_account_balance" else ("customer_id", erased)
        kept = lake.read("gold", name)
        row = table.agg(F.count("*").alias("rows_before")).withColumns({
            "table_name": F.lit(name), "rows_after": kept.agg(F.count("*")).scalar(),
            "rows_of_erased": kept.join(gone, key, "left_semi").agg(F.count("*")).scalar(),
        })
        report = row if report is None else report.unionByName(row)
    return report


def _crm_transactions(ws):
    """The account transactions in the shape in which the CRM delivers them."""
    t, text = ws.entities.trans_bronze(), lambda c: F.col(c).cast("string")
    return t.select(
        F.col("trans_id").alias("berka_trans_id__c"), F.col("account_id").alias("berka_account_id__c"), text("trans_date").alias("trans_date__c"),
        F.col("trans_type").alias("trans_type__c"), F.lit("x").alias("operation__c"), text("amount").alias("amount__c"),
        text("balance").alias("balance__c"), F.lit(None).cast("string").alias("k_symbol__c"), F.lit("AB").alias("bank__c"),
        F.col("partner_account").alias("partner_account__c"),
    )


def _load(lake, rows, source, table, dt, load_id):
    tagged = rows.withColumns({"dt": F.lit(dt), "load_id": F.lit(load_id)})
    lake.overwrite_partitions(tagged, "bronze", source, table, partition_by=["dt", "load_id"])


@query
def incremental_facts(ws):
    """GLD-06: the transaction fact after three loads. The last one corrects amounts and moves rows out of a wrong month."""
    lake = ws.scratch("increments")
    lake.write_snapshot(ws.entities.disp(), "silver", "disp")
    lake.write_snapshot(ws.gold("crosswalk"), "gold", "dim_customer_xwalk", partition_by=["source_system"])
    lake.write_snapshot(ws.fx, "gold", "dim_fx_rate")
    cards, accounts = ws.entities.card_bronze(), _crm_transactions(ws)
    wrong, early = F.col("txn_id").cast("bigint") % 7 == 0, F.col("txn_ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    stale = cards.where(wrong & early).withColumns({"amount": F.col("amount") + 1, "txn_ts": F.col("txn_ts") - F.expr("interval 90 days")})
    old = F.col("trans_date__c") < "1998"
    steps = [
        [("paysim_transactions", stale.unionByName(cards.where(~wrong & early))), ("transaction", accounts.where(old))],
        [("paysim_transactions", cards.where(~early)), ("transaction", accounts.where(~old))],
        [("paysim_transactions", cards.where(wrong & early))],
    ]
    for day, parts in enumerate(steps, 1):
        for table, rows in parts:
            _load(lake, rows, "salesforce" if table == "transaction" else "mssql", table, f"2024-02-0{day}", f"00000000000{day}")
        stages.follow_transactions(lake, f"run-{day}", buckets=8)
    return conform_to(lake.read("gold", "fact_txn"), SERVING["fact_txn"])


@query
def relink_facts(ws):
    """IDN-10: facts built on an older crosswalk point at the unknown member, then a newer crosswalk arrives."""
    lake = ws.scratch("relink")
    cards, trans, disp = ws.card_txn(), ws.trans(), ws.entities.disp()
    for name, table in {"disp": disp, "trans": trans, "crm_case": ws.entities.crm_case()}.items():
        lake.write_snapshot(table, "silver", name)
    _load(lake, ws.entities.card_bronze(), "mssql", "paysim_transactions", "2024-02-01", "000000000001")
    lake.write_snapshot(_partial_xwalk(ws), "gold", "dim_customer_xwalk", partition_by=["source_system"])
    older = lake.read("gold", "dim_customer_xwalk")
    txns = star.fact_txn(cards, ws.entities.card_bronze(), trans, disp, older, ws.fx)
    lake.write_snapshot(identity.unknown_member(txns), "gold", "fact_txn", partition_by=stages.PERIOD)
    lake.write_snapshot(identity.unknown_member(star.fact_crm_case(ws.entities.crm_case(), older)), "gold", "fact_crm_case")
    stages.follow_crosswalk(lake, ws.gold("crosswalk"), "run-1")
    txns = lake.read("gold", "fact_txn").select(F.concat("source_system", F.lit("|"), "txn_id").alias("row_id"), "customer_id")
    return txns.unionByName(lake.read("gold", "fact_crm_case").select(F.concat(F.lit("case|"), "case_id").alias("row_id"), "customer_id"))


# ---------------------------------------------------------------- dimensions and facts

@query
def dim_date(ws):
    first = ws.entities.table("orders").agg(F.min("o_orderdate").cast("date").alias("first_day"))
    last = ws.entities.table("events").agg(F.max("ts").cast("date")).scalar()
    return star.dim_date(first.withColumn("last_day", last))


@query
def dim_fx_rate(ws):
    """The rate table with how many monetary rows carry each currency."""
    return _rates_in_use(ws, ws.fx)


@query
def seed_fx_rates(ws):
    """SRC-11: the same from a seed file, with a header and an empty field where a currency has no rate."""
    lake = ws.scratch("seed")
    path = lake.path("staging", "seed", "fx_rates")
    ws.fx.coalesce(1).write.option("header", True).option("emptyValue", "").csv(path)
    chosen = files.prefer_full(ws.spark, path + "_full", path)
    return _rates_in_use(ws, files.read_seed_csv(ws.spark, chosen, FX_RATE))


def _rates_in_use(ws, fx):
    e = ws.entities
    tags = None
    for df in (e.card_bronze(), ws.trans(), e.application(), e.campaign_keyless()):
        part = df.groupBy("currency").agg(F.count("*").alias("n"))
        tags = part if tags is None else tags.unionByName(part)
    used = tags.groupBy(F.col("currency").alias("currency_code")).agg(F.sum("n").alias("tagged_rows"))
    rates = fx.select("currency_code", F.col("rate_to_myr").cast("double").alias("rate_to_myr"), "rate_as_of")
    return rates.join(used, "currency_code", "left").fillna(0, ["tagged_rows"])


@query
def to_reporting_currency(ws):
    amounts = ws.entities.campaign_keyless().select(
        F.concat(F.lit("c"), F.col("campaign_row").cast("string")).alias("row_id"), F.col("balance").alias("amount"), "currency"
    ).unionByName(ws.trans().select(F.concat(F.lit("t"), "trans_id").alias("row_id"), "amount", "currency")).unionByName(
        ws.entities.application().select(F.concat(F.lit("a"), "sk_id_curr").alias("row_id"), F.col("amt_income_total").alias("amount"), "currency")
    )
    out = star.to_reporting_currency(amounts, "amount", "currency", "amount_myr", ws.fx)
    return money(money(out, "amount"), "amount_myr", digits=6)


@query
def fact_account_balance(ws):
    return money(money(ws.build_balances(), "current_balance"), "current_balance_myr", digits=6)


@query
def dim_campaign_response(ws):
    return money(star.dim_campaign_response(conform.conform_campaign(ws.campaign_keyed())), "avg_yearly_balance")


@query
def fact_txn(ws):
    return conform_to(ws.build_fact_txn(), SERVING["fact_txn"])


@query
def fact_card_fraud(ws):
    return money(money(ws.build_fact_card_fraud(), "amount"), "amount_myr", digits=6)


@query
def fact_loan_application(ws):
    return money(ws.build_fact_loan_application(), "amt_income_total")


@query
def fact_previous_application(ws):
    return star.fact_previous_application(ws.entities.previous_application(), ws.gold("crosswalk"))


@query
def fact_crm_case(ws):
    return ws.build_fact_crm_case()


@query
def installment_behavior(ws):
    return star.installment_behavior(ws.gold("installments"))


@query
def card_utilization(ws):
    return star.card_utilization(ws.gold("card_balance"))


@query
def pos_dpd(ws):
    return star.pos_dpd(ws.gold("pos_balance"))


@query
def fact_repayment_behavior(ws):
    return ws.build_repayment()


# ---------------------------------------------------------------- marts

@query
def customer_360(ws):
    return marts.customer_360(ws.gold("dim_customer"), ws.gold("fact_txn"), ws.gold("fact_loan_application"), ws.gold("campaign"))


@query
def fraud_daily(ws):
    return marts.fraud_daily(ws.gold("fact_card_fraud"))


@query
def fraud_mom(ws):
    return marts.fraud_mom(ws.gold("fact_card_fraud"))


@query
def fraud_followup_events(ws):
    return marts.fraud_followup_events(ws.gold("fact_card_fraud"), ws.gold("fact_crm_case"))


@query
def fraud_followup(ws):
    return marts.fraud_followup(ws.gold("fact_card_fraud"), ws.gold("fact_crm_case"))


@query
def loan_funnel(ws):
    return marts.loan_funnel(ws.gold("fact_loan_application"), ws.entities.previous_application())


@query
def segment_thresholds(ws):
    exact = marts.segment_thresholds(ws.gold("fact_loan_application"), ws.gold("balances"))
    return money(exact, "income_p25", "income_p75", "balance_p50", digits=6)


@query
def risk_segment(ws):
    return marts.risk_segment(ws.gold("fact_loan_application"), ws.gold("campaign"), ws.thresholds())


@query
def default_rate_by_segment(ws):
    return marts.default_rate_by_segment(ws.gold("fact_loan_application"), ws.thresholds())


@query
def active_high_risk(ws):
    return marts.active_high_risk(ws.gold("fact_loan_application"), ws.gold("fact_txn"), ws.thresholds(), AS_OF)


def _cross_sell(ws):
    return marts.cross_sell(
        ws.gold("dim_customer"), ws.gold("fact_txn"), ws.gold("fact_loan_application"), ws.gold("bridge"),
        ws.gold("balances"), ws.gold("campaign"), ws.thresholds(),
    )


@query
def cross_sell(ws):
    return _cross_sell(ws)


@query
def cross_sell_ranked(ws):
    return marts.cross_sell_ranked(_cross_sell(ws), CORE_AS_OF)


@query
def dormancy(ws):
    return marts.dormancy(ws.gold("dim_customer"), ws.gold("fact_txn"), AS_OF)


@query
def daily_flows(ws):
    return marts.daily_flows(ws.gold("fact_txn"), ws.gold("balances"))


@query
def daily_flows_pivot(ws):
    return marts.daily_flows_pivot(ws.gold("fact_txn"))


@query
def spending_distribution(ws):
    return marts.spending_distribution(ws.gold("fact_txn"), ws.gold("fact_loan_application"), ws.thresholds())


@query
def source_health(ws):
    """Layer counts of the loan and campaign tables with their marks and stage status."""
    e = ws.entities
    lake = ws.scratch("health")
    tables = {
        "installments": (e.installments_bronze(), ws.gold("installments"), "updated_at"),
        "card_balance": (e.card_balance_bronze(), ws.gold("card_balance"), "updated_at"),
        "campaign": (e.campaign_keyless(), ws.gold("campaign"), "created_at"),
    }
    counts = None
    for name, (bronze, silver, column) in tables.items():
        loaded = bronze.agg(F.count("*").alias("bronze_row_count"), F.max(column).alias("mark")).withColumn("table_name", F.lit(name))
        row = loaded.withColumn("silver_row_count", silver.agg(F.count("*")).scalar())
        counts = row if counts is None else counts.unionByName(row)
    lake.write_snapshot(counts, "staging", "counts")
    counts = lake.read("staging", "counts")
    written = F.lit(LANDED_AT).cast("timestamp_ntz").alias("written_at")
    control.record_state(lake, "marks", counts.select(F.col("table_name").alias("key"), F.col("mark").cast("string").alias("value"), written))
    control.record_state(lake, "stages", counts.select(F.col("table_name").alias("key"), F.lit("success").alias("value"), written))
    health = marts.source_health(counts.drop("mark"), control.read_state(lake, "marks"), control.read_state(lake, "stages"))
    lake.append(conform_to(health.withColumn("run_id", F.lit("run-1")), HEALTH), "gold", "source_health")
    return lake.read("gold", "source_health", schema=HEALTH)


@query
def repayment_risk(ws):
    return marts.repayment_risk(ws.gold("repayment"), ws.gold("fact_loan_application"))


@query
def repayment_signal(ws):
    return marts.repayment_signal(marts.repayment_risk(ws.gold("repayment"), ws.gold("fact_loan_application")))


@query
def cold_tier_aggregate(ws):
    return marts.cold_tier(ws.entities.campaign_keyless(), CUTOVER)


@query
def hot_cold_union(ws):
    return marts.hot_cold_union(ws.entities.campaign_keyless(), CUTOVER)


@query
def topk_customers(ws):
    return marts.topk_customers(customer_360(ws), "total_txn_value", 20)


# ---------------------------------------------------------------- quality

@query
def dq_currency_tags(ws):
    e = ws.entities
    # A feed that lost its tag on refused lines: the gate must count them.
    untagged = ws.trans().withColumn("currency", F.when(F.col("type") != "VYBER", F.col("currency")))
    return (
        quality.currency_tags(e.card_bronze(), "card_txn", [("amount", "currency"), ("newbalance", "currency")])
        .unionByName(quality.currency_tags(untagged, "trans", [("amount", "currency"), ("balance", "currency")]))
        .unionByName(quality.currency_tags(e.application(), "application", [("amt_income_total", "currency")]))
        .unionByName(quality.currency_tags(e.change_baseline(), "baseline", [("amount", "currency")]))
    )


@query
def dq_not_null(ws):
    return quality.not_null(
        ws.entities.installments_bronze(), "installments", ["sk_id_prev", "sk_id_curr", "days_entry_payment", "amt_payment"]
    ).unionByName(quality.not_null(ws.gold("fact_txn"), "fact_txn", ["txn_id", "customer_id", "amount_myr"]))


def gold_tables(ws: Workspace) -> dict[str, DataFrame]:
    """The Gold tables under the names of their contracts."""
    return {
        "fact_txn": ws.gold("fact_txn"), "fact_card_fraud": ws.build_fact_card_fraud(),
        "fact_loan_application": ws.gold("fact_loan_application"), "dim_customer": ws.gold("dim_customer"),
        "dim_customer_xwalk": ws.gold("crosswalk"), "dim_date": dim_date(ws), "dim_fx_rate": ws.fx,
        "dim_campaign_response": dim_campaign_response(ws), "fact_crm_case": ws.build_fact_crm_case(),
        "fact_previous_application": fact_previous_application(ws), "fact_account_balance": ws.gold("balances"),
        "bridge_customer_account": ws.gold("bridge"), "fact_repayment_behavior": ws.gold("repayment"),
    }


@query
def serving_views_all(ws):
    """Every Gold table in its serving types, with the rows and the values that survive the casts, by column."""
    parts = []
    for name, table in gold_tables(ws).items():
        view = conform_to(table, SERVING[name])
        counted = view.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in view.columns])
        parts.append(counted.unpivot(["_rows"], view.columns, "column_name", "non_null").select(
            F.lit(name).alias("table_name"), "column_name", F.col("_rows").alias("row_count"), "non_null"
        ))
    return reduce(DataFrame.unionByName, parts)


@query
def dq_contracts(ws):
    """The declared contract of every Gold table, one row per clause."""
    return reduce(DataFrame.unionByName, [quality.held_to(t, name, CONTRACTS[name]) for name, t in gold_tables(ws).items()])


@query
def dq_suffix_leak(ws):
    """Masked originators against the raw ones: nothing beyond four characters may show; a column masked too weakly does."""
    cards = ws.card_txn().select("name_orig_masked", F.lit(None).cast("string").alias("hidden"))
    weak = ws.entities.card_bronze().select(F.right("nameOrig", F.lit(6)).alias("name_orig_masked"), F.lit("none").alias("hidden"))
    raw = ws.entities.card_bronze()
    columns = ["name_orig_masked", "hidden"]
    return quality.suffix_leaks(cards, "card_txn", columns, raw, "nameOrig").unionByName(
        quality.suffix_leaks(weak, "card_txn_weak", columns, raw, "nameOrig")
    )


@query
def dq_unique(ws):
    return quality.unique(
        ws.entities.table("lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]
    ).unionByName(quality.unique(ws.gold("fact_txn"), "fact_txn", ["source_system", "txn_id"])).unionByName(
        quality.unique(ws.gold("bridge"), "bridge", ["account_id"])
    )


@query
def dq_reconcile(ws):
    e = ws.entities
    pairs = [("installments", e.installments_bronze(), ws.gold("installments")), ("pos_balance", e.pos_balance_bronze(), ws.gold("pos_balance"))]
    counts = None
    for name, bronze, silver in pairs:
        row = bronze.agg(F.count("*").alias("bronze_row_count")).withColumns(
            {"table_name": F.lit(name), "silver_row_count": silver.agg(F.count("*")).scalar()}
        )
        counts = row if counts is None else counts.unionByName(row)
    return quality.reconcile(counts)


@query
def dq_null_rate(ws):
    columns = ["sk_id_prev", "days_entry_payment", "amt_payment", "amt_instalment"]
    return quality.null_rate(ws.entities.installments_bronze(), "installments", columns, warn=0.01, block=0.5)


@query
def dq_null_rate_scoped(ws):
    """Merchants carry no balance; leaving them out, no balance may be missing."""
    cards = ws.entities.card_bronze().withColumn("dest_balance", F.when(~F.col("nameDest").startswith("M"), F.col("newbalance")))
    return quality.null_rate(
        cards, "card_txn", ["dest_balance", "amount"], warn=0.0, block=0.5, scope=~F.col("nameDest").startswith("M")
    )


@query
def dq_balance_reconcile(ws):
    signed = F.when(F.col("type") == "purchase", -F.col("amount")).otherwise(F.col("amount"))
    return quality.balance_reconcile(ws.entities.card_bronze(), "type", "oldbalance", signed, "newbalance")


@query
def dq_encoding(ws):
    return quality.encoding(ws.entities.table("documents"), ["text", "lang", "source"])


@query
def dq_linkage_coverage(ws):
    return quality.linkage_coverage(ws.gold("dim_customer"), ws.gold("campaign"))


@query
def dq_disagreement(ws):
    signal = ws.gold("campaign").select("customer_id", "credit_in_default")
    both = ws.gold("fact_loan_application").join(signal, "customer_id", "left")
    return quality.disagreement(both, F.col("target") == 1, F.col("credit_in_default"))


@query
def dq_unknown_growth(ws):
    cases = identity.unknown_member(
        identity.resolve_identity(ws.entities.crm_case(), _partial_xwalk(ws), "berka", "client_id")
    )
    per_run = cases.groupBy(F.to_date("opened_at").alias("run_date"), "case_type").agg(
        F.count_if(F.col("customer_id") == identity.UNKNOWN_MEMBER).alias("unknown_rows")
    )
    return quality.unknown_growth(per_run, "run_date", "case_type", "unknown_rows")


@query
def dq_grain(ws):
    return (
        quality.grain(ws.gold("fact_txn"), "fact_txn", ["source_system", "txn_id"])
        .unionByName(quality.grain(ws.gold("crosswalk"), "crosswalk", ["source_system", "customer_id"]))
        .unionByName(quality.grain(ws.gold("bridge"), "bridge", ["customer_id"]))
        .unionByName(quality.grain(ws.gold("repayment"), "repayment", ["customer_id"]))
    )


@query
def dq_no_raw_identifier(ws):
    serving = ws.card_txn().select("txn_type", "name_orig_masked", "currency")
    return quality.no_raw_identifier(
        serving, "card_txn", ["txn_type", "name_orig_masked", "currency"], ws.entities.card_bronze(), "nameOrig"
    )


# ---------------------------------------------------------------- maintenance

def _small_files(ws, name: str):
    lake = ws.scratch(name)
    lake.append(ws.gold("fact_txn").repartition(16, "customer_id").drop("txn_year", "txn_month"), "gold", "fact_txn")
    return lake


def _content(df: DataFrame) -> DataFrame:
    return df.groupBy("source_system", "txn_type").agg(F.count("*").alias("txn_count"), as_double(F.sum("amount")).alias("amount"))


@query
def compact_table(ws):
    lake = _small_files(ws, "compact")
    changed = maintenance.compact(lake, "gold", "fact_txn", run_id="run-1")
    again = maintenance.compact(lake, "gold", "fact_txn", run_id="run-2")
    return _content(lake.read("gold", "fact_txn")).withColumns({"rewritten": F.lit(changed), "rewritten_again": F.lit(again)})


@query
def cluster_table(ws):
    lake = _small_files(ws, "cluster")
    maintenance.cluster(lake, "gold", "fact_txn", key="customer_id", run_id="run-1", target_bytes=1024 * 1024)
    return _content(lake.read("gold", "fact_txn"))


@query
def cluster_table_multi(ws):
    """Clustered by customer and amount at once."""
    lake = _small_files(ws, "cluster_multi")
    maintenance.cluster_multi(lake, "gold", "fact_txn", keys=["customer_id", "amount"], run_id="run-1", target_bytes=1024 * 1024)
    return _content(lake.read("gold", "fact_txn"))


@query
def compact_bronze(ws):
    """Loads in many small files become one file each and keep their ids, also those that read like numbers."""
    lake = ws.scratch("compact_bronze")
    log = ws.entities.change_log().withColumn("dt", F.date_format("changed_at", "yyyy-MM-dd"))
    ids = F.concat(F.lpad(F.dayofmonth("changed_at").cast("string"), 8, "0"), F.lit("e001"))
    lake.write_snapshot(log.withColumn("load_id", ids).repartition(4, "seq"), "bronze", "campaign", "changes", partition_by=["dt", "load_id"])
    maintenance.compact(lake, "bronze", "campaign", "changes", run_id="run-1")
    kept = lake.read("bronze", "campaign", "changes")
    return kept.groupBy("dt", "load_id").agg(F.count("*").alias("row_count"), F.sum("seq").alias("seq_sum"))


@query
def expire_landing(ws):
    """Old promoted days leave the landing zone; days that failed promotion stay."""
    lake = damaged_landing(ws, "expire")
    promotion.promote(lake, "campaign", "changes", CHANGES, "json", "run-1")
    maintenance.expire_landing(lake, "campaign", "changes", "2024-01-31", 7)
    return landing.list_partitions(lake, "campaign", "changes").select("dt")


# ---------------------------------------------------------------- preparation

@query
def date_rebase(ws):
    orders = ws.entities.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    return prepare.rebase_dates(orders, "order_date", "2026-07-05", "rebased_date")


@query
def step_to_timestamp(ws):
    return ws.entities.table("events").select(
        "event_id", prepare.step_to_timestamp(F.col("event_id") % 744 + 1, "2026-06-01").alias("txn_ts")
    )


@query
def stable_row_id_(ws):
    """Ids from natural columns; the audit columns show they are unique and repeatable."""
    return ws.entities.table("events").select("event_id", stable_row_id(F.lit("events"), F.col("event_id")).alias("row_id"))


@query
def audit_stamp(ws):
    orders = ws.entities.table("orders").select("o_orderkey", "o_totalprice")
    return prepare.audit_stamp(orders, "2026-07-05 00:00:00", "CZK")


@query
def hash_sample(ws):
    return prepare.hash_sample(ws.entities.table("orders"), "o_orderkey", 1000, "prepare.orders").select("o_orderkey", "o_custkey")


@query
def capped_group_sample(ws):
    return prepare.capped_group_sample(ws.entities.trans_bronze(), "account_id", "trans_id", 3, "prepare.trans").select("account_id", "trans_id")


@query
def coordinated_sample(ws):
    e = ws.entities
    accounts, links, clients = prepare.coordinated_sample(
        e.disp().select("account_id").distinct(), "account_id", 50, "prepare.account",
        [
            (e.disp(), "account_id", "account_id", "disp"),
            (e.client(), "client_id", "client_id", "client"),
        ],
    )
    txns = e.trans_bronze().join(accounts, "account_id", "left_semi")
    return (
        accounts.select(F.lit("account").alias("table_name"), F.col("account_id").alias("key"))
        .unionByName(links.select(F.lit("disp").alias("table_name"), F.col("disp_id").alias("key")))
        .unionByName(clients.select(F.lit("client").alias("table_name"), F.col("client_id").alias("key")))
        .unionByName(txns.select(F.lit("trans").alias("table_name"), F.col("trans_id").alias("key")))
    )


@query
def primary_link(ws):
    primary, rest = identity.primary_link(ws.entities.disp())
    return primary.withColumn("link", F.lit("primary")).unionByName(rest.withColumn("link", F.lit("secondary"))).drop("disp_id")


# ---------------------------------------------------------------- streaming

def redelivered_landing(ws: Workspace, name: str):
    """The change log in daily drops, with three days delivered again under a later date."""
    lake = landed_changes(ws, name)
    again = ws.entities.landed_changes().where(F.col("dt").between("2024-01-10", "2024-01-12")).withColumn("dt", F.lit("2024-02-01"))
    landing.land(lake, again, "campaign", "changes", RELANDED_AT, "json", seq="seq")
    return lake


@query
def stream_promote(ws):
    lake = redelivered_landing(ws, "stream_promote")
    for _ in range(2):  # the second run starts from the checkpoint and adds nothing
        stream = jobs.landing_stream(lake, "campaign", "changes", CHANGES, files_per_trigger=16)
        jobs.stream_promote(lake, stream, "changes").awaitTermination()
    return lake.read("bronze", "changes").select("seq", "op", "pk_value", "label", "amount")


@query
def stream_dedup(ws):
    lake = redelivered_landing(ws, "stream_dedup")
    stream = jobs.landing_stream(lake, "campaign", "changes", CHANGES, files_per_trigger=16)
    stream = stream.withColumn("changed_at", F.col("changed_at").cast("timestamp"))
    jobs.stream_dedup(lake, stream, "changes", "changed_at", "40 days").awaitTermination()
    return lake.read("bronze", "changes").select("seq", "op", "pk_value")


@query
def stream_latest_state(ws):
    lake = redelivered_landing(ws, "stream_state")
    stream = jobs.landing_stream(lake, "campaign", "changes", CHANGES, files_per_trigger=16)
    jobs.stream_latest_state(lake, stream.drop("dt", "changed_at"), "state", buckets=8).awaitTermination()
    return jobs.current_state(lake, "state").select("pk_value", "seq", "op", "label", "amount")


@query
def stream_fraud_window(ws):
    lake = ws.scratch("stream_window")
    lake.write_snapshot(ws.card_txn().select("updated_at", "is_fraud"), "silver", "card_txn")
    stream = ws.spark.readStream.schema("updated_at timestamp_ntz, is_fraud boolean").parquet(lake.path("silver", "card_txn"))
    stream = stream.withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    jobs.stream_fraud_window(lake, stream, "fraud_window", "updated_at", "1 hour").awaitTermination()
    return lake.read("gold", "fraud_window").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query
def stream_windows_with_late(ws):
    """STR-04: cards arrive in files, newest day first; windows and late rows together hold every row."""
    lake = ws.scratch("stream_late")
    cards = ws.card_txn().select(F.col("updated_at").cast("timestamp").alias("updated_at"), "is_fraud")
    day = F.to_date("updated_at")
    lake.append(cards.where(day >= "2024-01-20").coalesce(1), "silver", "card_txn")
    lake.append(cards.where(day < "2024-01-10").coalesce(1), "silver", "card_txn")
    lake.append(cards.where((day >= "2024-01-10") & (day < "2024-01-20")).coalesce(1), "silver", "card_txn")
    stream = ws.spark.readStream.schema("updated_at timestamp, is_fraud boolean").option("maxFilesPerTrigger", 1).parquet(lake.path("silver", "card_txn"))
    jobs.stream_windows_with_late(lake, stream, "w", "updated_at", "1 hour").awaitTermination()
    counted = jobs.window_counts(lake, "w").select("window_start", "txn_count", "fraud_count")
    late = jobs.late_table(lake, "w").groupBy(F.date_trunc("hour", "updated_at").alias("window_start")).agg(
        F.count("*").alias("txn_count"), F.count_if("is_fraud").alias("fraud_count")
    )
    whole = counted.unionByName(late).groupBy("window_start").agg(F.sum("txn_count").alias("txn_count"), F.sum("fraud_count").alias("fraud_count"))
    return whole.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
