"""What the physical plans must and must not contain."""

import pytest

import __spark_entry__ as entry_file
from tributary.operators import identity, scale
from tributary.plans import oracles, registry
from tributary.plans.workspace import Workspace
from tributary.sources import pulls

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def ws(spark):
    return Workspace(spark, SF)


def test_interval_pull_reaches_the_scan(ws):
    events = ws.entities.table("events")
    text = plan(pulls.pull_interval(events, "ts", "2024-01-10 00:00:00", "2024-01-11 00:00:00").select("event_id"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts,2024-01-09T23:55), LessThan(ts,2024-01-11T00:00)]" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_source_slice_prunes_partitions(ws):
    text = plan(identity.source_slice(ws.gold("crosswalk"), "berka"))
    assert "PartitionFilters: [isnotnull(source_system" in text


def test_marts_read_only_their_columns(ws):
    text = plan(registry.QUERIES["fraud_daily"](ws))
    assert "ReadSchema: struct<txn_ts:timestamp_ntz,txn_type:string,amount:decimal(18,2)>" in text
    assert text.count("Exchange hashpartitioning") == 1


def test_period_filter_prunes_the_fact(ws):
    text = plan(ws.gold("fact_txn").where("txn_year = 2024 and txn_month = 1").select("txn_id"))
    assert "PartitionFilters: [isnotnull(txn_year" in text


PURE = [
    "customer_360", "fraud_mom", "fraud_followup", "loan_funnel", "risk_segment", "cross_sell_ranked", "dormancy",
    "daily_flows", "spending_distribution", "repayment_signal", "build_crosswalk", "dim_customer", "fact_txn",
    "sampled_linkage", "dedup_latest", "cdc_baseline_overlay", "birth_number_decode", "flatten_nested_json",
]


@pytest.mark.parametrize("key", PURE)
def test_no_python_and_no_cartesian_product(ws, key):
    text = plan(registry.QUERIES[key](ws))
    for unwanted in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in text


@pytest.mark.parametrize("name", ["installments", "card_balance", "pos_balance"])
def test_lines_of_a_loan_move_once(spark, ws, name, monkeypatch):
    """Meeting the loan, finding the latest version and judging the applicant take one shuffle of the lines."""
    monkeypatch.setattr(scale.skew_safe_join, "__defaults__", ("left", scale.ROWS_PER_TASK, 0, 0, None))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(ws.child_tagged(name))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert text.count("Exchange hashpartitioning(sk_id_prev") == 1
    after = text[: text.index("SortMergeJoin [sk_id_prev")]
    assert "Window [" in after and "Exchange" not in after


def test_top_k_is_not_a_global_sort(ws):
    assert "TakeOrderedAndProject" in plan(registry.QUERIES["topk_customers"](ws))


def test_thresholds_stay_in_the_plan(ws):
    text = plan(registry.QUERIES["default_rate_by_segment"](ws))
    assert "Subquery" in text


def test_changed_inputs_get_their_own_tables(spark, tmp_path):
    first = Workspace(spark, f"{tmp_path}").root
    spark.range(1).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    assert Workspace(spark, f"{tmp_path}").root != first


def test_entry_contract(spark):
    df = entry_file.entry(spark)
    assert df.columns == ["customer_id", "txn_count", "loan_count", "has_term_deposit", "total_txn_value", "product_count"]
    assert df.count() > 0
    assert set(registry.bound()) == set(oracles.statements())
    assert set(registry.bound()) <= set(entry_file.queries()) and set(oracles.statements()) <= set(entry_file.oracle_sql())


def test_no_hidden_row_limits():
    """Row limits exist only in the top-k reports."""
    import inspect

    limited = [k for k, fn in registry.QUERIES.items() if ".limit(" in inspect.getsource(fn)]
    assert limited == []


def test_no_row_limits_in_the_library():
    """Only the top-k report cuts rows; everything else reads whole tables."""
    import pathlib

    import tributary

    root = pathlib.Path(tributary.__file__).parent
    found = {
        f"{path.relative_to(root)}" for path in root.rglob("*.py") if "llm" not in path.parts
        for line in path.read_text().splitlines() if ".limit(" in line or ".sample(" in line or ".head(" in line or ".take(" in line and "increments.take(" not in line
    }
    assert found == {"plans/marts.py"}
