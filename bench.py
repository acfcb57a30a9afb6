"""Headline timings: builds of the shared tables, then the queries over them.

Prints one JSON line. ``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tributary.plans import registry  # noqa: E402
from tributary.plans.workspace import Workspace  # noqa: E402
from tributary.session import build_session  # noqa: E402

TABLES = [
    "crosswalk", "campaign", "dim_customer", "installments", "card_balance", "pos_balance", "balances",
    "bridge", "fact_loan_application", "fact_crm_case", "fact_txn", "fact_card_fraud", "repayment",
]
WARM_UP = ["active_rows", "fraud_daily"]
QUERIES = [
    "build_crosswalk", "fact_txn", "fact_card_fraud", "dim_customer", "fact_account_balance", "sampled_linkage",
    "customer_360", "fraud_daily", "fraud_mom", "fraud_followup", "loan_funnel", "segment_thresholds", "risk_segment",
    "default_rate_by_segment", "active_high_risk", "cross_sell_ranked", "dormancy", "daily_flows", "spending_distribution",
    "repayment_signal", "hot_cold_union", "topk_customers", "dedup_latest", "orphan_rejects", "cdc_latest_state",
    "cdc_baseline_overlay", "cdc_exactly_once", "birth_number_decode", "upsert_composite_key", "promote_landing",
    "incremental_facts", "relink_facts", "erase_customers", "compact_bronze", "cluster_table_multi", "stream_windows_with_late",
    "dq_unique", "dq_null_rate", "dq_grain", "hash_sample", "capped_group_sample",
]


def drain(df) -> None:
    """Compute every row and column without moving them to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    ws = Workspace(spark, sf_dir)
    timings: dict[str, float] = {}
    for name in TABLES:
        start = time.perf_counter()
        ws.gold(name)
        timings[f"build:{name}"] = round(time.perf_counter() - start, 3)
    ws.thresholds()
    queries = registry.bound()
    for name in WARM_UP:
        drain(queries[name](spark, sf_dir))
    for name in QUERIES:
        start = time.perf_counter()
        drain(queries[name](spark, sf_dir))
        timings[name] = round(time.perf_counter() - start, 3)
    total = round(sum(timings.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "build_and_query_wall_time", "value": total, "unit": "sec", "queries": timings, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
