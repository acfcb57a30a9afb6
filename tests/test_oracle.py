"""Every query against its SQL, on whole tables. ``PARITY_SF`` picks the scale."""

import os

import pytest

import __spark_entry__ as entry_file
import parity
from tributary.operators import scale
from tributary.plans import registry

SF_DIR = f"/root/testdata/sf{os.environ.get('PARITY_SF', '0.001')}"


@pytest.fixture(scope="module")
def duck():
    con = parity.connect(SF_DIR)
    yield con
    con.close()


@pytest.mark.parametrize("key", sorted(registry.bound()))
def test_matches_sql(spark, duck, key):
    assert parity.differences(entry_file.queries()[key](spark, SF_DIR), duck, entry_file.oracle_sql()[key]) == []


@pytest.mark.parametrize("key", ["fact_txn", "fact_card_fraud", "orphan_rejects", "to_reporting_currency", "quarantine_write", "fraud_followup_events"])
def test_matches_sql_with_salting_forced(spark, duck, key, monkeypatch):
    """Small thresholds send the same queries down the paths meant for large, skewed tables."""
    monkeypatch.setattr(scale.skew_safe_join, "__defaults__", ("left", 20, 0, 0, None))
    assert parity.differences(entry_file.queries()[key](spark, SF_DIR), duck, entry_file.oracle_sql()[key]) == []
