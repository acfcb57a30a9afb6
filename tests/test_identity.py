import pytest
from pyspark.sql import functions as F

from conftest import rows
from tributary.operators import identity as idn

XWALK = "customer_id string, source_system string, native_key string, source_priority_rank int"


def sources(spark, n=300):
    ids = spark.range(n).select(F.col("id").cast("string").alias("k"))
    return [
        idn.KeySource("loans", ids, "k", 3, "L_"),
        idn.KeySource("core", ids, "k", 1, "B_", 0.5),
        idn.KeySource("cards", ids, "k", 4, "C_", 0.4),
    ]


def test_crosswalk_maps_every_key_once(spark):
    xwalk = idn.build_crosswalk(sources(spark)).cache()
    assert xwalk.count() == 900
    assert xwalk.select("source_system", "native_key").distinct().count() == 900
    pool = {r[0] for r in xwalk.where("source_system = 'loans'").select("customer_id").collect()}
    core = [r.customer_id for r in xwalk.where("source_system = 'core'").collect()]
    overlapped = [c for c in core if c in pool]
    assert 100 < len(overlapped) < 200
    assert all(c in pool or c.startswith("B_") for c in core)


def test_crosswalk_is_reproducible(spark):
    shuffled = [idn.KeySource(s.name, s.keys.repartition(7), s.column, s.priority, s.prefix, s.overlap) for s in sources(spark)]
    assert rows(idn.build_crosswalk(sources(spark))) == rows(idn.build_crosswalk(shuffled))


def test_later_source_may_meet_customers_minted_by_an_earlier_one(spark):
    xwalk = idn.build_crosswalk(sources(spark, 2000))
    cards = xwalk.where("source_system = 'cards'")
    assert cards.where("customer_id like 'B#_%' escape '#'").count() > 0
    assert cards.where("customer_id like 'L#_%' escape '#'").count() > 0


def test_customer_identifiers_leave_merchants_out(spark):
    df = spark.createDataFrame([("C1", "M1"), ("C1", "C2"), ("C3", None)], "a string, b string")
    assert rows(idn.customer_identifiers(df, ["a", "b"])) == [("C1",), ("C2",), ("C3",)]


def test_private_resolution_hides_key_and_keeps_grain(spark):
    masked = spark.createDataFrame([("t1", "0001"), ("t2", "0002")], "txn_id string, masked string")
    raw = spark.createDataFrame([("t1", "C0001"), ("t1", "C0001"), ("t2", "C0002")], "txn_id string, raw string")
    xwalk = spark.createDataFrame([("X", "cards", "C0001", 4)], XWALK)
    got = idn.resolve_identity_private(masked, raw, "txn_id", "raw", xwalk, "cards")
    assert "raw" not in got.columns
    assert rows(got) == [("t1", "0001", "X"), ("t2", "0002", None)]


def test_survivorship(spark):
    xwalk = spark.createDataFrame([("one", "core", "1", 1), ("both", "core", "2", 1), ("both", "loans", "9", 3), ("none", "cards", "7", 4)], XWALK)
    ddl = "customer_id string, source_priority_rank int, native_key string, updated_at string, gender string"
    core = spark.createDataFrame([("one", 1, "1", None, "F"), ("both", 1, "2", None, "M"), ("both", 1, "0", "2024", "F"), ("both", 1, "1", "2024", "X")], ddl)
    loans = spark.createDataFrame([("both", 3, "9", "2030")], "customer_id string, source_priority_rank int, native_key string, updated_at string")
    got = {r.customer_id: r.gender for r in idn.survivorship(xwalk, [core, loans]).collect()}
    assert got == {"one": "F", "both": "F", "none": None}


@pytest.mark.parametrize("people, customers", [(40, 100), (100, 40), (0, 5), (7, 7)])
def test_linkage_is_one_to_one_and_whole(spark, people, customers):
    population = spark.range(people).withColumnRenamed("id", "row")
    owners = spark.range(customers).select(F.concat(F.lit("c"), F.col("id")).alias("customer_id"))
    linked = idn.link_without_replacement(population, "row", owners)
    got = linked.collect()
    assert len(got) == min(people, customers)
    assert len({r.row for r in got}) == len({r.customer_id for r in got}) == len(got)
    assert rows(linked) == rows(idn.link_without_replacement(population.repartition(9), "row", owners.repartition(3)))


def test_unknown_member_and_relink(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, key string")
    old = spark.createDataFrame([("X", "core", "a", 1)], XWALK)
    new = spark.createDataFrame([("X2", "core", "a", 1), ("Y", "core", "b", 1)], XWALK)
    first = idn.unknown_member(idn.resolve_identity(facts, old, "core", "key"))
    assert rows(first.select("id", "customer_id")) == [(1, "X"), (2, "-1"), (3, "-1")]
    again = idn.relink_unknown(first, new, "core", "key")
    assert rows(again.select("id", "customer_id")) == [(1, "X"), (2, "Y"), (3, "-1")]


def test_erasure_keeps_unresolved_rows(spark):
    table = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "customer_id string, v int")
    gone = spark.createDataFrame([("a",), ("a",)], "customer_id string")
    for skew in ({}, {"rows_per_task": 1, "small_bytes": 0, "broadcast_bytes": 0}):
        assert rows(idn.erase_customers(table, gone, **skew)) == sorted([("b", 2), (None, 3)], key=repr)


def test_primary_owner_is_one_per_account(spark):
    disp = spark.createDataFrame([("a", "1", "OWNER"), ("a", "2", "OWNER"), ("a", "0", "DISPONENT"), ("b", "5", "DISPONENT")], "account_id string, client_id string, type string")
    assert rows(idn.primary_owner(disp)) == [("a", "1")]


def test_primary_link_prefers_owner(spark):
    disp = spark.createDataFrame([("1", "c", "a9", "OWNER"), ("2", "c", "a1", "DISPONENT"), ("3", "d", "a1", "DISPONENT")], "disp_id string, client_id string, account_id string, type string")
    primary, rest = idn.primary_link(disp)
    assert rows(primary.select("disp_id")) == [("1",), ("3",)]
    assert rows(rest.select("disp_id")) == [("2",)]


def test_summary(spark):
    xwalk = spark.createDataFrame([("a", "x", "1", 1), ("a", "x", "2", 1), ("b", "x", "3", 1), ("b", "y", "1", 2)], XWALK)
    assert dict(rows(idn.crosswalk_summary(xwalk))) == {"rows:x": 3, "rows:y": 1, "customers": 2, "multi_source_customers": 1}


def test_relink_keeps_rows_without_customer(spark):
    xwalk = spark.createDataFrame([("C1", "berka", "k1", "1")], "customer_id string, source_system string, native_key string, source_priority_rank string")
    facts = spark.createDataFrame([(1, "k1", "-1"), (2, "k1", None), (3, "k2", None), (4, "k9", "C9")], "id long, client string, customer_id string")
    again = idn.relink_unknown(facts, xwalk, "berka", "client")
    assert rows(again.select("id", "customer_id")) == [(1, "C1"), (2, "C1"), (3, "-1"), (4, "C9")]


def test_a_source_with_overlap_is_read_once(spark):
    ids = spark.range(777).select(F.col("id").cast("string").alias("k"))
    xwalk = idn.build_crosswalk([*sources(spark)[:2], idn.KeySource("cards", ids, "k", 4, "C_", 0.4)])
    assert xwalk._jdf.queryExecution().optimizedPlan().toString().count("Range (0, 777") == 1
    cards = rows(xwalk.where("source_system = 'cards'").select("native_key", "customer_id"))
    minted = [(k, c) for k, c in cards if c == f"C_{k}"]
    assert len(cards) == len({k for k, _ in cards}) == 777 and 777 * 0.5 < len(minted) < 777 * 0.7
    assert {c for _, c in cards} - {c for _, c in minted} <= {r[0] for r in xwalk.where("source_system <> 'cards'").select("customer_id").collect()}
