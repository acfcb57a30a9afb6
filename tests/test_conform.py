import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tributary.operators import conform, upsert

EVENT = "seq bigint, op string, pk_value string, label string"


def test_prune_skips_missing_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert conform.prune(df, ["b", "zzz"]).columns == ["b"]


def test_dedup_latest_is_order_independent(spark):
    data = [("a", "2024-01-01", "x"), ("a", "2024-01-02", "y"), ("a", "2024-01-02", "z"), ("b", None, "only"), ("c", None, "n"), ("c", "2024-01-01", "d")]
    results = {
        tuple(rows(conform.dedup_latest(spark.createDataFrame(d, "k string, updated_at string, v string").repartition(n), ["k"])))
        for d, n in ((data, 1), (list(reversed(data)), 5))
    }
    assert len(results) == 1
    got = {r[0]: r[2] for r in results.pop()}
    assert got["a"] in "yz" and got["b"] == "only" and got["c"] == "d"


def test_dedup_without_recency_keeps_one_row(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    assert conform.dedup_latest(df, ["k"]).count() == 2


@pytest.mark.parametrize("skew", [{}, {"rows_per_task": 1, "small_bytes": 0, "broadcast_bytes": 0}])
def test_orphans_split_everything(spark, skew):
    child = spark.createDataFrame([(1, "p1"), (2, "p2"), (3, None), (4, "gone"), (5, "p1")], "id int, fk string")
    parent = spark.createDataFrame([("p1",), ("p1",), ("p2",)], "pk string")
    tagged = conform.tag_orphans(child, "fk", parent, "pk", **skew)
    assert rows(conform.clean(tagged)) == [(1, "p1"), (2, "p2"), (5, "p1")]
    assert rows(conform.rejects(tagged)) == [(3, None, "orphan"), (4, "gone", "orphan")]


def test_orphan_counts_come_from_one_write(spark, lake):
    child = spark.createDataFrame([(1, "p1"), (2, "x"), (3, "y")], "id int, fk string")
    tagged = conform.tag_orphans(child, "fk", spark.createDataFrame([("p1",)], "pk string"), "pk")
    for _ in range(2):  # again with the same run id: nothing doubles
        assert upsert.split_write(lake, tagged, "t", "run-1") == {"clean": 1, "quarantined": 2}
    assert lake.read("silver", "t").count() == 3


def test_birth_number_quarantine_drops_raw_value(spark):
    tagged = conform.tag_birth_number(spark.createDataFrame([("1", "700315"), ("2", "bad")], "client_id string, birth_number string"))
    assert "birth_number" not in tagged.columns
    assert tagged.where("decode_error is not null").count() == 1


def test_resolve_surrogates(spark):
    case = spark.createDataFrame([(1, "C1", "A9"), (2, "C?", None)], "id int, contact string, account string")
    contact = spark.createDataFrame([("C1", "c-1")], "rid string, client_id string")
    account = spark.createDataFrame([("A9", "a-9")], "rid string, account_id string")
    got = conform.resolve_surrogates(case, [(contact, "contact", "rid", "client_id"), (account, "account", "rid", "account_id")])
    assert rows(got) == [(1, "c-1", "a-9"), (2, None, None)]


@pytest.mark.parametrize(
    "events, live",
    [
        ([(1, "I", "k", "a")], [("k", "a")]),
        ([(1, "I", "k", "a"), (2, "U", "k", "b")], [("k", "b")]),
        ([(1, "I", "k", "a"), (2, "D", "k", "b")], []),
        ([(1, "I", "k", "a"), (2, "D", "k", "b"), (3, "I", "k", "c")], [("k", "c")]),
        ([(3, "U", "k", "c"), (1, "I", "k", "a"), (2, "D", "k", "b")], [("k", "c")]),
        ([(2, "U", "k", "b"), (2, "U", "k", "b"), (1, "I", "k", "a")], [("k", "b")]),
    ],
)
def test_latest_change_state(spark, events, live):
    got = conform.latest_change_state(spark.createDataFrame(events, EVENT)).select("pk_value", "label")
    assert rows(got) == live


def test_overlay_keeps_one_row_per_touched_key(spark):
    base = spark.createDataFrame([("a", "base"), ("b", "base"), ("c", "base")], "k string, label string")
    events = spark.createDataFrame(
        [(1, "U", "a", "v1"), (2, "U", "a", "v2"), (3, "D", "b", "gone"), (4, "I", "new", "n"), (2, "U", "a", "v2")], EVENT
    )
    assert rows(conform.overlay_changes(base, events, "k")) == [("a", "v2"), ("c", "base"), ("new", "n")]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("IUD"), st.sampled_from("abc")), max_size=20), st.randoms())
def test_state_equals_sequential_replay(spark, changes, rng):
    events = [(i, op, k, f"v{i}") for i, (op, k) in enumerate(changes)]
    state = {}
    for seq, op, key, label in events:
        state.pop(key, None)
        if op != "D":
            state[key] = label
    shuffled = events[:]
    rng.shuffle(shuffled)
    got = conform.latest_change_state(spark.createDataFrame(shuffled, EVENT)).select("pk_value", "label")
    assert rows(got) == sorted(state.items(), key=repr)


def test_spec_refuses_to_mask_a_key():
    with pytest.raises(ValueError):
        conform.TableSpec("t", ("id",), mask=("id",))
    with pytest.raises(ValueError):
        conform.TableSpec("t", ("id",), mask=("fk",), fk="fk")


def test_flatten_json_bad_payload_gives_nulls(spark):
    df = spark.createDataFrame([('{"a":{"b":"1.5"}}',), ("not json",), ('{"a":{"b":"x"}}',)], "p string")
    got = conform.flatten_json(df, "p", "a struct<b: string>", {"b": "try_cast(_json.a.b as double)"})
    assert sorted([r.b for r in got.collect()], key=repr) == [1.5, None, None]


def test_active_rows_keeps_unknown_flag(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, is_deleted boolean")
    assert [r[0] for r in rows(conform.active_rows(df))] == [2, 3]
