import hashlib
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from conftest import rows
from tributary.operators import maintenance, promotion
from tributary.schemas import schema
from tributary.sources import landing

DECLARED = schema(seq="long", op="string", note="string")
AT = ["2024-02-01 00:00:00", "2024-02-02 00:00:00", "2024-02-03 00:00:00"]


def drop(spark, *data):
    return spark.createDataFrame(data, "seq bigint, op string, note string, dt string")


def land(lake, df, at=0, fmt="json"):
    return landing.land(lake, df, "s", "t", AT[at], fmt, seq="seq")


def promote(lake, run="r1", fmt="json", **kw):
    return {r.dt: r.verdict for r in promotion.promote(lake, "s", "t", DECLARED, fmt, run, **kw).collect()}


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_land_and_promote_once(spark, lake, fmt):
    df = drop(spark, (1, "I", None, "2024-01-01"), (2, "U", "x", "2024-01-01"), (3, "D", None, "2024-01-02"))
    assert land(lake, df, fmt=fmt) == ["2024-01-01", "2024-01-02"]
    manifest = {r.dt: (r.row_count, r.min_seq, r.max_seq) for r in landing.read_manifests(lake, "s", "t").collect()}
    assert manifest == {"2024-01-01": (2, 1, 2), "2024-01-02": (1, 3, 3)}
    assert promote(lake, fmt=fmt) == {"2024-01-01": "promoted", "2024-01-02": "promoted"}
    assert promote(lake, "r2", fmt=fmt) == {}
    assert lake.read("bronze", "s", "t").count() == 3


def test_empty_frame_lands_nothing(spark, lake):
    assert land(lake, drop(spark, (1, "I", "x", "2024-01-01")).where("false")) == []


def test_crash_before_the_ledger_entry_does_not_double(spark, lake, monkeypatch):
    land(lake, drop(spark, (1, "I", "x", "2024-01-01")))
    real = lake.append
    monkeypatch.setattr(lake, "append", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        promote(lake)
    monkeypatch.setattr(lake, "append", real)
    assert lake.read("bronze", "s", "t").count() == 1
    assert promote(lake, "r2") == {"2024-01-01": "promoted"}
    assert lake.read("bronze", "s", "t").count() == 1


def test_missing_marker_is_retried_until_fixed(spark, lake):
    land(lake, drop(spark, (1, "I", "x", "2024-01-01")))
    marker = lake.path("landing", "s", "t") + "/dt=2024-01-01/_SUCCESS"
    lake.files.delete(marker)
    assert promote(lake) == {"2024-01-01": "no success marker"}
    assert not lake.exists("bronze", "s", "t")
    lake.files.touch(marker)
    assert promote(lake, "r2") == {"2024-01-01": "promoted"}


def test_edited_payload(spark, lake):
    land(lake, drop(spark, (1, "I", "x", "2024-01-01"), (2, "I", "x", "2024-01-02")))
    path = lake.path("landing", "s", "t") + "/dt=2024-01-01"
    drop(spark, (1, "I", "tampered", "")).drop("dt").write.mode("overwrite").json(path)
    assert promote(lake) == {"2024-01-01": "checksum mismatch", "2024-01-02": "promoted"}


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_drift_is_held_back(spark, lake, fmt):
    land(lake, drop(spark, (1, "I", "x", "2024-01-01")), fmt=fmt)
    land(lake, drop(spark, (1, "I", "x", "2024-01-02")).withColumn("extra", F.lit(1)), fmt=fmt)
    land(lake, drop(spark, (1, "I", "x", "2024-01-03")).drop("note"), fmt=fmt)
    got = promote(lake, fmt=fmt)
    assert got == {"2024-01-01": "promoted", "2024-01-02": "schema drift", "2024-01-03": "schema drift"}


def test_all_null_column_is_no_drift(spark, lake):
    land(lake, drop(spark, (1, "I", None, "2024-01-01"), (2, "I", None, "2024-01-01")))
    assert promote(lake) == {"2024-01-01": "promoted"}


def test_nested_shape_is_compared_by_top_level_kind(spark):
    declared = StructType([*schema(id="string", n="long").fields]).add("nested", StructType().add("a", ArrayType(StringType())))
    shapes = spark.createDataFrame(
        [("OBJECT<id: STRING, n: DECIMAL(3,1), nested: OBJECT<a: ARRAY<STRING>, b: BIGINT>>",), ("OBJECT<id: STRING, n: STRING, nested: VOID>",), ("OBJECT<id: VOID, n: BIGINT, nested: VOID>",)],
        "shape string",
    )
    got = [r[0] for r in shapes.select(promotion.matches_shape(F.col("shape"), declared, "json")).collect()]
    assert got == [True, False, True]


def test_redelivery_is_skipped_but_new_content_appended(spark, lake):
    day = drop(spark, (1, "I", "x", "2024-01-01"), (2, "I", "y", "2024-01-01"))
    land(lake, day)
    promote(lake)
    land(lake, day.repartition(3), 1)
    assert promote(lake, "r2") == {"2024-01-01": "redelivered"}
    assert promote(lake, "r3") == {}
    land(lake, day.withColumn("note", F.lit("z")), 2)
    assert promote(lake, "r4") == {"2024-01-01": "promoted"}
    assert lake.read("bronze", "s", "t").count() == 4


def test_same_content_twice_in_one_run(spark, lake):
    land(lake, drop(spark, (1, "I", "x", "2024-01-01"), (1, "I", "x", "2024-01-02"), (2, "I", "x", "2024-01-03")))
    assert promote(lake) == {"2024-01-01": "promoted", "2024-01-02": "redelivered", "2024-01-03": "promoted"}
    assert lake.read("bronze", "s", "t").count() == 2


def test_values_that_typing_would_lose(spark, lake):
    land(lake, drop(spark, (1, "I", "x", "2024-01-01"), (2, "I", None, "2024-01-03")))
    land(lake, drop(spark, (1, "I", "x", "2024-01-02")).withColumn("seq", F.lit(1.5)))
    path = lake.path("landing", "s", "t") + "/dt=2024-01-03"
    spark.createDataFrame([('{"seq": 2, "op": "I", "note": "cut o',)], "v string").write.mode("overwrite").text(path)
    spark.createDataFrame([('{"seq": 3, "op": "I", "note": null}',)], "v string").write.mode("append").text(path)
    spark.sql("select 2L as row_count, 's' as source, 't' as table_name, '2024-01-03' as dt, 2L as min_seq, 3L as max_seq, timestamp_ntz'2024-02-03' as written_at").select(
        "source", "table_name", "dt", "row_count", "min_seq", "max_seq", "written_at"
    ).write.mode("append").parquet(lake.path("control", "manifests"))
    lake.append(landing.payload_checksums(lake, "s", "t", ["2024-01-03"]).withColumn("written_at", F.lit(AT[2]).cast("timestamp_ntz")), "control", "checksums")
    assert promote(lake) == {"2024-01-01": "promoted", "2024-01-02": "bad values", "2024-01-03": "bad values"}


def test_every_parquet_file_of_a_date_is_judged(spark, lake):
    land(lake, drop(spark, (1, "I", "x", "2024-01-01"), (2, "I", "x", "2024-01-02")), fmt="parquet")
    path = lake.path("landing", "s", "t") + "/dt=2024-01-02"
    drop(spark, (3, "I", "x", "")).drop("dt").withColumn("extra", F.lit(1)).write.mode("append").parquet(path)
    land(lake, drop(spark, (4, "I", "x", "2024-01-03")).withColumn("note", F.lit(4)), fmt="parquet")
    land(lake, drop(spark, (5, "I", "x", "2024-01-04")), fmt="parquet")
    path = lake.path("landing", "s", "t") + "/dt=2024-01-04"
    drop(spark, (6, "I", "x", "")).drop("dt").withColumn("seq", F.lit("six")).write.mode("append").parquet(path)
    got = promote(lake, fmt="parquet")
    assert got == {"2024-01-01": "promoted", "2024-01-02": "schema drift", "2024-01-03": "schema drift", "2024-01-04": "schema drift"}


def test_incomplete_file_set_waits(spark, lake):
    land(lake, drop(spark, (1, "I", "x", "2024-01-01")))
    assert promote(lake, incomplete=["2024-01-01"]) == {"2024-01-01": "file set incomplete"}
    assert promote(lake, "r2") == {"2024-01-01": "promoted"}


def test_complete_sets(spark):
    arrivals = spark.createDataFrame([("s", "d1", "a"), ("s", "d1", "a"), ("s", "d1", "b"), ("s", "d2", "a"), ("s", "d2", "other")], "source string, dt string, table_name string")
    assert rows(promotion.complete_sets(arrivals, ["a", "b"])) == [("s", "d1", 2, True), ("s", "d2", 1, False)]


def test_only_new_changes(spark):
    events = spark.createDataFrame([("k", "I", 1), ("k", "I", 1), ("k", "U", 2), ("j", "I", 3)], "pk_value string, op string, seq bigint")
    bronze = spark.createDataFrame([("k", "I", 1)], "pk_value string, op string, seq bigint")
    assert rows(promotion.only_new_changes(events, bronze)) == [("j", "I", 3), ("k", "U", 2)]
    assert promotion.only_new_changes(events, None).count() == 3


def test_retention_spares_unpromoted_days(spark, lake):
    land(lake, drop(spark, (1, "I", "x", "2024-01-01"), (2, "I", "x", "2024-01-02"), (3, "I", "x", "2024-01-20")))
    lake.files.delete(lake.path("landing", "s", "t") + "/dt=2024-01-02/_SUCCESS")
    promote(lake)
    assert maintenance.expire_landing(lake, "s", "t", "2024-01-21", 7) == ["2024-01-01"]
    assert rows(landing.list_partitions(lake, "s", "t").select("dt")) == [("2024-01-02",), ("2024-01-20",)]


def test_retention_spares_a_pending_new_drop(spark, lake):
    land(lake, drop(spark, (1, "I", "x", "2024-01-01")))
    promote(lake)
    land(lake, drop(spark, (2, "I", "y", "2024-01-01")), 2)
    assert maintenance.expire_landing(lake, "s", "t", "2024-01-21", 7) == []
    assert promote(lake, "r2") == {"2024-01-01": "promoted"}
    assert maintenance.expire_landing(lake, "s", "t", "2024-01-21", 7) == ["2024-01-01"]


def test_verbatim_api_payload(spark, lake):
    path = lake.path("landing", "api", "accounts") + "/dt=2024-01-01"
    spark.createDataFrame([('[{"id": "a1"}, {"id": "a2"}]',)], "v string").coalesce(1).write.text(path)
    got = landing.scan_landing(lake, "api", "accounts", schema(id="string"), "json", multiline=True)
    assert rows(got) == [("a1", "2024-01-01"), ("a2", "2024-01-01")]


def outside(lake, texts, dt="2024-01-01", **said):
    """A drop that was not written by ``land``: payload files, a manifest of its own, the marker."""
    path = lake.path("landing", "s", "t") + f"/dt={dt}"
    for i, text in enumerate(texts):
        lake.files.write_text(f"{path}/response-{i}.json", text)
    lake.files.write_text(f"{path}/_manifest.json", json.dumps(said))
    lake.files.touch(f"{path}/_SUCCESS")


ARRAY = """[{"seq": 1, "op": "I", "note": "[x"},
 {"seq": 2, "op": "I", "note": null}]"""


def test_array_payload_with_its_own_manifest(spark, lake):
    outside(lake, [ARRAY], row_count=2, checksum=hashlib.sha256(ARRAY.encode()).hexdigest())
    outside(lake, ["[]"], "2024-01-02", row_count=0)
    outside(lake, [ARRAY[:-9]], "2024-01-03", row_count=1)
    outside(lake, ["null"], "2024-01-05", row_count=1)
    outside(lake, ['{"seq": 3, "op": "D", "note": "one"}', "", "[ ]"], "2024-01-04", rows_landed=1)
    assert promote(lake, multiline=True) == {"2024-01-01": "promoted", "2024-01-02": "promoted", "2024-01-03": "bad values", "2024-01-04": "promoted", "2024-01-05": "bad values"}
    assert rows(lake.read("bronze", "s", "t").select("seq", "note")) == [(1, "[x"), (2, None), (3, "one")]
    assert promote(lake, "r2", multiline=True) == {"2024-01-03": "bad values", "2024-01-05": "bad values"}


def test_manifest_from_outside_is_held_to(spark, lake):
    line = '{"seq": 1, "op": "I", "note": "x"}'
    outside(lake, [line], row_count=1, checksum="0" * 64)
    outside(lake, [line], "2024-01-02", rows_landed=1, api_reported_total=2)
    outside(lake, [line], "2024-01-03", row_count=2)
    outside(lake, [line], "2024-01-04", row_count=1, reconciled=False)
    outside(lake, [line], "2024-01-05", reconciled=True)
    outside(lake, [], "2024-01-06", row_count=1, checksum="0" * 64)
    assert promote(lake) == {
        "2024-01-01": "checksum mismatch", "2024-01-02": "paging not reconciled", "2024-01-03": "row count mismatch",
        "2024-01-04": "paging not reconciled", "2024-01-05": "no manifest", "2024-01-06": "checksum mismatch",
    }
    land(lake, drop(spark, (1, "I", "x", "2024-01-01")))
    assert promote(lake, "r2")["2024-01-01"] == "promoted"


def changes(lake, run):
    declared = schema(seq="long", op="string", pk_value="string")
    return {r.dt: r.verdict for r in promotion.promote(lake, "s", "t", declared, "json", run, mode="changes").collect()}


def test_change_log_is_appended_once(spark, lake, monkeypatch):
    def events(*data):
        return spark.createDataFrame(data, "seq bigint, op string, pk_value string, dt string")

    landing.land(lake, events((1, "I", "a", "2024-01-01"), (2, "U", None, "2024-01-01"), (2, "U", None, "2024-01-02")), "s", "t", AT[0], "json")
    assert changes(lake, "r1") == {"2024-01-01": "promoted", "2024-01-02": "promoted"}
    landing.land(lake, events((2, "U", None, "2024-01-03"), (3, "D", "a", "2024-01-03"), (3, "D", "a", "2024-01-03")), "s", "t", AT[1], "json")
    real = lake.append
    monkeypatch.setattr(lake, "append", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        changes(lake, "r2")
    monkeypatch.setattr(lake, "append", real)
    assert changes(lake, "r3") == {"2024-01-03": "promoted"}
    assert rows(lake.read("bronze", "s", "t").select("seq", "op", "pk_value", F.col("dt").cast("string"))) == [
        (1, "I", "a", "2024-01-01"), (2, "U", None, "2024-01-01"), (3, "D", "a", "2024-01-03"),
    ]
    with pytest.raises(ValueError):
        promotion.promote(lake, "s", "t", DECLARED, "json", "r4", mode="log")
