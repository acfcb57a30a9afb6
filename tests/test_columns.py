import datetime as dt
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tributary.functions import columns as c


@pytest.mark.parametrize("value, expected", [(None, None), ("", None), ("abc", None), ("abcd", "abcd"), ("abcdefgh", "efgh")])
def test_mask_last4(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(c.mask_last4(F.col("v"))).first()[0] == expected


@pytest.mark.parametrize("value, expected", [("yes", True), ("no", False), ("maybe", None), ("true", None), (None, None)])
def test_yes_no(spark, value, expected):
    assert spark.createDataFrame([(value,)], "v string").select(c.yes_no_to_bool(F.col("v"))).first()[0] is expected


def test_flag_to_bool(spark):
    df = spark.createDataFrame([(0,), (1,), (None,)], "v bigint")
    assert [r[0] for r in df.select(c.flag_to_bool(F.col("v"))).collect()] == [False, True, None]


KNOWN = [
    ("700315", dt.date(1970, 3, 15), "M"),
    ("705315", dt.date(1970, 3, 15), "F"),
    ("996231", dt.date(1999, 12, 31), "F"),
    (" 700315 ", dt.date(1970, 3, 15), "M"),
    ("000229", None, None),  # 1900 was no leap year
    ("040229", dt.date(1904, 2, 29), "M"),
    ("7003", None, None),
    ("70031X", None, None),
    ("701315", None, None),
    ("700230", None, None),
    ("705015", None, None),
    ("700015", None, None),
    ("", None, None),
    (None, None, None),
]


def test_birth_number_known_cases(spark):
    df = spark.createDataFrame([(n,) for n, _, _ in KNOWN], "v string").select(c.decode_birth_number(F.col("v")).alias("b"))
    got = [(r.b.birth_date, r.b.gender, r.b.error is None) for r in df.collect()]
    assert got == [(born, gender, born is not None) for _, born, gender in KNOWN]


def decode_again(text):
    if len(text) != 6 or not all("0" <= ch <= "9" for ch in text):
        return None
    month = int(text[2:4])
    try:
        return dt.date(1900 + int(text[:2]), month - 50 if month > 50 else month, int(text[4:])), "F" if month > 50 else "M"
    except ValueError:
        return None


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(0, 999999).map("{:06d}".format), st.text("0123456789X", max_size=8)), min_size=1, max_size=60))
def test_birth_number_matches_restatement(spark, numbers):
    df = spark.createDataFrame([(n,) for n in numbers], "v string").select(c.decode_birth_number(F.col("v")).alias("b"))
    got = [(r.b.birth_date, r.b.gender) if r.b.error is None else None for r in df.collect()]
    assert got == [decode_again(n) for n in numbers]


def test_stable_row_id_is_uuid5(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "x string, y int").select("x", "y", c.stable_row_id(F.col("x"), F.col("y")).alias("id"))
    for r in df.collect():
        assert r.id == str(uuid.uuid5(uuid.NAMESPACE_DNS, f"{r.x}|{r.y}"))


def test_ratio_of_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 3), (None, 3)], "a int, b int")
    assert rows(df.select(c.ratio(F.col("a"), F.col("b")))) == sorted([(None,), (0.333333333,), (None,)], key=repr)


def test_birth_dates_are_cast_not_parsed_by_a_pattern(spark):
    df = spark.createDataFrame([("700230",), ("725229",), ("735229",)], "v string").select(c.decode_birth_number(F.col("v")).alias("b"))
    assert "yyyyMMdd" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert [str(r.b.birth_date) for r in df.collect()] == ["None", "1972-02-29", "None"]
    assert [r.b.error for r in df.collect()] == ["impossible calendar date", None, "impossible calendar date"]


def test_a_filter_on_a_decoded_field_names_the_number_once(spark):
    born = spark.range(3).select(F.concat(F.lit("70010"), F.col("id") % 7 + 1).alias("v")).select(c.decode_birth_number(F.col("v")).alias("b"))
    kept = born.where("b.error is null").select("b.birth_date", "b.gender")
    condition = [x for x in kept._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x]
    assert len(condition) == 1 and condition[0].count("concat(70010") == 1
    assert kept.count() == 3
