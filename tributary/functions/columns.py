"""Column-level building blocks; all stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
NAMESPACE_DNS = "6ba7b8109dad11d180b400c04fd430c8"  # RFC 4122 namespace, fixed value


def mask_last4(value: Column) -> Column:
    """CNF-06: keep the last four characters; shorter values vanish altogether."""
    return F.when(F.length(value) >= 4, F.right(value, F.lit(4)))


def flag_to_bool(value: Column) -> Column:
    """CNF-04: 0/1 integer to boolean, NULL stays NULL."""
    return value != 0


def yes_no_to_bool(value: Column) -> Column:
    """CNF-05: explicit map; any text other than yes/no becomes NULL."""
    return F.when(value == "yes", True).when(value == "no", False)


def decode_birth_number(raw: Column) -> Column:
    """CNF-07: ``YYMMDD`` with 50 added to the month for women, years 1900-1999.

    Gives a struct ``(birth_date, gender, error)``; exactly one of date and error is set. The number is bound once: a
    filter on a field would otherwise work out the expression behind ``raw`` anew at every place the decoding names it.
    """
    return F.transform(F.array(F.trim(raw)), _decoded)[0]


def _decoded(digits: Column) -> Column:
    well_formed = F.coalesce(digits.rlike("^[0-9]{6}$"), F.lit(False))
    coded_month = F.substring(digits, 3, 2).try_cast("int")
    female = coded_month > 50
    month = F.when(female, coded_month - 50).otherwise(coded_month)
    # A cast gives NULL for a day that never was; a pattern would raise and catch an error for each.
    text = F.concat_ws("-", F.concat(F.lit("19"), F.substring(digits, 1, 2)), F.lpad(month.cast("string"), 2, "0"), F.substring(digits, 5, 2))
    born = F.when(well_formed & month.between(1, 12), text.try_cast("date"))
    error = (
        F.when(~well_formed, "expected 6 digits")
        .when(~month.between(1, 12), "month out of range")
        .when(born.isNull(), "impossible calendar date")
    )
    gender = F.when(born.isNotNull(), F.when(female, "F").otherwise("M"))
    return F.struct(born.alias("birth_date"), gender.alias("gender"), error.alias("error"))


def hash_number(text: Column, digits: int) -> Column:
    """The first ``digits`` (at most 15) hex digits of the md5, as a BIGINT."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def salted(salt: str, *parts: Column) -> Column:
    return F.concat_ws("|", F.lit(salt), *[p.cast("string") for p in parts])


def stable_row_id(*parts: Column) -> Column:
    """PRP-03: name-based UUID (version 5) over natural key columns."""
    name = F.encode(F.concat_ws("|", *[p.cast("string") for p in parts]), "UTF-8")
    digest = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE_DNS)), name))
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def as_double(value: Column, digits: int = 2) -> Column:
    """Exact decimal inside, double at the edge."""
    return F.round(value, digits).cast("double")


def ratio(part: Column, whole: Column, digits: int = 9) -> Column:
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), digits)
