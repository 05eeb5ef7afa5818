import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from refinery import functions as fn


def evaluate(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def text(value):
    return F.lit(value).cast("string")


def test_key_is_null_if_any_part_is(spark):
    known, unknown, skipped = evaluate(
        spark,
        fn.tenant_key(text("a"), F.lit(7), F.lit(8)),
        fn.tenant_key(text("a"), F.lit(None).cast("int")),
        fn.tenant_key(text("a"), F.lit(None).cast("int"), F.lit(3), on_null="skip"),
    )
    assert (known, unknown, skipped) == ("a_7_8", None, "a_3")
    assert evaluate(spark, fn.foreign_key(text("a"), F.lit(7))) == ("a_7",)
    with pytest.raises(ValueError):
        fn.tenant_key("a", on_null="other")


def test_full_name_leaves_no_gaps(spark):
    assert evaluate(
        spark,
        fn.full_name(text("Ann"), text(""), text("Bos")),
        fn.full_name(text("Ann"), text(None), text("Bos")),
        fn.full_name(text(""), text(None), text("")),
    ) == ("Ann Bos", "Ann Bos", "")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_values_are_null_and_never_throw(spark, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    array = F.array(F.lit("x"))
    assert evaluate(
        spark,
        fn.parse_date(text("soon")),
        fn.parse_date(text("2020-13-01")),
        fn.parse_timestamp(text("soon")),
        fn.parse_int(text("ten")),
        fn.parse_int(text("99999999999")),
        fn.nth(array, 1),
        fn.nth(F.lit(None).cast("array<string>"), 0),
        fn.cents_to_decimal(F.lit(100_000_000)),
        fn.cents_to_decimal(F.lit(10**12)),
    ) == (None,) * 9
    assert evaluate(
        spark, fn.parse_date(text("2020-02-29")), fn.parse_int(text("8.7")), fn.parse_int(text("-3")), fn.nth(array, 0)
    ) == (dt.date(2020, 2, 29), 8, -3, "x")


def test_typed_dates_out_of_range_fall_back(spark):
    low, high = F.lit("2020-01-01").cast("date"), F.lit("2021-06-02").cast("date")
    submitted = F.lit("2021-01-15").cast("date")

    def reported(*typed):
        return fn.preferred_date([fn.parse_date(text(value)) for value in typed], submitted, low, high)

    fallback = dt.date(2021, 1, 15)
    assert evaluate(
        spark,
        reported("1925-04-01", None),
        reported("2926-04-01", "2020-05-05"),
        reported(None, "2020-05-05"),
        reported("2020-01-01", None),
        reported("2021-06-02", None),
        reported("2021-06-03", None),
        reported(None, None),
    ) == (
        fallback,
        fallback,
        dt.date(2020, 5, 5),
        dt.date(2020, 1, 1),
        dt.date(2021, 6, 2),
        fallback,
        fallback,
    )


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_written_and_instant_dates_differ(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    moment = text("2024-03-01T23:30:00-05:00")
    assert evaluate(
        spark,
        fn.written_date(moment),
        fn.instant_date(moment, "UTC"),
        fn.instant_date(moment, "America/New_York"),
        fn.instant_date(text("nothing"), "UTC"),
    ) == (dt.date(2024, 3, 1), dt.date(2024, 3, 2), dt.date(2024, 3, 1), None)


def test_utc_to_local_follows_daylight_saving(spark):
    local = [
        fn.utc_to_local(text(value)).cast("timestamp_ntz")
        for value in ("2024-07-01T12:00:00Z", "2024-01-01T12:00:00Z", "2024-03-31T01:00:00Z", "noon")
    ]
    assert evaluate(spark, *local) == (
        dt.datetime(2024, 7, 1, 14),
        dt.datetime(2024, 1, 1, 13),
        dt.datetime(2024, 3, 31, 3),
        None,
    )


def test_cents_round_half_up_to_the_type(spark):
    assert evaluate(spark, fn.cents_to_decimal(F.lit(1999)), fn.cents_to_decimal(F.lit(99_999_999))) == (
        Decimal("19.99"),
        Decimal("999999.99"),
    )


def test_classes_flags_and_lookups(spark):
    many = {str(number): f"label {number}" for number in range(40)}
    assert evaluate(
        spark,
        fn.prefix_class(text("DTT-1"), 3, ("FRM", "DTT"), default="FRM"),
        fn.prefix_class(text("XX"), 3, ("FRM", "DTT"), default="FRM"),
        fn.prefix_class(text(None), 3, ("FRM", "DTT"), default="FRM"),
        fn.lookup(text("9"), {"9": "nine"}, default="other"),
        fn.lookup(text(None), {"9": "nine"}, default=text("by column")),
        fn.lookup(text("39"), many, default="other"),
        fn.lookup(text("40"), many, default="other"),
        fn.lookup(text(None), many, default="other"),
        fn.lookup(text("1"), {}, default="other"),
        fn.flag(F.lit(None).cast("boolean")),
        fn.flag(F.lit(True)),
        fn.blank_to_null(text("")),
        fn.blank_to_null(text(" ")),
        fn.time_of_day(text("10:30:00.000")),
    ) == (
        "DTT", "FRM", "FRM", "nine", "by column", "label 39", "other", "other", "other", False, True, None, " ",
        "10:30:00",
    )


def test_clamp_bounds_may_be_left_out(spark):
    five = F.lit(5)
    assert evaluate(
        spark,
        fn.clamp_to_null(five, 5, 5),
        fn.clamp_to_null(five, low=6),
        fn.clamp_to_null(five, high=4),
        fn.clamp_to_null(five),
        fn.clamp_to_null(F.lit(None).cast("int"), 1, 9),
    ) == (5, None, None, 5, None)


def test_as_of_defaults_to_today(spark):
    given, column, today = evaluate(
        spark, fn.as_of_date("2024-02-03"), fn.as_of_date(F.lit("2024-02-03")), fn.as_of_date() == F.current_date()
    )
    assert (given, column, today) == (dt.date(2024, 2, 3), dt.date(2024, 2, 3), True)


@pytest.mark.parametrize("size", [3, 16, 17, 200])
def test_lookup_answers_alike_at_every_size(spark, size):
    mapping = {number: f"label {number}" for number in range(1, size)} | {0: None}
    df = spark.createDataFrame([("0",), ("1",), ("2",), ("999",), (None,)], "code string")
    found = {row.code: row.label for row in df.select("code", fn.lookup("code", mapping, default="other").alias("label")).collect()}
    assert found == {"0": None, "1": "label 1", "2": "label 2", "999": "other", None: "other"}
