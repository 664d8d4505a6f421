from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dugout.functions import dates as D
from dugout.functions import scalar as S
from dugout.functions import web as U


def one(spark, col, **cols):
    df = spark.range(1).select(*[(v if hasattr(v, "_jc") else F.lit(v)).alias(k) for k, v in cols.items()]) if cols else spark.range(1)
    return df.select(col).first()[0]


def test_surrogate_key_golden(spark):
    data = [("a", "b", "c"), ("a", None, "c"), (None, None, "c"), (None, None, None)]
    df = spark.createDataFrame(data, "x string, y string, z string")
    got = [r[0] for r in df.select(S.surrogate_key(["x", "y", "z"])).collect()]
    assert got == [
        "7b193b3d33184464106f41ddf733783b", "4f32a73dc87b7bbb7a654d8898d58c7e", "d9c538b129f1a3ad6ecfe55345c32a05", "2fa5491950d66d153d23cfbcfea4e164",
    ]
    first = [r[0] for r in df.select(S.surrogate_key(["x"])).collect()]
    assert first[0] == "0cc175b9c0f1b6a831c399e269772661" and first[3] == "f14cc5cdce0420f4a5a6b6d9d7b85f39"


def test_safe_arithmetic_golden(spark):
    add = spark.createDataFrame([(1, 2, 3), (1, None, 3), (None, None, 2), (None, None, None)], "a int, b int, c int")
    assert [r[0] for r in add.select(S.safe_add(["a", "b", "c"])).collect()] == [6, 4, 2, 0]
    sub = spark.createDataFrame([(3, 2, 1), (4, None, 3), (None, None, 2), (None, None, None)], "a int, b int, c int")
    assert [r[0] for r in sub.select(S.safe_subtract(["a", "b", "c"])).collect()] == [0, 1, -2, 0]
    div = spark.createDataFrame([(6, 0), (10, 5), (None, None), (None, 0), (17, None), (0, None), (None, 9), (0, 5)], "n int, d int")
    assert [r[0] for r in div.select(S.safe_divide("n", "d")).collect()] == [None, 2, None, None, None, None, None, 0]
    assert one(spark, S.rate(F.lit(2), F.lit(3))) == 0.667


def test_haversine_golden(spark):
    p = [F.lit(48.864716), F.lit(2.349014), F.lit(52.379189), F.lit(4.899431)]
    assert round(one(spark, S.haversine(*p, unit="km"))) == 430
    assert round(one(spark, S.haversine(*p))) == 267


def test_width_bucket_golden(spark):
    v = [190000, 290000, 320000, 399999.99, 400000, 470000, 510000, 610000]
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    assert [r[0] for r in df.select(S.width_bucket("v", 200000, 600000, 4)).collect()] == [0, 1, 2, 2, 3, 3, 4, 5]


@pytest.mark.parametrize(
    "url,host",
    [
        ("www.google.co.uk?q=redirect-test&redir=", "www.google.co.uk"), ("http://witanddelight.com/2018/01/tips", "witanddelight.com"),
        ("https://www.nytimes.com/2018/01/30/blog", "www.nytimes.com"), ("android-app://m.facebook.com/", "m.facebook.com"), ("docs.nytimes.com/2021/01/01/index.js?utm_source=google", "docs.nytimes.com"),
    ],
)
def test_url_host(spark, url, host):
    assert one(spark, U.url_host(F.lit(url))) == host


def test_url_path_and_parameter(spark):
    assert one(spark, U.url_path(F.lit("www.coolurl.com"))) is None
    assert one(spark, U.url_path(F.lit("www.coolurl.com/2018/01/01/blog?x=1"))) == "2018/01/01/blog"
    u = F.lit("http://drinksite.com?utm_source=github&utm_medium=organic")
    assert one(spark, U.url_parameter(u, "utm_medium")) == "organic" and one(spark, U.url_parameter(u, "utm_source")) == "github"
    assert one(spark, U.url_parameter(u, "utm_campaign")) is None


def test_innings_and_numbers(spark):
    got = spark.createDataFrame([(x,) for x in ("6.1", "7", " ", None, "6.x", "5.")], "t string").select(S.innings_to_outs("t")).collect()
    assert [r[0] for r in got] == [19, 21, None, None, None, 15]
    assert one(spark, S.outs_to_innings(F.lit(20))) == "6.2"
    assert str(one(spark, S.money(F.lit("$1,234.50")))) == "1234.50" and one(spark, S.money(F.lit("n/a"))) is None
    assert one(spark, S.clock_to_24h(F.lit("7:05"), F.lit("PM"))) == "19:05"
    assert one(spark, S.clock_to_24h(F.lit("1:10 pm"))) == "13:10" and one(spark, S.clock_to_24h(F.lit("soon"))) is None
    assert one(spark, S.duration_minutes(F.lit("3:22"))) == 202 and one(spark, S.grouped_int(F.lit("44,392."))) == 44392
    assert one(spark, S.rate_text(F.lit(1 / 3))) == ".333"
    assert one(spark, S.start_hour(F.lit("19:05"), F.lit("2024-01-01 10:00:00").cast("timestamp"))) == 19
    assert one(spark, S.start_hour(F.lit("x"), F.lit("2024-01-01 10:00:00").cast("timestamp"))) == 10
    assert one(spark, S.joined(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))) == "ab"
    assert one(spark, S.clean_text(F.lit("  "), "Unknown")) == "Unknown"
    assert one(spark, S.earned_run_average(F.lit(3), F.lit(27))) == 3.0 and one(spark, S.whip(F.lit(2), F.lit(4), F.lit(18))) == 1.0 and one(spark, S.per_nine(F.lit(9), F.lit(27))) == 9.0


def test_flags_keep_unknown(spark):
    assert one(spark, S.flag(F.lit(None).cast("boolean"))) == 0
    assert one(spark, S.known_flag(F.lit(False), F.lit(True))) is None
    assert one(spark, S.regex_match(F.lit("ABC"), "b", "i")) and not one(spark, S.regex_match(F.lit("ABC"), "b"))
    assert one(spark, S.regex_position(F.lit("xxABC"), "abc", "i")) == 3


def test_calendar_golden(spark):
    df = spark.createDataFrame([(dt.date(2020, 11, 29),), (dt.date(2020, 12, 1),)], "d date")
    got = df.select(
        D.day_of_week("d"), D.day_of_week("d", iso=True), D.day_of_year("d"), D.week_start("d"), D.week_end("d"), D.iso_week_of_year("d"), D.iso_week_start("d"), D.iso_week_end("d")
    ).collect()
    day = dt.date
    assert tuple(got[0]) == (1, 7, 334, day(2020, 11, 29), day(2020, 12, 5), 48, day(2020, 11, 23), day(2020, 11, 29))
    assert tuple(got[1]) == (3, 2, 336, day(2020, 11, 29), day(2020, 12, 5), 49, day(2020, 11, 30), day(2020, 12, 6))
    assert one(spark, D.date_key(F.lit(day(2020, 12, 1)))) == 20201201


def test_epochs_and_zones(spark):
    ts = D.from_unixtimestamp(F.lit(1623076520))
    assert one(spark, ts).strftime("%Y-%m-%d %H:%M:%S") == "2021-06-07 14:35:20"
    local = D.convert_timezone(F.lit("2021-06-07 14:35:20").cast("timestamp_ntz"), "America/Los_Angeles")
    assert one(spark, local) == dt.datetime(2021, 6, 7, 7, 35, 20)
    assert one(spark, D.round_timestamp(local)) == dt.datetime(2021, 6, 7) and one(spark, D.round_timestamp(F.lit("2021-06-07 14:35:20").cast("timestamp_ntz"))) == dt.datetime(2021, 6, 8)
    with pytest.raises(ValueError):
        D.from_unixtimestamp(F.lit(1), "weeks")


def test_relative_periods(spark):
    d = F.lit(dt.date(2021, 3, 17))
    assert one(spark, D.n_weeks_ago(1, d)) == dt.date(2021, 3, 8) and one(spark, D.n_months_ago(1, d)) == dt.date(2021, 2, 1)
    assert one(spark, D.yesterday(d)) == dt.date(2021, 3, 16) and one(spark, D.next_month_number(d)) == 4 and one(spark, D.last_month_name(d, short=False)) == "February"
    assert one(spark, D.now()) is not None and one(spark, D.today("Asia/Tokyo")) is not None


def test_clock_changes(spark):
    """A skipped time moves ahead, a repeated one is told by first and second, also where clocks move by half an hour."""
    from dugout.functions import dates as D

    cases = [
        ("2000-04-02 02:30:00", "America/New_York", "2000-04-02 07:30:00", "2000-04-02 07:30:00"),
        ("2000-10-29 01:30:00", "America/New_York", "2000-10-29 05:30:00", "2000-10-29 06:30:00"),
        ("2000-10-29 02:00:00", "America/New_York", "2000-10-29 07:00:00", "2000-10-29 07:00:00"),
        ("2024-04-07 01:45:00", "Australia/Lord_Howe", "2024-04-06 14:45:00", "2024-04-06 15:15:00"),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "t string, z string")
    zone = F.col("z")
    got = df.select(*[D.convert_timezone("t", "UTC", zone, w).cast("string") for w in ("first", "second")]).collect()
    assert [tuple(r) for r in got] == [c[2:] for c in cases]
    with pytest.raises(ValueError):
        D.convert_timezone("t", "UTC", "UTC", "third")
