from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from dugout.operators import calendars as C
from dugout.operators import joins as J
from dugout.operators import reshape as R
from dugout.operators import windows as W


def skewed(spark, n=400, seed=3):
    """Half of the rows belong to one key; values and keys may be NULL."""
    r = random.Random(seed)
    data = []
    for i in range(n):
        k = "hot" if r.random() < 0.5 else r.choice(["a", "b", None])
        day = dt.date(2024, 1, 1) + dt.timedelta(days=r.randrange(90))
        data.append((i, k, day, r.choice([None, r.randrange(100)]), r.choice([None, "x", "y"])))
    return spark.createDataFrame(data, "id long, k string, day date, v int, g string")


def month(_=None):
    return F.trunc("day", "MONTH")


def test_running_chunks_equal_plain_window(spark, rows):
    df = skewed(spark)
    w = Window.partitionBy("k").orderBy("day", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("id", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("m"))
    measures = {"s": ("all", "sum", F.col("v")), "m": ("all", "max", F.col("v"))}
    for chunk in (None, month(), F.col("day")):
        got = W.running(df, {"all": ["k"]}, ["day", "id"], measures, chunk)
        assert rows(got, "id", "s", "m") == rows(want)


def test_running_splits_share_one_exchange(spark, rows):
    df = skewed(spark).where("k is not null")
    splits = {"k": ["k"], "kg": ["k", "g"]}
    measures = {"n": ("k", "sum", F.lit(1)), "ng": ("kg", "sum", F.lit(1))}
    plain = W.running(df, splits, ["day", "id"], measures, None, ["k"])
    cut = W.running(df, splits, ["day", "id"], measures, month(), ["k"])
    assert rows(plain, "id", "n", "ng") == rows(cut, "id", "n", "ng")
    assert plain._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_neighbor_chunks_equal_plain(spark, rows):
    df = skewed(spark)
    for lead in (False, True):
        plain = W.neighbor(df, ["k"], ["day", "id"], {"p": "id", "pv": "v"}, lead)
        cut = W.neighbor(df, ["k"], ["day", "id"], {"p": "id", "pv": "v"}, lead, month())
        auto = W.neighbor(df, ["k"], ["day", "id"], {"p": "id", "pv": "v"}, lead, W.value_chunk(df, "day"))
        assert rows(plain, "id", "p", "pv") == rows(cut, "id", "p", "pv") == rows(auto, "id", "p", "pv")


def test_value_chunks_never_decrease(spark):
    values = [float("-inf"), -1e300, -3.5, -1.0, -1e-9, 0.0, 1e-9, 0.5, 1.0, 2.0, 1e6, 1e300]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(-1, None), (99, float("nan"))], "id int, v double")
    got = [r[0] for r in df.orderBy("id").select(W.value_chunk(df, "v")).collect()]
    assert got[0] is None and got[1:] == sorted(got[1:]) and len(set(got)) > 8


def test_column_values_has_no_cap(spark):
    df = spark.range(1500).withColumn("id", F.col("id").cast("string"))
    assert len(R.column_values(df, "id")) == 1500 and len(R.column_values(df, "id", max_values=3)) == 3


def test_dedup_limits_before_the_shuffle(spark, rows):
    df = skewed(spark)
    got = W.dedup_latest(df, ["k"], [F.desc("day"), F.desc("id")])
    assert got.count() == 4
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plain_partial(plan)


def plain_partial(plan: str) -> bool:
    return "WindowGroupLimit" in plan and "Partial" in plan


def test_exact_quantile_matches_builtin(spark, rows):
    df = skewed(spark)
    for q in (0.0, 0.25, 0.5, 0.9, 1.0):
        want = df.groupBy("k").agg(F.percentile("v", q).alias("quantile"))
        for chunk in (None, F.floor(F.col("v") / 7)):
            got = W.exact_quantile(df, "v", q, ["k"], chunk=chunk)
            assert [(k, round(v, 6)) for k, v in rows(got)] == [(k, round(v, 6)) for k, v in rows(want)]
    assert round(W.exact_quantile(df, "v", 0.5).first()[0], 6) == round(df.agg(F.percentile("v", 0.5)).first()[0], 6)


def test_asof_join(spark, rows):
    left = spark.createDataFrame([(1, "a", 10), (2, "a", 5), (3, "b", 7), (4, None, 9)], "id int, k string, t int")
    right = spark.createDataFrame([("a", 5, "five"), ("a", 8, "eight"), ("b", 9, "late")], "k string, rt int, v string")
    for chunk in (None, (F.col("_time") / 4).cast("int")):
        got = J.asof_join(left, right, ["k"], "t", "rt", {"v": "v"}, ["id"], chunk=chunk)
        assert rows(got, "id", "v") == [(1, "eight"), (2, "five"), (3, None), (4, None)]
    strict = J.asof_join(left, right, ["k"], "t", "rt", {"v": "v"}, ["id"], strict=True)
    assert rows(strict, "id", "v") == [(1, "eight"), (2, None), (3, None), (4, None)]


def test_date_ranges_keep_rows(spark, rows):
    d = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 6, 1),)], "d date")
    r = spark.createDataFrame([(2024, dt.date(2024, 5, 1), dt.date(2024, 7, 1)), (2025, None, None)], "s int, a date, b date")
    assert rows(J.date_in_range(d, "d", r, "a", "b", ["s"])) == [(dt.date(2024, 1, 1), None), (dt.date(2024, 6, 1), 2024)]


def test_lookup_and_conditional(spark, rows):
    f = spark.createDataFrame([(1, 5), (2, None), (3, 9)], "id int, score int")
    box = spark.createDataFrame([(1, 5), (3, 8)], "id int, runs int")
    got = J.conditional_lookup(f, box, ["id"], F.col("score").isNull() | (F.col("runs") == F.col("score")))
    assert rows(got, "id", "runs", "_matched") == [(1, 5, True), (2, None, False), (3, None, False)]
    assert rows(J.not_in(f, ["id"], box.union(spark.createDataFrame([(None, 1)], "id int, runs int"))), "id") == [(2,)]
    assert rows(J.members_of(f, ["id", "score"], "m")) == [(1,), (2,), (3,), (5,), (9,)]


def test_pivot_golden(spark, rows):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")
    got = R.pivot(df, ["size"], "color", ["red", "blue", "blue's"])
    assert rows(got, "size", "red", "blue", "`blue's`") == [("M", 1, 0, 0), ("S", 1, 1, 1)]
    assert R.slug("!Hell0 world-hi") == "hell0_world_hi" and R.slug("0Hell0 world-hi") == "_0hell0_world_hi"


def test_unpivot_keeps_null_and_boolean(spark, rows):
    df = spark.createDataFrame([(1, True, "a"), (2, None, "b")], "id int, flag boolean, name string")
    got = R.unpivot(df, exclude=["ID"], field_name="prop", value_name="val")
    assert rows(got) == [(1, "flag", "true"), (1, "name", "a"), (2, "flag", None), (2, "name", "b")]


def test_union_relations(spark, rows):
    a = spark.createDataFrame([(1, "x", 3)], "id int, name string, favorite_number int")
    b = spark.createDataFrame([(2, "red", 4)], "id int, favorite_color string, favorite_number int")
    got = R.union_relations({"a": a, "b": b})
    assert rows(got, "_source_relation", "id", "name", "favorite_number", "favorite_color") == [("a", 1, "x", 3, None), ("b", 2, None, 4, "red")]
    with pytest.raises(ValueError):
        R.union_relations({"a": a}, include=["id"], exclude=["name"])
    assert R.union_relations({"a": a, "b": b}, include=["ID"], source_column=None).columns == ["id"]


def test_series_and_spines(spark):
    assert [r[0] for r in R.generate_series(spark, 10).orderBy("generated_number").collect()] == list(range(1, 11))
    assert R.date_spine(spark, "day", "2018-01-01", "2018-01-10").count() == 9
    assert R.date_spine(spark, "day", "2018-01-10", "2018-01-01").count() == 0
    base = C.base_dates(spark, n_parts=3, part="day", as_of=F.lit(dt.date(2024, 1, 10)))
    assert sorted(r[0].day for r in base.collect()) == [7, 8, 9, 10]


def test_column_values_and_star(spark):
    df = spark.createDataFrame([(c,) for c in "abcdefggggg"], "v string")
    assert R.column_values(df, "v")[0] == "g" and R.column_values(df, "v", order="value", max_values=2) == ["a", "b"]
    assert R.column_values(df, "v", where="v = 'z'", default=["q"]) == ["q"]
    wide = spark.createDataFrame([("", 1, "x")], "a string, b int, c string")
    assert R.star(wide, drop=["C"], prefix="p_").columns == ["p_a", "p_b"]
    assert R.nullcheck(wide).first()["a"] is None and R.nullcheck(wide, ["c"]).first()["a"] == ""


def test_dedup_and_differences(spark, rows):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, "pause", 1)], "user_id int, event string, version int")
    assert rows(R.deduplicate(df.where("user_id = 1"), ["user_id"], [F.desc("version")])) == [(1, "play", 2)]
    a = spark.createDataFrame([(1,), (1,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (None,)], "x int")
    assert R.symmetric_difference(a, b).count() == 0 and R.symmetric_difference(a, b, multiset=True).count() == 1


def test_fiscal_calendar(spark):
    days = C.date_dimension(C.base_dates(spark, "2015-01-01", "2022-12-31"))
    years = C.fiscal_year_dates(days, year_end_month=1, week_start_day=1)
    one_year = years.where("fiscal_year_number = 2017").agg(F.count("*"), F.min("date_day"), F.max("fiscal_week_of_year"), F.max("date_day")).first()
    assert one_year[0] in (364, 371) and one_year[2] in (52, 53) and one_year[1].isoweekday() == 7 and one_year[3].isoweekday() == 6
    assert years.where("fiscal_year_start_date is null").count() == 0 and years.count() == years.select("date_day").distinct().count()
    periods = C.fiscal_periods(days, 1, 1)
    weeks = {(r[0], r[1]) for r in periods.select("fiscal_period_of_quarter", "fiscal_week_of_period").distinct().collect()}
    assert (2, 5) in weeks and (1, 5) not in weeks


def test_share_and_moments(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "k string, n int")
    assert rows(W.share_of_total(df, ["k"], "n", "share"), "k", "share") == [("a", 0.25), ("a", 0.75), ("b", 1.0)]
    assert sorted(round(r[0], 3) for r in W.z_score(df, "n", "z").select("z").collect()) == [-1.0, 0.0, 1.0]


def test_version_at(spark, rows):
    """Gaps, open ends, unknown days and keys that only meet when cleaned; a hot key over many years."""
    import datetime as dt

    d = dt.date
    versions = spark.createDataFrame([(" a", d(2020, 1, 1), d(2020, 6, 30), "a1"), ("a ", d(2020, 8, 1), None, "a2"), ("b", d(2021, 1, 1), d(2021, 1, 1), "b1")], "k string, since date, until date, version string")
    days = [d(2019, 12, 31), d(2020, 1, 1), d(2020, 6, 30), d(2020, 7, 1), d(2020, 8, 1), d(2099, 1, 1)]
    fact = spark.createDataFrame([(i, "a", x) for i, x in enumerate(days)] + [(10, "b", d(2021, 1, 1)), (11, "b", d(2021, 1, 2)), (12, None, d(2021, 1, 1)), (13, "a", None)], "id int, who string, day date")
    for chunk in (None, F.year("_time")):
        got = J.version_at(fact, versions, {"k": "who"}, "day", ("since", "until"), {"found": "version"}, ["id"], F.trim, chunk)
        assert rows(got, "id", "found") == [(0, None), (1, "a1"), (2, "a1"), (3, None), (4, "a2"), (5, "a2"), (10, "b1"), (11, None), (12, None), (13, None)]
        assert got.columns == [*fact.columns, "found"]
