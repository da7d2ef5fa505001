import random
from decimal import Decimal
from fractions import Fraction

import pytest

from almanac import Measure
from almanac.functions import with_season
from almanac.operators import (
    as_means,
    first_seen,
    join_on_keys,
    max_by_entity,
    means,
    num_periods,
    period_totals,
    roll_up,
)
from tests.conftest import rows

X = Measure("x", scale=2)
Y = Measure("y")


def test_periods_count_null_as_one(spark):
    df = spark.createDataFrame([(1990,), (1990,), (1991,), (None,), (None,)], "year int")
    assert rows(num_periods(df)) == [(3,)]
    assert rows(num_periods(df.filter("false"))) == [(0,)]


def test_means_leave_out_null_keys_and_null_values(spark):
    data = [(1990, "a", 1.0), (1990, "a", None), (1990, "a", 2.0), (1991, None, 5.0), (None, "a", 7.0), (1991, "b", None)]
    df = spark.createDataFrame(data, "year int, season string, x double")
    for measure in (X, Measure("x")):
        assert rows(means(df, ["year"], [measure])) == [(1990, 1.5), (1991, 5.0)]
        assert rows(means(df, ["year", "season"], [measure])) == [(1990, "a", 1.5), (1991, "b", None)]


def test_exact_mean_does_not_depend_on_order(spark):
    rng = random.Random(5)
    values = [round(rng.uniform(-1e9, 1e9), 2) for _ in range(3000)] + [0.01] * 1000
    exact = sum(Fraction(Decimal(repr(v))) for v in values)
    for seed in range(3):
        rng.shuffle(values)
        df = spark.createDataFrame([(1, v) for v in values], "k int, x double").repartition(7 + seed)
        total = period_totals(df, ["k"], [X]).first()
        assert (Fraction(int(total.x_total), 100), total.x_n) == (exact, 4000)
        assert means(df, ["k"], [X]).first().x_avg == float(exact * 100) / 100 / 4000


@pytest.mark.parametrize("value", [9e13, -9e13, 1234.56, -0.01])
def test_totals_do_not_overflow(spark, value):
    df = spark.range(0, 4000, 1, 4).selectExpr("1 k", f"cast({value!r} as double) x")
    total = period_totals(df, ["k"], [X]).first().x_total
    assert total == round(Decimal(repr(value)) * 100) * 4000


def test_totals_of_strings_are_totals_of_their_numbers(spark):
    df = spark.createDataFrame([("1.50",), ("2",), ("Provisional",), ("99.9$",), (None,)], "x string")
    for measure in (X, Measure("x")):
        assert rows(means(df.selectExpr("1 k", "x"), ["k"], [measure])) == [(1, 1.75)]


def test_rolling_up_equals_grouping_directly(spark):
    rng = random.Random(7)
    data = [
        (rng.choice([1990, 1991, None]), rng.choice([*range(1, 13), None, 13]), round(rng.uniform(-9, 9), 2), rng.choice([None, 1.0, 4.0]))
        for _ in range(3000)
    ]
    df = spark.createDataFrame(data, "year int, month int, x double, y double")
    fine = period_totals(df, ["year", "month"], [X, Y])
    for keys in (["year"], ["year", "season"]):
        rolled = as_means(roll_up(with_season(fine), keys, [X, Y]), keys, [X, Y])
        direct = as_means(period_totals(with_season(df), keys, [X, Y]), keys, [X, Y])
        assert rows(rolled) == rows(direct)


def test_seasons(spark):
    df = spark.createDataFrame([(m,) for m in [*range(0, 14), None]], "month int")
    found = {r.month: r.season for r in with_season(df).collect()}
    assert [found[m] for m in (12, 1, 2, 3, 5, 6, 8, 9, 11)] == (
        ["winter"] * 3 + ["spring"] * 2 + ["summer"] * 2 + ["autumn"] * 2
    )
    assert [found[m] for m in (0, 13, None)] == [None] * 3


def test_first_seen_and_maxima(spark):
    data = [("a", 1992, 1.0, "9"), ("a", 1990, 3.0, "10"), ("b", None, None, None), ("b", 1999, None, "x")]
    df = spark.createDataFrame(data, "station string, year int, x double, s string")
    assert rows(first_seen(df)) == [("a", 1990), ("b", 1999)]
    assert rows(max_by_entity(df, ["x", "s"])) == [("a", 3.0, "9"), ("b", None, "x")]


def test_join_on_keys_is_inner_and_drops_null_keys(spark):
    a = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "k int, a int")
    b = spark.createDataFrame([(1, 11), (None, 31), (3, 41)], "k int, b int")
    c = spark.createDataFrame([(1, 12), (1, 13)], "k int, c int")
    assert rows(join_on_keys([a, b, c], ["k"])) == [(1, 10, 11, 12), (1, 10, 11, 13)]
    assert rows(join_on_keys([a], ["k"])) == rows(a)


def test_a_larger_scale_gives_the_same_means(spark):
    rng = random.Random(9)
    data = [(rng.randint(1, 20), round(rng.uniform(-50, 300), 1)) for _ in range(5000)]
    df = spark.createDataFrame(data, "k int, x double")
    found = [rows(means(df, ["k"], [Measure("x", scale=s)])) for s in (1, 2, 4, 6)]
    assert found[0] == found[1] == found[2] == found[3]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_values_of_any_size_are_averaged(spark, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    nan, inf = float("nan"), float("inf")
    data = [("a", 1e15), ("a", 3e15), ("b", nan), ("b", 2.0), ("c", inf), ("c", 1.0), ("d", 1e300), ("d", 1e300), ("e", 1e22), ("e", -1e22), ("e", 0.03), ("f", None)]
    df = spark.createDataFrame(data, "k string, x double")
    found = dict(rows(means(df, ["k"], [Measure("x", scale=4)])))
    assert (found["a"], found["c"], found["d"], found["f"]) == (2e15, inf, 1e300, None)
    assert found["b"] != found["b"]
    assert found["e"] == 0.01
    rolled = roll_up(period_totals(df, ["k"], [X]), ["k"], [X])
    assert dict(rows(as_means(rolled, ["k"], [X])))["a"] == 2e15


def test_names_with_dots(spark):
    df = spark.createDataFrame([("s", 1990, 1.5), ("s", 1991, 2.5)], "`my.station` string, `a.year` int, `rain.mm` double")
    rain = Measure("rain.mm", scale=1)
    assert rows(means(df, ["my.station"], [rain])) == [("s", 2.0)]
    assert rows(first_seen(df, "my.station", "a.year")) == [("s", 1990)]
    assert rows(max_by_entity(df, ["rain.mm"], "my.station")) == [("s", 2.5)]
    assert rows(num_periods(df, "a.year")) == [(2,)]
