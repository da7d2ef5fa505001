import random
from decimal import Decimal

import pytest

from almanac import STATION_REPORT, Measure, ObservationSpec
from almanac.operators import deltas, trend_text, trend_totals, with_next
from almanac.plans import trend
from tests.conftest import rows

A, B = Measure("a", "first", "mm"), Measure("b", "second", "degC")
OBS = "station string, year int, month int, a double, b double"
SPEC = ObservationSpec((Measure("a", "first", "mm", 1), Measure("b", "second", "degC", 1)))


def test_change_goes_to_the_next_period_present(spark):
    df = spark.createDataFrame([(1990, 1.0, 5.0), (1995, 4.0, None), (1991, 2.0, 6.0)], "year int, a_avg double, b_avg double")
    assert rows(deltas(df, [A, B])) == [(1990, 1.0, 1.0), (1991, 2.0, None), (1995, None, None)]


def test_changes_stay_within_their_group(spark):
    data = [("x", 1, 1.0), ("x", 2, 3.0), ("y", 1, 10.0), ("y", 3, 5.0)]
    df = spark.createDataFrame(data, "season string, year int, a_avg double")
    changes = deltas(df, [A], ["season"])
    assert changes.columns == ["season", "year", "a"]
    assert rows(changes) == [("x", 1, 2.0), ("x", 2, None), ("y", 1, -5.0), ("y", 3, None)]


def test_drop_last_drops_one_row_per_group_and_rows_before_gaps(spark):
    data = [("s", "x", y, float(y), float(-y)) for y in range(1, 6)] + [("s", "y", 1, 1.0, 1.0)]
    df = spark.createDataFrame(data, "station string, season string, year int, a_avg double, b_avg double")
    found = deltas(df, [A, B], ["station", "season"], drop_last=True)
    assert rows(found) == [("s", "x", y, 1.0, -1.0) for y in range(1, 5)]
    gap = df.selectExpr("station", "season", "year", "a_avg", "if(year = 3, null, b_avg) b_avg")
    assert [r.year for r in deltas(gap, [A, B], ["station", "season"], drop_last=True).orderBy("year").collect()] == [1, 3, 4]


def test_each_change_is_rounded_half_up_before_summing(spark):
    df = spark.createDataFrame([(0.5,), (0.5,), (-0.5,), (-1.5,), (0.4,), (None,)], "a double")
    assert rows(trend_totals(df, [A])) == [(Decimal(-1),)]
    by = df.selectExpr("a < 0 as neg", "a").filter("neg is not null")
    assert rows(trend_totals(by, [A], ["neg"])) == [(False, Decimal(2)), (True, Decimal(-3))]


def test_large_changes_count(spark):
    df = spark.createDataFrame([(1e12,), (3.0,), (1e30,), (float("nan"),), (float("-inf"),), (None,)], "a double")
    assert rows(trend_totals(df, [A])) == [(Decimal(10**30 + 10**12 + 3),)]
    assert rows(trend_totals(df, [A], digits=10)) == [(Decimal(3),)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_change_that_no_decimal_holds_fails(spark, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    with pytest.raises(Exception, match="change too large to add"):
        trend_totals(spark.createDataFrame([(1e39,), (3.0,)], "a double"), [A]).collect()


def test_years_may_be_called_years(spark):
    spec = ObservationSpec((Measure("a.b", "first", "mm", 1),), year="years")
    df = spark.createDataFrame([("s", 1990, 1, 1.0), ("s", 1991, 1, 4.0)], "station string, years int, month int, `a.b` double")
    assert rows(trend(df, spec).select("measure", "change", "years")) == [("a.b", Decimal(3), 2)]
    assert rows(trend(df, spec, by_season=True).select("season", "change")) == [("winter", Decimal(3))]


def test_sentences(spark):
    totals = spark.createDataFrame([(Decimal(-5), Decimal(0))], "a decimal(20,0), b decimal(20,0)")
    assert rows(trend_text(totals, [A, B], years=130).select("measure", "change", "years", "patterns")) == [
        ("a", Decimal(-5), 130, "The avg first reduced by 5mm over the past 130 years"),
        ("b", Decimal(0), 130, "The avg second increased by 0degC over the past 130 years"),
    ]
    grouped = totals.selectExpr("'summer' season", "a", "cast(null as decimal(20,0)) b", "7L years")
    assert rows(trend_text(grouped, [A, B], by="season").select("season", "measure", "patterns")) == [
        ("summer", "a", "The summer avg first reduced by 5mm over the past 7 years"),
        ("summer", "b", None),
    ]


def test_sentences_of_station_reports(spark):
    names = STATION_REPORT.measure_names
    totals = spark.createDataFrame([tuple(Decimal(i) for i in range(1, 6))], ", ".join(f"{n} decimal(20,0)" for n in names))
    assert [r.patterns for r in trend_text(totals, STATION_REPORT.measures, years=2).collect()] == [
        "The avg maximum temperature increased by 1degC over the past 2 years",
        "The avg minimum temperature increased by 2degC over the past 2 years",
        "The avg frosty days increased by 3days over the past 2 years",
        "The avg rainfall increased by 4mm over the past 2 years",
        "The avg sunshine increased by 5hours over the past 2 years",
    ]


def test_any_text_can_be_a_label(spark):
    odd = Measure("a", "it's a \\ {label}", "%")
    totals = spark.createDataFrame([(Decimal(2),)], "a decimal(20,0)")
    assert trend_text(totals, [odd], years=3).first().patterns == "The avg it's a \\ {label} increased by 2% over the past 3 years"


def observed(spark, data):
    return spark.createDataFrame([("s", *r) for r in data], OBS)


def test_trend_over_all_months(spark):
    df = observed(spark, [(1990, 1, 1.0, 9.0), (1990, 7, 3.0, 9.0), (1992, 1, 6.0, 5.0)])
    assert rows(trend(df, SPEC)) == [
        ("a", Decimal(4), 2, "The avg first increased by 4mm over the past 2 years"),
        ("b", Decimal(-4), 2, "The avg second reduced by 4degC over the past 2 years"),
    ]


def test_trend_by_season(spark):
    df = observed(spark, [(1990, 1, 1.0, 9.0), (1991, 12, 3.0, 9.0), (1990, 7, 3.0, 1.0), (1993, 7, 2.0, None)])
    found = trend(df, SPEC, by_season=True).select("season", "measure", "change", "years")
    assert rows(found) == [
        ("summer", "a", Decimal(-1), 3),
        ("summer", "b", None, 3),
        ("winter", "a", Decimal(2), 3),
        ("winter", "b", Decimal(0), 3),
    ]


@pytest.mark.parametrize("by_season", [False, True])
def test_null_years_and_months_count_as_years_but_not_in_changes(spark, by_season):
    data = [(1990, 1, 1.0, 1.0), (1991, 1, 2.0, 2.0), (None, 1, 50.0, 50.0), (1999, None, 4.0, 4.0), (2001, 13, 4.0, 4.0)]
    found = trend(observed(spark, data), SPEC, by_season).select("measure", "change", "years")
    change = Decimal(1) if by_season else Decimal(3)
    assert rows(found) == [("a", change, 5), ("b", change, 5)]


def test_trend_of_nothing(spark):
    empty = observed(spark, []).filter("false")
    assert rows(trend(empty, SPEC)) == [("a", None, 0, None), ("b", None, 0, None)]
    assert rows(trend(empty, SPEC, by_season=True)) == []


def test_trend_does_not_depend_on_how_rows_are_spread(spark):
    import random

    rng = random.Random(2)
    data = [(rng.randint(1900, 1999), rng.randint(1, 12), round(rng.uniform(-9, 99), 1), 0.1) for _ in range(20_000)]
    df = observed(spark, data)
    found = [rows(trend(df.repartition(n), SPEC, by_season=True)) for n in (1, 5, 16)]
    assert found[0] == found[1] == found[2]


@pytest.mark.parametrize("by", [[], ["g"], ["g", "h"]])
def test_next_rows_across_partitions(spark, conf, by):
    """Groups that span partitions, that end with one, and that are one row each."""
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(len(by))
    periods = rng.sample(range(10_000), 400)
    data = [(rng.choice([None, "a", "a", "a", "b"]), rng.randrange(2) if i % 50 else i, p, rng.choice([None, float(i)])) for i, p in enumerate(periods)]
    df = spark.createDataFrame(data, "g string, h int, period int, x double").repartition(6)
    found = with_next(df, ["x", "period"], "period", by)
    assert found.columns == ["g", "h", "period", "x", "_next_x", "_next_period"]
    expected, after = [], {}
    for row in sorted(data, key=lambda r: -r[2]):
        group = tuple(row[["g", "h"].index(b)] for b in by)
        expected.append((*row, *after.get(group, (None, None))))
        after[group] = (row[3], row[2])
    assert rows(found) == rows(spark.createDataFrame(expected, found.schema))
    assert df.count() == 400 and len(found.inputFiles()) > 4


def test_next_row_of_an_empty_table(spark):
    assert with_next(spark.createDataFrame([], "year int, x double"), ["x"], "year").count() == 0
