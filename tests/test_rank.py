import random

import pytest

from almanac.operators import best_worst, rank_global
from tests.conftest import rows

ORDER = [("sun_avg", "desc"), ("tmax_avg", "desc"), ("tmin_avg", "desc"), ("rain_avg", "asc"), ("af_avg", "asc")]
SCHEMA = "year int, tmax_avg double, tmin_avg double, af_avg double, rain_avg double, sun_avg double"


def sort_key(direction):
    """Python sort key with Spark's NULL placement, for numbers."""
    sign = 1 if direction == "asc" else -1
    last = direction == "desc"
    return lambda v: (last, 0) if v is None else (not last, sign * v)


def expected(data, names, order):
    keys = [(names.index(n), sort_key(d)) for n, d in order]
    ordered = sorted(data, key=lambda r: tuple(k(r[i]) for i, k in keys))
    return sorted(
        (tuple([*r, i + 1]) for i, r in enumerate(ordered)), key=lambda r: r[-1]
    )


@pytest.mark.parametrize("directions", [("asc", "asc", "asc"), ("desc", "asc", "asc"), ("desc", "asc", "desc")])
def test_ranks_equal_sorting_with_nulls_and_ties(spark, directions):
    rng = random.Random(1)
    data = [(rng.choice([None, 1, 2, 3]), rng.choice([None, 0.5, 1.5, -2.0]), i) for i in range(3000)]
    names = ["a", "b", "k"]
    order = list(zip(names, directions))
    df = spark.createDataFrame(data, "a int, b double, k int").repartition(5)
    ranked = rank_global(df, order)
    assert ranked.columns == [*names, "rank"]
    assert sorted((tuple(r) for r in ranked.collect()), key=lambda r: r[-1]) == expected(data, names, order)


def test_one_value_in_all_rows_is_still_sorted_by_several_tasks(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(20_000).selectExpr("1995 as min_year", "id as station").repartition(5)
    ranked = rank_global(df, [("min_year", "asc"), ("station", "asc")])
    assert ranked.filter("rank <> station + 1").count() == 0
    assert ranked.selectExpr("max(rank)", "count(distinct rank)").first() == (20_000, 20_000)
    assert len(ranked.inputFiles()) == 8  # one sorted file per shuffle partition, however many cores there are


def test_empty_table_has_no_ranks(spark):
    df = spark.createDataFrame([], "a int, k int")
    assert rows(rank_global(df, [("a", "asc"), ("k", "asc")])) == []


def test_direction_must_be_known(spark):
    with pytest.raises(ValueError, match="up"):
        rank_global(spark.range(1), [("id", "up")])


def test_best_and_worst(spark):
    data = [
        (2001, 10.0, 5.0, 1.0, 50.0, 200.0),
        (2002, 11.0, 5.0, 1.0, 50.0, 200.0),
        (2003, 11.0, 5.0, 1.0, 40.0, 200.0),
        (2004, 30.0, 9.0, 0.0, 1.0, 100.0),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(best_worst(df, "year", ORDER)) == [("best_year", 2003), ("worst_year", 2004)]


def test_null_sun_is_worst_and_null_rain_is_best(spark):
    data = [
        (2001, 10.0, 5.0, 1.0, 50.0, None),
        (2002, 10.0, 5.0, 1.0, None, 200.0),
        (2003, 10.0, 5.0, 1.0, 0.0, 200.0),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(best_worst(df, "year", ORDER)) == [("best_year", 2002), ("worst_year", 2001)]


def test_ties_are_told_apart_by_the_period(spark):
    df = spark.createDataFrame([(y, 1.0, 1.0, 1.0, 1.0, 1.0) for y in (2003, 2001, 2002)], SCHEMA)
    assert rows(best_worst(df, "year", ORDER)) == [("best_year", 2001), ("worst_year", 2003)]


def test_one_row_is_both_and_none_is_neither(spark):
    df = spark.createDataFrame([(2001, 1.0, 1.0, 1.0, 1.0, 1.0)], SCHEMA)
    assert rows(best_worst(df, "year", ORDER)) == [("best_year", 2001), ("worst_year", 2001)]
    assert rows(best_worst(df.filter("false"), "year", ORDER)) == []


def test_best_and_worst_are_first_and_last_rank(spark):
    rng = random.Random(3)
    for _ in range(3):
        data = [(y, *[rng.choice([None, 1.0, 2.0]) for _ in range(5)]) for y in range(1900, 1960)]
        df = spark.createDataFrame(data, SCHEMA)
        ranked = {r.rank: r.year for r in rank_global(df, [*ORDER, ("year", "asc")]).collect()}
        assert rows(best_worst(df, "year", ORDER)) == [("best_year", ranked[1]), ("worst_year", ranked[60])]
