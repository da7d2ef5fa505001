"""Sums of doubles against the correctly rounded sum, in any order and number of partitions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from almanac import Measure
from almanac import operators as op
from almanac.operators import exact

INF, NAN = float("inf"), float("nan")


def groups(seed):
    rng = random.Random(seed)
    out = [
        [1.5, -1.5], [1e-12, 1e12, -1e12], [5e-324] * 3, [1.7e308, -1.7e308, 1e-300], [0.1] * 10, [2.0**53, 1.0], [2.0**53, 1.0, 2.0**-60],
        [-0.1] * 7, [2.0**20 - 1, 2.0**40, -(2.0**60)], [0.0, -0.0], [2.0**900, 2.0**901], [-5e-324], [2.0**60, -(2.0**60), -1.0],
    ]
    out += [[rng.choice([-1, 1]) * rng.random() * 10 ** rng.uniform(-12, 12) for _ in range(rng.randrange(1, 40))] for _ in range(150)]
    out += [[rng.choice([-1, 1]) * math.ldexp(rng.random(), rng.randrange(-1070, 1000)) for _ in range(rng.randrange(1, 30))] for _ in range(60)]
    return out


def test_totals_are_correctly_rounded(spark):
    data = groups(1)
    rows = [(g, x) for g, values in enumerate(data) for x in values]
    found = op.period_totals(spark.createDataFrame(rows, "g int, x double"), ["g"], [Measure("x")])
    assert {r.g: r.x_total for r in found.collect()} == {g: math.fsum(values) for g, values in enumerate(data)}


def test_means_do_not_depend_on_the_order_of_rows(spark):
    rng = random.Random(2)
    rows = [(i % 5, rng.choice([-1, 1]) * 10 ** rng.uniform(-12, 12), rng.choice([None, 0.1, 1e300, -1e300]), i % 7 / 4) for i in range(4000)]
    measures = [Measure("x"), Measure("y"), Measure("z", scale=2)]
    seen = []
    for parts in (1, 7, 200):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "g int, x double, y double, z double").repartition(parts)
        seen.append(sorted(tuple(r) for r in op.means(df, ["g"], measures).collect()))
    assert seen[0] == seen[1] == seen[2]
    assert seen[0] == [
        (g, *(math.fsum(v) / len(v) for v in ([r[k] for r in rows if r[0] == g and r[k] is not None] for k in (1, 2, 3)))) for g in range(5)
    ]


def test_rolled_up_totals_equal_direct_ones(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2]), rng.randrange(12), rng.choice([None, rng.gauss(0, 1e8), rng.random() * 1e-9]), rng.randrange(100) / 10) for _ in range(2000)]
    df = spark.createDataFrame(rows, "year int, month int, x double, y double")
    measures = [Measure("x"), Measure("y", scale=1)]
    fine = op.period_totals(df, ["year", "month"], measures)
    assert fine.columns == ["year", "month", "x_total", "x_n", "x_rest", "x_limbs", "y_total", "y_n", "y_rest"]
    coarse = op.roll_up(fine, ["year"], measures)
    direct = op.period_totals(df, ["year"], measures)
    key = lambda r: (r.year is not None, r.year or 0)
    columns = [c for c in coarse.columns if c != "x_limbs"]
    assert sorted(coarse.select(columns).collect(), key=key) == sorted(direct.select(columns).collect(), key=key)


@pytest.mark.parametrize("values, total", [([None], None), ([], None), ([0.0, None], 0.0), ([1.0, INF], INF), ([INF, -INF], NAN), ([NAN, 1e300], NAN), ([-INF, 1.0], -INF)])
def test_odd_values(spark, values, total):
    df = spark.createDataFrame([(1, v) for v in values], "g int, x double")
    found = [r.x_total for r in op.period_totals(df, ["g"], [Measure("x")]).collect()]
    assert found == ([total] if values else []) or (total is NAN and math.isnan(found[0]))


def test_limbs_add_up_to_the_number(spark):
    numbers = [x for values in groups(4) for x in values]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(numbers)], "i int, x double")
    for r in df.select("x", exact.limbs(F.col("x")).alias("l")).collect():
        assert sum(int(x.limb) * 2 ** (20 * (x.place + 100)) for x in r.l) == int(math.ldexp(r.x, 0).as_integer_ratio()[0]) * 2**2000 // r.x.as_integer_ratio()[1]
        assert all(abs(x.limb) < 2**20 for x in r.l)


def test_measures_and_keys_with_odd_names(spark):
    df = spark.createDataFrame([(1, 0.5, 2), (1, 0.25, 2)], "`k.1` int, `a``b` double, _limb int")
    found = op.means(df, ["k.1"], [Measure("a`b")])
    assert [tuple(r) for r in found.collect()] == [(1, 0.375)]
    same = op.means(df, ["_limb"], [Measure("_limb"), Measure("a`b")])
    assert [tuple(r) for r in same.collect()] == [(2, 2.0, 0.375)]
