"""Grouped aggregates. All combine on the map side, so a hot key costs its tasks no more than others."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions.columns import all_present, quoted
from almanac.operators.exact import limbs, rounded
from almanac.spec import Measure

def num_periods(df: DataFrame, period: str = "year") -> DataFrame:
    """One row with the number of distinct periods; NULL counts as one."""
    return df.select(quoted(period)).distinct().agg(F.count("*").alias("periods"))


def _number(measure: Measure) -> str:
    """The measure as a double; text that is no number is NULL."""
    return f"try_cast({quoted(measure.name)} as double)"


# Units up to here fit a long, and up to here a decimal sum of ten billion of them.
_LONG, _DECIMAL = "9e18D", "1e28D"


def _units(measure: Measure) -> str:
    return f"rint({_number(measure)} * {10**measure.scale}D)"


def _total(measure: Measure) -> str:
    """Sum of a measure with a scale, in units of its last decimal.

    Adding units is exact, and takes long arithmetic only: summing decimals would cost ten times as
    much. The low 20 bits and the rest are summed apart, so that no group of any real size overflows.
    Units that no long holds are summed as decimals; what no decimal holds is in ``_rest``.
    """
    units = _units(measure)
    whole = f"case when abs({units}) < {_LONG} then cast({units} as bigint) end"
    high = f"cast(sum(shiftright({whole}, 20)) as decimal(20,0))"
    low = f"cast(sum(({whole}) & {2**20 - 1}) as decimal(20,0))"
    small = f"cast({high} * {2**20} + {low} as decimal(38,0))"
    between = f"abs({units}) >= {_LONG} and abs({units}) < {_DECIMAL}"
    large = f"cast(sum(case when {between} then cast({units} as decimal(38,0)) end) as decimal(38,0))"
    return f"coalesce(cast({small} + {large} as decimal(38,0)), {small}, {large})"


def _rest(measure: Measure) -> str:
    """Sum of NaN, infinities and values beyond any decimal, so that means are what they are for doubles."""
    size = f"abs({_number(measure)}) < double('infinity')" if measure.scale is None else f"abs({_units(measure)}) < {_DECIMAL}"
    return f"sum(case when not {size} then {_number(measure)} end)"


def _columns(measure: Measure) -> tuple[str, str, str, str, str]:
    return tuple(quoted(f"{measure.name}_{part}") for part in ("total", "n", "avg", "rest", "limbs"))


_ONCE = -1  # the part that stands for the row itself, among its limbs
_PART = "_part of row"


def _key_names(keys: Sequence[str]) -> list[str]:
    """Names for keys that measures don't have, one of which may be a key."""
    return [f"_key {i}" for i in range(len(keys))]


def _with_limbs(df: DataFrame, keys: Sequence[str], found: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """Each row once with its ``columns``, and once per limb (measure, place, limb) with NULL in their stead."""
    kind = "array<struct<measure:int,place:int,limb:bigint>>"
    once = F.array(F.struct(F.lit(_ONCE).alias("measure"), F.lit(0).alias("place"), F.lit(0).cast("bigint").alias("limb"))).cast(kind)

    def of_measure(i: int) -> Callable[[Column], Column]:
        return lambda x: F.struct(F.lit(i).alias("measure"), x["place"].alias("place"), x["limb"].alias("limb"))

    parts = [F.coalesce(F.transform(own, of_measure(i)).cast(kind), F.array().cast(kind)) for i, own in enumerate(found)]
    keyed = [F.col(quoted(k)).alias(name) for k, name in zip(keys, _key_names(keys))]
    rows = df.select(*keyed, *map(quoted, dict.fromkeys(columns)), F.explode(F.concat(once, *parts)).alias(_PART))
    own = [F.when(F.col(f"{_PART}.measure") == _ONCE, F.col(quoted(c))).alias(c) for c in dict.fromkeys(columns)]
    return rows.select(*_key_names(keys), _PART, *own)


def _gathered(rows: DataFrame, keys: Sequence[str], loose: Sequence[Measure], sums: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per key from ``_with_limbs``: limbs are added by place, then those of a measure become a map.

    Both steps combine on the map side; a key has at most some hundred places per measure.
    """
    keyed = _key_names(keys)
    places = [F.col(f"{_PART}.measure").alias("_measure"), F.col(f"{_PART}.place").alias("_place")]
    added = rows.groupBy(*keyed, *places).agg(
        F.sum(f"{_PART}.limb").alias("_limb"), *[F.expr(f"{expression} as `_sum {i}`") for i, (expression, _) in enumerate(sums)]
    )
    # Only the rows themselves have sums.
    once = [F.max(F.when(F.col("_measure") == _ONCE, F.col(f"_sum {i}"))).alias(f"_sum {i}") for i in range(len(sums))]
    maps = [
        F.map_from_entries(F.collect_list(F.when(F.col("_measure") == i, F.struct("_place", "_limb")))).alias(f"_limbs {i}")
        for i in range(len(loose))
    ]
    found = added.groupBy(*keyed).agg(*once, *maps)
    named = [*zip(keyed, map(quoted, keys)), *((f"_sum {i}", name) for i, (_, name) in enumerate(sums))]
    named += [(f"_limbs {i}", _columns(m)[4]) for i, m in enumerate(loose)]
    return found.selectExpr(*[f"{quoted(old)} as {new}" for old, new in named])


def _ordered(totals: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Columns measure by measure; the total of a measure without a scale is the double nearest to its exact sum."""
    columns = []
    for m in measures:
        total, n, _, rest, exact = _columns(m)
        if m.scale is None:
            whole = F.when(F.col(n) > 0, rounded(F.col(exact)) + F.coalesce(F.col(rest), F.lit(0.0)))
            columns += [whole.alias(f"{m.name}_total"), F.col(n), F.col(rest), F.col(exact)]
        else:
            columns += [F.col(total), F.col(n), F.col(rest)]
    return totals.select(*map(quoted, keys), *columns)


def period_totals(df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Total and number of non-NULL values of every measure per key, in one pass over ``df``.

    Columns ``<measure>_total``, ``<measure>_n``, and ``<measure>_rest``: the sum of what is no finite number (or, with a scale, none of
    decimal size). For a measure without a scale, ``<measure>_limbs`` is its exact sum in limbs (see ``exact``), which costs
    up to five rows per value before they are combined; declare a scale where there is one. No sum depends on
    the order of rows. Rows with NULL keys form groups as well.
    """
    loose = [m for m in measures if m.scale is None]
    sums = []
    for m in measures:
        total, n, _, rest, _ = _columns(m)
        sums += [] if m.scale is None else [(_total(m), total)]
        sums += [(f"count({_number(m)})", n), (_rest(m), rest)]
    if not loose:
        return df.groupBy(*map(quoted, keys)).agg(*[F.expr(f"{expression} as {name}") for expression, name in sums])
    rows = _with_limbs(df, keys, [limbs(F.expr(_number(m))) for m in loose], [m.name for m in measures])
    return _ordered(_gathered(rows, keys, loose, sums), keys, measures)


def roll_up(totals: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Totals over fewer or coarser keys, from totals over finer ones."""
    loose = [m for m in measures if m.scale is None]
    sums, columns = [], []
    for m in measures:
        total, n, _, rest, _ = _columns(m)
        sums += [] if m.scale is None else [(f"cast(sum({total}) as decimal(38,0))", total)]
        sums += [(f"sum({n})", n), (f"sum({rest})", rest)]
        columns += [f"{m.name}_{part}" for part in (("n", "rest") if m.scale is None else ("total", "n", "rest"))]
    if not loose:
        return totals.groupBy(*map(quoted, keys)).agg(*[F.expr(f"{expression} as {name}") for expression, name in sums])
    entries = [F.map_entries(F.col(quoted(f"{m.name}_limbs"))) for m in loose]
    own = [F.transform(e, lambda x: F.struct(x["key"].alias("place"), x["value"].alias("limb"))) for e in entries]
    return _ordered(_gathered(_with_limbs(totals, keys, own, columns), keys, loose, sums), keys, measures)


def as_means(totals: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """``<measure>_avg`` from totals; NULL where a measure has no values."""
    averages = []
    for m in measures:
        total, n, average, rest, _ = _columns(m)
        whole = f"cast({total} as double)"
        if m.scale is not None:
            whole = f"(coalesce({whole}, 0D) / {float(10**m.scale)}D + coalesce({rest}, 0D))"
        averages.append(f"{whole} / nullif({n}, 0) as {average}")
    return totals.selectExpr(*[quoted(key) for key in keys], *averages)


def means(df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Means of all measures per key. Rows with a NULL key belong to no group."""
    keyed = df.filter(all_present(keys))
    return as_means(period_totals(keyed, keys, measures), keys, measures)


def first_seen(df: DataFrame, entity: str = "station", period: str = "year") -> DataFrame:
    return df.groupBy(quoted(entity)).agg(F.min(quoted(period)).alias(f"min_{period}"))


def max_by_entity(df: DataFrame, measures: Sequence[str], entity: str = "station") -> DataFrame:
    """Maximum of each measure per entity, ``max_<measure>``, in one pass."""
    return df.groupBy(quoted(entity)).agg(*[F.max(quoted(m)).alias(f"max_{m}") for m in measures])


def join_on_keys(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Inner join of several tables on the same keys.

    For tables from different inputs. Means of several measures of one table need no join: ``means``
    computes them together.
    """
    return reduce(lambda left, right: left.join(right, list(keys), "inner"), frames)
