"""Period-to-period changes and what they add up to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions.columns import all_present, quoted, trend_sentence
from almanac.operators.order import with_next
from almanac.spec import Measure

#: Digits of the largest change that can be added.
DIGITS = 38


def deltas(
    means: DataFrame,
    measures: Sequence[Measure],
    by: Sequence[str] = (),
    period: str = "year",
    keep: Sequence[str] = (),
    drop_last: bool = False,
) -> DataFrame:
    """Change of every ``<measure>_avg`` to the next period present, as ``<measure>``.

    ``means`` has one row per (by…, period). The lead is taken over range partitions (``with_next``), so periods may
    be years or instants and as many as rows; no task has to hold all of them. The last period's change is NULL.
    ``drop_last`` keeps only rows whose successor has all measures; one filter after all leads, so that a group loses its
    last row once and not once per measure.
    """
    averages = {m.name: f"{m.name}_avg" for m in measures}
    keys = list(dict.fromkeys((*by, period, *keep)))
    wide = means.select(*map(quoted, [*keys, *averages.values()]))
    leads = with_next(wide, list(averages.values()), period, by)
    if drop_last:
        leads = leads.filter(all_present([f"_next_{a}" for a in averages.values()]))
    changes = [f"{quoted('_next_' + a)} - {quoted(a)} as {quoted(m)}" for m, a in averages.items()]
    return leads.selectExpr(*map(quoted, keys), *changes)


def trend_totals(
    changes: DataFrame,
    measures: Sequence[Measure],
    by: Sequence[str] = (),
    extra: Sequence[Column] = (),
    digits: int = DIGITS,
) -> DataFrame:
    """Sum of each measure's changes, each rounded half up to an integer before; all in one pass.

    NaN and infinite changes count for nothing, like NULL. A finite change of more than 38 digits fails
    the query rather than leave the sum. ``digits=10`` leaves out larger changes, as an older job did.
    """
    sums = [F.expr(f"sum({_rounded(quoted(m.name), digits)}) as {quoted(m.name)}") for m in measures]
    return changes.groupBy(*map(quoted, by)).agg(*sums, *extra)


def _rounded(name: str, digits: int) -> str:
    whole = f"try_cast({name} as decimal({digits},0))"
    if digits < DIGITS:
        return whole
    finite = f"abs({name}) < double('infinity')"
    lost = f"cast(raise_error(concat('change too large to add: ', {name})) as decimal({DIGITS},0))"
    return f"case when {finite} then coalesce({whole}, {lost}) end"


def trend_text(
    totals: DataFrame, measures: Sequence[Measure], years: str | int = "years", by: str | None = None
) -> DataFrame:
    """Rows (by?, measure, change, years, patterns) from ``trend_totals``, one per measure.

    ``years`` is the number of periods, or the column of ``totals`` that has it.
    """
    ids = [by] if by else []
    names = [m.name for m in measures]
    count = F.col(years) if isinstance(years, str) else F.lit(years)
    ids = [quoted(i) for i in ids]
    wide = totals.select(*ids, count.cast("bigint").alias("years"), *map(quoted, names))
    rows = wide.unpivot([*ids, "years"], [quoted(n) for n in names], "measure", "change")
    return rows.select(*ids, "measure", "change", "years", trend_sentence(measures, by).alias("patterns"))
