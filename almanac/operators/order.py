"""Tables in a total order that no single task sorts, and what follows each row in it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.functions.columns import quoted
from almanac.sources.shared import materialise

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below

#: Names of a sorted table's columns: the place of a row, and the sorted partition it is in.
PLACE, PART = "_place", "_part"


def sorted_table(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order`` in the shared folder, with ``_place`` and ``_part``.

    Places grow with the order but have gaps between partitions; being written, they stay what they are.
    """
    placed = materialise(df.orderBy(*order).withColumn(PLACE, F.monotonically_increasing_id()), name)
    return placed.withColumn(PART, F.shiftright(PLACE, _ROW_BITS))


def row_in_part() -> Column:
    return F.col(PLACE).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))


def with_next(df: DataFrame, columns: Sequence[str], period: str, by: Sequence[str] = (), prefix: str = "_next_") -> DataFrame:
    """``df`` with ``_next_<column>``: what the row of the next period has, of those with equal ``by``.

    NULL for the last row of each group. The table is range-partitioned by group and period, so neither a group with very many
    periods nor the whole of an ungrouped table is one task's. Each partition looks ahead by itself, and its last
    row takes the first row of the next partition, from a table of one row per partition. NULL groups are
    groups; a NULL period is before all others. Runs one job, for the sorted table.
    """
    order = [F.col(quoted(c)).asc_nulls_first() for c in (*by, period)]
    placed = sorted_table(df, order, "in-order")
    inside = Window.partitionBy(PART).orderBy(PLACE)
    wanted = [F.col(quoted(c)) for c in dict.fromkeys((*by, *columns))]
    # The first row of each partition, handed to the partition before it. Partitions may be empty.
    first = placed.groupBy(PART).agg(F.min_by(F.struct(*wanted), PLACE).alias("_first"))
    first = materialise(first, "first-rows")
    before = first.select(F.lag(PART).over(Window.orderBy(PART)).alias(PART), "_first").filter(F.col(PART).isNotNull())
    ahead = placed.withColumn("_ahead", F.lead(F.struct(*wanted)).over(inside))
    joined = ahead.join(F.broadcast(before), PART, "left").withColumn("_then", F.coalesce("_ahead", "_first"))
    same = F.lit(True)
    for name in by:
        same = same & F.col(quoted(name)).eqNullSafe(F.col("_then")[name])
    nexts = [F.when(same, F.col("_then")[c]).alias(f"{prefix}{c}") for c in columns]
    return joined.select(*[F.col(quoted(c)) for c in df.columns], *nexts)
