"""Rankings over a whole table, and the first and last row of one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.functions.columns import quoted
from almanac.operators.order import PART, row_in_part, sorted_table

Order = Sequence[tuple[str, str]]


def ordering(order: Order, reverse: bool = False) -> list[Column]:
    """Sort columns from (name, "asc" | "desc") pairs.

    NULL comes first in ascending and last in descending order; ``reverse`` turns both round.
    """
    columns = []
    for name, direction in order:
        if direction not in ("asc", "desc"):
            raise ValueError(f"direction of {name} must be asc or desc, not {direction!r}")
        ascending, column = (direction == "asc") != reverse, F.col(quoted(name))
        columns.append(column.asc_nulls_first() if ascending else column.desc_nulls_last())
    return columns


def rank_global(df: DataFrame, order: Order, name: str = "rank") -> DataFrame:
    """Number all rows from 1 in the given order, without gaps or shared ranks.

    End ``order`` with a column that tells all rows apart (an entity key), or rows that tie get their
    ranks in arbitrary order.

    An unpartitioned ``row_number`` would sort the table in one task. Here Spark range-partitions and
    sorts it by all order columns, so many rows with the same first column spread over tasks too. The
    sorted table is written to the shared folder, which fixes each row's place; a row's rank is its
    place in its partition plus the sizes of the partitions before. The table of sizes has one row per
    sorted partition, so it can be broadcast. This operator runs one job, for the sorted table.
    """
    placed = sorted_table(df, ordering(order), "ranked")
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(PART)
        .agg(F.count("*").alias("_rows"))
        .select(PART, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    return (
        placed.join(F.broadcast(offsets), PART)
        .select(*map(quoted, df.columns), (F.col("_before") + row_in_part() + 1).alias(name))
    )


def best_worst(df: DataFrame, period: str, order: Order, labels=("best_year", "worst_year")) -> DataFrame:
    """First and last period in the given order as (year_type, value). One input row is both.

    Periods that tie are told apart by the period itself. Each side is a top-1, which sorts nothing
    globally, and both sides share one computation of ``df`` when that ends in an aggregation.
    """
    full = [*order, (period, "asc")]

    def top(reverse: bool) -> DataFrame:
        return df.orderBy(*ordering(full, reverse)).limit(1)

    first, last = [
        top(reverse).select(F.lit(label).alias("year_type"), F.col(quoted(period)).alias("value"))
        for label, reverse in zip(labels, (False, True))
    ]
    return first.unionByName(last)
