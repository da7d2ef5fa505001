"""Rows at which an entity's measure reaches its maximum, with all ties and duplicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.functions.columns import quoted
from almanac.operators.aggregate import max_by_entity
from almanac.sources.shared import fits_broadcast, materialise

_COPIES = 10_000
#: Pieces that the rows of one (entity, value) are cut into before they are joined.
_PIECES = 16


def _at_top(df: DataFrame, maxima: DataFrame, entity: str, measures: Sequence[str], keep: Sequence[str], pieces: int = _PIECES) -> DataFrame:
    """(keep…, entity, measures…, max_<measure>…) of the rows of ``df`` at their entity's maximum of some measure.

    Every row is in one of ``pieces`` by its number, and each maximum is there for every piece, so that
    not even an entity with very many rows of one value is one task's, with or without adaptive execution.
    """
    tops = [f"max_{m}" for m in measures]
    piece = F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))) if pieces > 1 else F.lit(0)
    some = reduce(or_, [F.col(quoted(t)).isNotNull() for t in tops])
    wanted = maxima.filter(some).select(
        F.col(quoted(entity)).alias("_entity"), *map(quoted, tops), piece.alias("_piece")
    )
    columns = list(dict.fromkeys([entity, *keep, *measures]))
    of = F.pmod(F.monotonically_increasing_id(), F.lit(pieces)).cast("int") if pieces > 1 else F.lit(0)
    rows = df.select(*map(quoted, columns)).withColumn("_of", of)
    same = (F.col(quoted(entity)) == F.col("_entity")) & (F.col("_of") == F.col("_piece"))
    if len(measures) == 1:
        return rows.join(wanted, same & (F.col(quoted(measures[0])) == F.col(quoted(tops[0]))))
    reached = reduce(or_, [F.col(quoted(m)) == F.col(quoted(t)) for m, t in zip(measures, tops)])
    return rows.join(wanted, same).filter(reached)


def _pieces(maxima: DataFrame) -> int:
    """Pieces are for a join that shuffles the rows; maxima that are broadcast go to them whole."""
    return 1 if fits_broadcast(maxima) else _PIECES


def argmax_rows(
    df: DataFrame,
    measure: str,
    keep: Sequence[str] = ("year",),
    entity: str = "station",
    maxima: DataFrame | None = None,
) -> DataFrame:
    """(entity, keep…, max_<measure>) of every row that has its entity's maximum.

    The maxima are written to the shared folder first, so that Catalyst knows their size: below the
    broadcast threshold the rows are filtered where they are read and nothing else is shuffled. Above
    it, all rows are shuffled by (entity, value, piece). Pass ``maxima`` (from ``max_by_entity``, written) to share them.
    """
    if maxima is None:
        maxima = materialise(max_by_entity(df, [measure], entity), "maxima")
    found = _at_top(df, maxima, entity, [measure], keep, _pieces(maxima))
    return found.select(*map(quoted, [entity, *keep, f"max_{measure}"]))


def argmax_rows_each(
    df: DataFrame,
    measures: Sequence[str],
    keep: Sequence[str] = ("year",),
    entity: str = "station",
    maxima: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """``argmax_rows`` of several measures, by measure, from one pass over ``df`` besides that for the maxima.

    The rows that have their entity's maximum of any measure are written to the shared folder once, and each
    measure's rows are taken from there. Rows meet all maxima of their entity in one join by (entity, piece).
    """
    if maxima is None:
        maxima = materialise(max_by_entity(df, measures, entity), "maxima")
    found = materialise(_at_top(df, maxima, entity, measures, keep, _pieces(maxima)), "extremes")
    return {
        m: found.filter(F.col(quoted(m)) == F.col(quoted(f"max_{m}"))).select(*map(quoted, [entity, *keep, f"max_{m}"]))
        for m in measures
    }


def argmax_rows_window(
    df: DataFrame, measure: str, keep: Sequence[str] = ("year",), entity: str = "station"
) -> DataFrame:
    """The same rows by counts, without a job of its own.

    Equal (entity, keep…, value) rows are counted first, on the map side, and written out again at the
    end. Of the counted rows the maxima are taken, again on the map side, and joined back by piece. Suits
    measures with few distinct values and ``keep`` columns that are periods; no window holds an entity.
    """
    top = f"max_{measure}"
    counted = (
        df.filter(F.col(quoted(entity)).isNotNull() & F.col(quoted(measure)).isNotNull())
        .groupBy(*map(quoted, dict.fromkeys([entity, *keep, measure])))
        .agg(F.count("*").alias("_n"))
    )
    best = _at_top(counted, max_by_entity(counted, [measure], entity), entity, [measure], [*keep, "_n"])
    # A count can be large: cut it into batches, spread those, and write out each batch where it is.
    batch = F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / _COPIES)))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    batches = best.select("*", batch.alias("_batch")).repartition(tasks)
    size = F.least(F.lit(_COPIES), F.col("_n") - F.col("_batch") * _COPIES)
    copies = batches.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), size)).alias("_copy"))
    return copies.select(*map(quoted, [entity, *keep, top]))
