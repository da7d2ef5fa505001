"""Column expressions shared by the operators. All of them run inside generated JVM code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.spec import SEASONS, Measure


# The wording of a trend, over all observations and within one group.
TREND = "The avg {label} {direction} by {size}{unit} over the past {years} years"
GROUP_TREND = "The {group} avg {label} {direction} by {size}{unit} over the past {years} years"
REDUCED, INCREASED = "reduced", "increased"


def quoted(name: str) -> str:
    """A column name for use in SQL expressions."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A string for use in SQL expressions."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def season_of(month: str, seasons=SEASONS) -> Column:
    """Season name of a month column; NULL for NULL and for months in no season."""
    cases = [
        f"when {quoted(month)} in ({', '.join(map(str, months))}) then {literal(name)}"
        for name, months in seasons
    ]
    return F.expr(f"case {' '.join(cases)} end")


def with_season(df: DataFrame, month: str = "month", seasons=SEASONS, name: str = "season") -> DataFrame:
    return df.withColumn(name, season_of(month, seasons))


def cast_columns(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Cast (name, type name) pairs in one projection; text that does not parse becomes NULL.

    Columns that are not named stay as they are.
    """
    kinds = dict(columns)
    return df.select(
        *[
            F.col(quoted(name)).try_cast("bigint" if kinds[name] == "long" else kinds[name]).alias(name)
            if name in kinds
            else F.col(quoted(name))
            for name in df.columns
        ]
    )


def normalise_key(key: str) -> Column:
    """Directory-safe form of an entity key: ``-`` and blanks become ``_``, parentheses go."""
    return F.regexp_replace(F.translate(key, "-()", "_"), r"\s+", "_")


def all_present(names: Sequence[str]) -> Column:
    """All named columns are not NULL, in the form that reaches the Parquet scan."""
    return F.expr(" and ".join(f"{quoted(name)} is not null" for name in names))


def by_name(name: str, texts: Mapping[str, str]) -> str:
    """SQL for the text that belongs to the name in a column."""
    pairs = [literal(part) for pair in texts.items() for part in pair]
    return f"map({', '.join(pairs)})[{quoted(name)}]"


def sentence(template: str, **parts: str) -> Column:
    """A template with its fields filled by SQL expressions; NULL if one of them is."""
    pieces = []
    for text, field, _, _ in Formatter().parse(template):
        pieces += [literal(text)] if text else []
        pieces += [f"cast({parts[field]} as string)"] if field else []
    return F.expr(f"concat({', '.join(pieces)})")


def trend_sentence(measures: Sequence[Measure], group: str | None = None) -> Column:
    """Words for the columns ``measure``, ``change`` and ``years``. No change counts as an increase."""
    return sentence(
        GROUP_TREND if group else TREND,
        group=quoted(group or ""),
        label=by_name("measure", {m.name: m.label for m in measures}),
        direction=f"if(change < 0, {literal(REDUCED)}, {literal(INCREASED)})",
        size="abs(change)",
        unit=by_name("measure", {m.name: m.unit for m in measures}),
        years="years",
    )
