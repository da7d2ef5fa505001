"""The questions asked of an observation table, composed from the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions.columns import all_present, quoted, with_season
from almanac.operators.aggregate import (
    as_means,
    first_seen,
    max_by_entity,
    means,
    num_periods,
    period_totals,
    roll_up,
)
from almanac.operators.extremes import argmax_rows_each
from almanac.operators.rank import best_worst, rank_global
from almanac.operators.trend import deltas, trend_text, trend_totals
from almanac.sources.shared import materialise, scratch
from almanac.sources.store import read_observations, write_csv, write_observations
from almanac.sources.text import (
    CLASSES,
    FILE_NAME,
    OTHER,
    REJECTED,
    classified_lines,
    line_counts,
    parse_classified,
    parse_legacy,
    read_lines,
    unread_lines,
)
from almanac.spec import STATION_REPORT, Measure, ObservationSpec

# What makes a good month, most important first, for station reports.
BEST_MONTH = (
    ("sun_avg", "desc"),
    ("tmax_avg", "desc"),
    ("tmin_avg", "desc"),
    ("rain_avg", "asc"),
    ("af_avg", "asc"),
)
MAY = 5

# Where a run keeps its store and each answer; {} stands for a capitalised measure.
STORE = "PreProcessedData"
REJECTED_LINES = "RejectedLines"
ANSWERS = "Answers"
OLDEST = "Q4a/OldestStation"
HIGHEST = "Q4b/Max{}Station"
YEARLY_TREND = "Q4c/YearlyTrend"
SEASONAL_TREND = "Q4c/SeasonalTrend"
EXTREME_ROWS = "Q4d/Max{}Year"
MONTH_MEANS = "Q4e/MayAverages"
BEST_AND_WORST = "Q4e/BestWorstYear"


def ingest(
    spark: SparkSession,
    source: str,
    root: str,
    spec: ObservationSpec = STATION_REPORT,
    mode: str = "strict",
    partition_by: Sequence[str] | None = None,
    entity_in: str = FILE_NAME,
    rejected: str | None = None,
) -> None:
    """Clean all files of a directory and store them by entity, or by the columns ``partition_by``.

    One directory per entity suits some hundred entities; millions belong into partitions by year. A file
    holds one entity, and large files are read by several tasks, so in strict mode and by entity, rows
    are written where they are read, without a shuffle. Otherwise rows of a partition lie in many
    files, or titles are dropped, which may shuffle lines; then they are gathered before they are written.

    ``rejected`` is where strict mode writes the lines that start as data and are none, or may have been meant as
    such, with their class, as Parquet; and in ``<rejected>-counts`` (class, n) how many lines there were of each class, which
    add up to the lines read. The counts come from the pass that writes the observations. If no line was left unread,
    the text is not read again.
    """
    if mode not in ("strict", "legacy"):
        raise ValueError(f"mode must be strict or legacy, not {mode!r}")
    legacy = mode == "legacy"
    keys = list(partition_by or [spec.entity])
    lines = read_lines(spark, source, spec.entity, drop_titles=legacy, entity_in=entity_in)
    if legacy:
        write_observations(parse_legacy(lines, spec), root, keys)
        return
    classified, counts = line_counts(classified_lines(lines, spec))
    write_observations(parse_classified(classified, spec), root, keys, gather=keys != [spec.entity])
    if rejected:
        seen = counts.get
        if sum(seen[c] for c in CLASSES) != seen["read"]:
            raise RuntimeError(f"lines of no class: {seen}")
        spark.createDataFrame([(c, seen[c]) for c in CLASSES], "class string, n bigint").coalesce(1).write.mode("overwrite").parquet(f"{rejected}-counts")
        unread = unread_lines(lines, spec)
        if not seen[REJECTED] + seen[OTHER]:
            unread = spark.createDataFrame([], unread.schema)
        unread.write.mode("overwrite").parquet(rejected)


def rank_first_seen(df: DataFrame, entity: str = "station", period: str = "year") -> DataFrame:
    """Entities by their first period, as (entity, min_<period>, rank)."""
    first = first_seen(df, entity, period)
    return rank_global(first, [(f"min_{period}", "asc"), (entity, "asc")])


def rank_by_max(df: DataFrame, measure: str, entity: str = "station") -> DataFrame:
    """Entities by the maximum of a measure, highest first, as (entity, max_<measure>, rank)."""
    highest = max_by_entity(df, [measure], entity)
    return rank_global(highest, [(f"max_{measure}", "desc"), (entity, "asc")])


def month_means(
    df: DataFrame, month: int, measures: Sequence[Measure], month_col: str = "month", period: str = "year"
) -> DataFrame:
    """Means of one calendar month per year."""
    return means(df.filter(F.col(month_col) == month), [period], measures)


def trend(df: DataFrame, spec: ObservationSpec, by_season: bool = False) -> DataFrame:
    """How each measure's mean changed over the years, in all or per season.

    Columns (season?, measure, change, years, patterns). One scan and one shuffle of ``df``, which
    leaves one row per year (and season), written to the shared folder; everything after that is as small as the calendar.
    """
    if by_season:
        df = with_season(df, spec.month, spec.seasons)
    keys = [spec.year, "season"] if by_season else [spec.year]
    return trend_of_totals(period_totals(df, keys, spec.measures), spec, by_season)


def trend_of_totals(totals: DataFrame, spec: ObservationSpec, by_season: bool = False) -> DataFrame:
    """``trend`` from totals per year (and season), rows with NULL keys included."""
    by = ["season"] if by_season else []
    keys = [spec.year, *by]
    # One row per year and season, of which the number of years is counted as well.
    totals = materialise(totals, "yearly")
    # The number of years is one for all seasons, and counts NULL as a year.
    years = num_periods(totals, spec.year).first()["periods"]
    averages = as_means(totals.filter(all_present(keys)), keys, spec.measures)
    changes = deltas(averages, spec.measures, by, spec.year)
    summed = trend_totals(changes, spec.measures, by)
    return trend_text(summed, spec.measures, years=years, by="season" if by_season else None)


def write_answers(
    observations: DataFrame,
    out: str,
    spec: ObservationSpec = STATION_REPORT,
    extremes: Sequence[str] = ("rain", "sun"),
    month: int = MAY,
    order: Sequence[tuple[str, str]] = BEST_MONTH,
) -> None:
    """All answers as CSV directories below ``out``.

    The observations are read three times, however many measures are in ``extremes``: for totals per year and month, for
    extremes per entity, and for the rows that have an extreme. All of these lie in the shared folder meanwhile and
    are deleted at the end.
    """
    with scratch(observations.sparkSession):
        _write_answers(observations, out, spec, extremes, month, order)


def _write_answers(
    observations: DataFrame,
    out: str,
    spec: ObservationSpec,
    extremes: Sequence[str],
    month: int,
    order: Sequence[tuple[str, str]],
) -> None:
    entity, year = spec.entity, spec.year
    totals = materialise(period_totals(observations, [year, spec.month], spec.measures), "totals")
    entities = materialise(
        observations.groupBy(quoted(entity)).agg(
            F.min(quoted(year)).alias("min_year"), *[F.max(quoted(m)).alias(f"max_{m}") for m in extremes]
        ),
        "entities",
    )

    oldest = rank_global(entities.select(entity, "min_year"), [("min_year", "asc"), (entity, "asc")])
    write_csv(oldest, f"{out}/{OLDEST}")

    for m in extremes:
        highest = entities.select(entity, f"max_{m}")
        ranked = rank_global(highest, [(f"max_{m}", "desc"), (entity, "asc")])
        write_csv(ranked, f"{out}/{HIGHEST.format(m.capitalize())}")

    yearly = trend_of_totals(roll_up(totals, [year], spec.measures), spec)
    write_csv(yearly.select("patterns"), f"{out}/{YEARLY_TREND}")
    seasons = with_season(totals, spec.month, spec.seasons)
    seasonal = trend_of_totals(roll_up(seasons, [year, "season"], spec.measures), spec, by_season=True)
    write_csv(seasonal.select("patterns"), f"{out}/{SEASONAL_TREND}")

    for m, rows in argmax_rows_each(observations, extremes, [year], entity, maxima=entities).items():
        write_csv(rows, f"{out}/{EXTREME_ROWS.format(m.capitalize())}")

    of_month = totals.filter(F.col(spec.month) == month).filter(all_present([year]))
    averages = as_means(roll_up(of_month, [year], spec.measures), [year], spec.measures)
    write_csv(averages, f"{out}/{MONTH_MEANS}")
    write_csv(best_worst(averages, year, order), f"{out}/{BEST_AND_WORST}")


def run_job(spark: SparkSession, settings: Mapping, mode: str = "strict") -> None:
    """A whole run from a job's settings: text in ``input_path`` to a store and all answers below
    ``output_path``, with the settings under ``config`` or not. Measures of station reports keep their
    wording, units and decimals; others are averaged as doubles. ``partitionBy`` lists the columns that the
    store is partitioned by, if not by entity.
    """
    settings = settings.get("config", settings)
    labels = {m.name: (m.label, m.unit) for m in STATION_REPORT.measures}
    spec = ObservationSpec.from_config(settings, labels, {m.name: m.scale for m in STATION_REPORT.measures})
    out = settings["output_path"].rstrip("/")
    with scratch(spark):
        keys = settings.get("partitionBy")
        ingest(spark, settings["input_path"], f"{out}/{STORE}", spec, mode, keys, rejected=f"{out}/{REJECTED_LINES}")
    schema = spec.struct_type(values_as_strings=mode == "legacy")
    write_answers(read_observations(spark, f"{out}/{STORE}", schema), f"{out}/{ANSWERS}", spec)
