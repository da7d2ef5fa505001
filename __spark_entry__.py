"""

The queries read the ``lineitem`` table as observations: a supplier is the entity, the ship date gives
year and month, and quantity, price, discount and tax are the measures.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import reduce
from importlib.util import find_spec
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from almanac import STATION_REPORT, Measure, ObservationSpec  # noqa: E402
from almanac import operators as op  # noqa: E402
from almanac import plans, sources  # noqa: E402
from almanac.functions import normalise_key, with_season  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"

# Discount and tax in percent, so that their changes do not all round to 0. No discount is no value.
SPEC = ObservationSpec(
    measures=(
        Measure("quantity", "quantity", "pieces", 2),
        Measure("price", "price", "dollars", 2),
        Measure("discount", "discount", "percent", 2),
        Measure("tax", "tax", "percent", 2),
    ),
    types=(
        ("station", "long"),
        ("year", "int"),
        ("month", "int"),
        ("quantity", "double"),
        ("price", "double"),
        ("discount", "double"),
        ("tax", "double"),
    ),
)
MEASURES = SPEC.measures
BEST = (("quantity_avg", "desc"), ("price_avg", "desc"), ("discount_avg", "asc"), ("tax_avg", "asc"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier, year, month, quantity and price are NULL in some rows, and so are all taxes of one year."""

    def but(column: str | Column, *where: str) -> Column:
        return F.when(F.expr(" or ".join(where)), F.lit(None)).otherwise(column)

    year = F.year("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(
        but(F.col("l_suppkey"), "l_orderkey % 97 = 1").alias("station"),
        but(year, "l_orderkey % 89 = 2").alias("year"),
        but(F.month("l_shipdate"), "l_orderkey % 83 = 3").alias("month"),
        but(F.col("l_quantity"), "l_partkey % 13 = 4").alias("quantity"),
        but(F.col("l_extendedprice"), "l_partkey % 11 = 5").alias("price"),
        F.rint(F.nullif("l_discount", F.lit(0.0)) * 100).alias("discount"),
        but(F.rint(F.col("l_tax") * 100), "year(l_shipdate) = 1995").alias("tax"),
    )


# -- ingest ---------------------------------------------------------------------------------------


# What is odd about some orders' lines: a value that is no number, a note at the end, a value too few.
NO_NUMBER, NOTE, TOO_FEW = "l_orderkey % 50 = 7", "l_orderkey % 50 = 8", "l_orderkey % 50 = 9"


def station_lines(
    spark: SparkSession, sf_dir: str, odd: bool = False, key: str = "l_suppkey", about_key: str = "s_suppkey"
) -> DataFrame:
    """Orders' lines rendered as station text, between the other lines such files have."""

    def text(number: Column) -> Column:
        return number.cast("decimal(12,2)").cast("string")

    item = table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    mark = F.when(flag == "R", "*").when(flag == "A", "$").otherwise("")
    detached = F.when(flag == "R", " #").otherwise("")
    tmin = F.when(F.col("l_tax") == 0, "---").otherwise(text(-F.col("l_tax")))
    sun = F.when(F.col("l_discount") == 0, F.concat(F.lit("---"), detached)).otherwise(
        F.concat(text(F.col("l_discount")), mark)
    )
    end = F.lit("")
    if odd:
        sun = F.when(F.expr(NO_NUMBER), "x").when(F.expr(TOO_FEW), "").otherwise(sun)
        end = F.when(F.expr(NOTE), "   moved to a new place").otherwise("")
    line = F.concat(
        F.lit("   "), F.year("l_shipdate"), F.lit("  "), F.month("l_shipdate"),
        F.lit("   "), text(F.col("l_quantity")), F.lit("    "), tmin,
        F.lit("      "), "l_linenumber", F.lit("   "), text(F.col("l_extendedprice")), mark,
        F.lit("    "), sun, F.when(F.col("l_linestatus") == "O", "  Provisional").otherwise(""), end,
    )
    # explode makes the line a column that is rendered once, as if it had been read.
    data = item.select(
        F.concat(F.lit("S-"), key).alias("station"), F.explode(F.array(line)).alias("value")
    )
    others = [
        F.col("s_name"),
        F.lit("Location 100000E 20000N, Lat 12.345 Lon -1.234, 5m amsl"),
        F.lit("Estimated values carry a * behind them."),
        F.lit("Missing values (no reading on most days) are given as  ---."),
        F.lit("Sunshine by the new kind of sensor carries a #"),
        F.lit("   yyyy  mm   tmax    tmin      af    rain     sun"),
        F.lit("              degC    degC    days      mm   hours"),
        F.lit("Site closed"),
    ]
    about = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S-"), F.expr(about_key)).alias("station"), F.explode(F.array(*others)).alias("value")
    )
    return data.unionByName(about)


def ingest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.parse_lines(station_lines(spark, sf_dir, odd=True))


def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sources.rejected_lines(station_lines(spark, sf_dir, odd=True))
    return found.groupBy("station").agg(F.count("*").alias("n"))


def line_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines of each class a station's text has, some of which are data but for their form."""
    lines = station_lines(spark, sf_dir, odd=True)
    half = F.concat(F.year("o_orderdate"), F.lit("-"), F.month("o_orderdate"), F.lit("  1 2 3 4 5"))
    like = table(spark, sf_dir, "orders").select(F.concat(F.lit("S-"), F.col("o_custkey") % 50).alias("station"), half.alias("value"))
    return sources.classified_lines(lines.unionByName(like)).groupBy("station", "class").agg(F.count("*").alias("n"))


def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by class, as counted while the observations were written."""
    root = sources.shared_path(spark, "store")
    plans.ingest(spark, _station_files(spark, sf_dir, odd=True), root, entity_in=FOLDER, rejected=f"{root}-rejected")
    return spark.read.parquet(f"{root}-rejected-counts")


def ingest_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store brought up to date after one of seven stations' files had changed."""
    root = sources.shared_path(spark, "store")
    path = _station_files(spark, sf_dir, odd=False)
    plans.ingest_changed(spark, path, root, entity_in=FOLDER)
    newer = spark.read.text(_station_files(spark, sf_dir, odd=True)).filter("station = 'S-3'").select("value")
    newer.write.mode("overwrite").text(f"{path}/station=S-3")
    plans.ingest_changed(spark, path, root, entity_in=FOLDER)
    return sources.read_observations(spark, root, STATION_REPORT.struct_type(provisional=True))


#: Lines of a station's file or so.
FILE_LINES = 1 << 18


def _station_files(spark: SparkSession, sf_dir: str, odd: bool) -> str:
    """Text in one folder per station, of which there are seven, with a title first in each file.

    A station has more files the more lines there are, so that no task sorts a whole station; a station without titles has one.
    """
    path = sources.shared_path(spark, "stations")
    lines = station_lines(spark, sf_dir, odd, "l_linenumber", "s_suppkey % 7 + 1")
    files = max(1, -(-table(spark, sf_dir, "lineitem").count() // (7 * FILE_LINES)))
    title = F.coalesce(F.col("value").startswith("Supplier"), F.lit(False))
    dealt = F.pmod(F.xxhash64("value"), F.lit(files))
    # Other lines go to files that have a title, which suppliers' names are.
    names = table(spark, sf_dir, "supplier").select(F.expr("'S-' || (s_suppkey % 7 + 1)").alias("station"), F.col("s_name").alias("value"))
    titled = names.filter(title).groupBy("station").agg(F.sort_array(F.collect_set(dealt)).alias("titled"))
    place = F.get("titled", F.pmod(F.xxhash64("value"), F.size("titled")).cast("int"))
    file = F.when(title, dealt).otherwise(F.coalesce(place, F.lit(0)))
    lines = lines.join(F.broadcast(titled), "station", "left").select("station", file.alias("file"), "value")
    lines = lines.repartition(7 * files, "station", "file").sortWithinPartitions("station", "file", title.desc())
    lines.drop("file").write.partitionBy("station").text(path)
    return path


FOLDER = "station=([^/]*)/"


def ingest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to a store by year, and the store read back."""
    root = sources.shared_path(spark, "store")
    source = _station_files(spark, sf_dir, odd=True)
    plans.ingest(spark, source, root, partition_by=["year"], entity_in=FOLDER, rejected=f"{root}-rejected")
    return sources.read_observations(spark, root, STATION_REPORT.struct_type(provisional=True))


def ingest_files_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = sources.shared_path(spark, "store")
    plans.ingest(spark, _station_files(spark, sf_dir, odd=False), root, mode="legacy", entity_in=FOLDER)
    return sources.read_observations(spark, root, STATION_REPORT.struct_type(values_as_strings=True))


def ingest_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.parse_legacy(station_lines(spark, sf_dir))


def text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sources.shared_path(spark, "text")
    station_lines(spark, sf_dir).select("value").write.text(path)
    lines = sources.read_lines(spark, path, drop_titles=False)
    parsed = sources.parse_lines(lines)
    return parsed.drop("station")


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Six stations, however large the table, so that there are six directories.
    item = table(spark, sf_dir, "lineitem")
    station = F.concat("l_returnflag", F.lit("-("), "l_linestatus", F.lit(") x"))
    rows = item.select(
        station.alias("station"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        F.col("l_quantity").alias("tmax"),
        F.col("l_tax").alias("tmin"),
        F.col("l_linenumber").cast("double").alias("af"),
        F.col("l_extendedprice").alias("rain"),
        F.nullif("l_discount", F.lit(0.0)).alias("sun"),
    )
    root = sources.shared_path(spark, "observations")
    sources.write_observations(rows, root)
    stored = sources.read_observations(spark, root, STATION_REPORT.struct_type())
    return stored.withColumn("station_key", normalise_key("station"))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sources.shared_path(spark, "csv")
    with sources.reused(op.means(observations(spark, sf_dir), ["station", "year"], MEASURES)) as means:
        sources.write_csv(means, path)
        return spark.read.schema(means.schema).csv(path)


def ingest_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to sentences: the seasonal trend of the parsed lines."""
    measures = tuple(Measure(m.name, m.label, m.unit, 2) for m in STATION_REPORT.measures)
    parsed = sources.parse_lines(station_lines(spark, sf_dir))
    found = plans.trend(parsed, ObservationSpec(measures), by_season=True)
    return _bigint(found, ["change"])


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All answers written as CSV and read back, one below the other."""
    out = sources.shared_path(spark, "answers")
    plans.write_answers(observations(spark, sf_dir), out, SPEC, ["quantity", "price"], 5, BEST)
    averages = [f"{m}_avg" for m in SPEC.measure_names]
    parts = [
        ("Q4a/OldestStation", "station long, year int, rank long"),
        ("Q4b/MaxQuantityStation", "station long, value double, rank long"),
        ("Q4b/MaxPriceStation", "station long, value double, rank long"),
        ("Q4c/YearlyTrend", "text string"),
        ("Q4c/SeasonalTrend", "text string"),
        ("Q4d/MaxQuantityYear", "station long, year int, value double"),
        ("Q4d/MaxPriceYear", "station long, year int, value double"),
        ("Q4e/MayAverages", "year int, " + ", ".join(f"{a} double" for a in averages)),
        ("Q4e/BestWorstYear", "text string, year int"),
    ]
    frames = []
    for name, schema in parts:
        frame = spark.read.schema(schema).csv(f"{out}/{name}").withColumn("answer", F.lit(name))
        if averages[0] in frame.columns:
            frame = frame.unpivot(["answer", "year"], averages, "text", "value")
        frames.append(frame)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# -- aggregates -----------------------------------------------------------------------------------


def num_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.num_periods(observations(spark, sf_dir), "year")


def period_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.means(observations(spark, sf_dir), ["year"], MEASURES)


def season_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.means(with_season(observations(spark, sf_dir)), ["year", "season"], MEASURES)


def month_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.month_means(observations(spark, sf_dir), 5, MEASURES)


def rolled_up_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    fine = op.period_totals(observations(spark, sf_dir), ["year", "month"], MEASURES)
    return op.as_means(op.roll_up(fine.filter("year is not null"), ["year"], MEASURES), ["year"], MEASURES)


def period_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact totals in units of the last decimal, per supplier and month."""
    totals = op.period_totals(observations(spark, sf_dir), ["station", "year", "month"], MEASURES)
    totals = totals.drop(*[f"{m}_rest" for m in SPEC.measure_names])
    return _bigint(totals, [f"{m}_total" for m in SPEC.measure_names])


def means_of_wide_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of values that no long holds in units, of tiny ones, and with NaN and infinity among them."""
    line, quantity = F.col("l_linenumber"), F.col("l_quantity")
    wide = F.when(line < 5, quantity * 1e17 + quantity).when(line == 5, F.lit(None).cast("double"))
    wide = wide.when((line == 6) & (F.col("l_orderkey") % 2 == 0), float("inf"))
    wide = wide.when((line == 7) & (F.col("l_orderkey") % 2 == 0), float("nan")).otherwise(quantity)
    rows = table(spark, sf_dir, "lineitem").select(line, wide.alias("wide"), (quantity * 2.0**-30).alias("tiny"))
    found = op.means(rows, ["l_linenumber"], [Measure("wide", scale=2), Measure("tiny")])
    kind = F.when(F.isnan("wide_avg"), "nan").when(F.col("wide_avg") == float("inf"), "inf").otherwise("number")
    finite = F.when(F.col("wide_avg") < float("inf"), F.col("wide_avg"))
    return found.select("l_linenumber", kind.alias("kind"), finite.alias("wide_avg"), "tiny_avg")


def means_of_loose_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of values from 2e-12 to 5e13 without declared decimals, per supplier: the same bits in any order."""
    item = table(spark, sf_dir, "lineitem")
    sign = F.when(F.col("l_linenumber") % 2 == 0, -1.0).otherwise(1.0)
    loose = sign * F.col("l_quantity") * F.pow(F.lit(2.0), F.col("l_partkey") % 81 - 40)
    rows = item.select("l_suppkey", F.year("l_shipdate").alias("year"), loose.alias("loose"), F.lit(None).cast("double").alias("never"))
    fine = op.period_totals(rows, ["l_suppkey", "year"], [Measure("loose"), Measure("never")])
    totals = op.roll_up(fine, ["l_suppkey"], [Measure("loose"), Measure("never")])
    return totals.selectExpr("l_suppkey", "loose_total", "loose_n", "loose_total / loose_n as loose_avg", "never_total", "never_n")


def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.first_seen(observations(spark, sf_dir))


def max_by_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.max_by_entity(observations(spark, sf_dir), SPEC.measure_names)


def season_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_season(observations(spark, sf_dir)).groupBy("season").agg(F.count("*").alias("n"))


def join_on_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of different parts of the table, which no single grouping gives."""
    obs = with_season(observations(spark, sf_dir))
    quantity, price, tax = MEASURES[0], MEASURES[1], MEASURES[3]
    frames = [
        op.means(obs.filter("season = 'winter'"), ["station", "year"], [quantity]),
        op.means(obs.filter("season = 'summer'"), ["station", "year"], [price]),
        op.means(obs.filter("discount is not null"), ["station", "year"], [tax]),
    ]
    return op.join_on_keys(frames, ["station", "year"])


# -- rankings and extremes ------------------------------------------------------------------------


def rank_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("station"), F.year("o_orderdate").alias("year")
    )
    return plans.rank_first_seen(orders)


def rank_by_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("station"), F.col("o_totalprice").alias("price")
    )
    return plans.rank_by_max(orders, "price")


def rank_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = op.means(observations(spark, sf_dir), ["station", "year"], MEASURES)
    return op.rank_global(means, [*BEST, ("station", "asc"), ("year", "asc")])


def best_worst(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = plans.month_means(observations(spark, sf_dir), 5, MEASURES)
    return op.best_worst(means, "year", BEST)


def argmax_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.argmax_rows(observations(spark, sf_dir), "price")


def argmax_rows_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a supplier's maximum of any measure, from one pass for all of them."""
    found = op.argmax_rows_each(observations(spark, sf_dir), SPEC.measure_names, ["year", "month"])
    parts = [rows.select("station", "year", "month", F.lit(m).alias("measure"), F.col(f"max_{m}").alias("value")) for m, rows in found.items()]
    return reduce(DataFrame.unionByName, parts)


def argmax_rows_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.argmax_rows_window(observations(spark, sf_dir), "quantity")


# -- trends ---------------------------------------------------------------------------------------


def deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.deltas(period_means(spark, sf_dir), MEASURES)


def _by_instant(spark: SparkSession, sf_dir: str, by: list[str]) -> DataFrame:
    shipped = table(spark, sf_dir, "lineitem").selectExpr("l_returnflag flag", "l_shipdate instant", "l_quantity quantity", "l_extendedprice price")
    return op.deltas(op.means(shipped, [*by, "instant"], MEASURES[:2]), MEASURES[:2], by, "instant")


def deltas_by_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes from each moment of shipping to the next one: as many periods as there are such moments."""
    return _by_instant(spark, sf_dir, [])


def deltas_by_flag_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same within three groups, of which each holds a good part of all periods."""
    return _by_instant(spark, sf_dir, ["flag"])


def deltas_by_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.deltas(season_means(spark, sf_dir), MEASURES, ["season"])


def deltas_by_entity_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["station", "season"]
    means = op.means(with_season(observations(spark, sf_dir)), [*keys, "year"], MEASURES)
    return op.deltas(means, MEASURES, keys, drop_last=True)


def _bigint(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("bigint").alias(c) if c in names else F.col(c) for c in df.columns])


def trend_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bigint(op.trend_totals(deltas(spark, sf_dir), MEASURES), SPEC.measure_names)


def trend_totals_by_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = deltas_by_season(spark, sf_dir)
    return _bigint(op.trend_totals(changes, MEASURES, ["season"]), SPEC.measure_names)


def trend_large_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of more than ten digits."""
    means = period_means(spark, sf_dir).select("year", *[(F.col(f"{m}_avg") * 1e13).alias(f"{m}_avg") for m in SPEC.measure_names])
    totals = op.trend_totals(op.deltas(means, MEASURES), MEASURES)
    return totals.select(*[F.col(m).cast("double").alias(m) for m in SPEC.measure_names])


def trend_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bigint(plans.trend(observations(spark, sf_dir), SPEC), ["change"])


def trend_text_by_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bigint(plans.trend(observations(spark, sf_dir), SPEC, by_season=True), ["change"])


_QUERIES = (
    ingest_lines, rejected_lines, line_classes, ingest_counts, ingest_changed, ingest_files, ingest_files_legacy, ingest_legacy, ingest_trend, text_scan, parquet_roundtrip, csv_roundtrip, answers,
    num_periods, period_means, season_means, month_means, period_totals, rolled_up_means,
    means_of_wide_values, means_of_loose_values, first_seen, max_by_entity, season_of, join_on_keys,
    rank_first_seen, rank_by_max, rank_multi, best_worst, argmax_rows, argmax_rows_each, argmax_rows_window,
    deltas, deltas_by_instant, deltas_by_flag_instant, deltas_by_season, deltas_by_entity_season,
    trend_totals, trend_totals_by_season, trend_large_changes, trend_text, trend_text_by_season,
)


def entry(spark: SparkSession) -> DataFrame:
    """Seasonal trend, the longest chain of operators."""
    return trend_text_by_season(spark, SMOKE_DIR)


def observation_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _QUERIES}


def _corpus() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries on text corpora and their SQL, if that part of the library is there."""
    found, sql = {}, {}
    if find_spec("almanac.llm") is not None:
        from almanac.llm import registry

        found |= registry.QUERIES
        sql |= registry.ORACLE_SQL
        if find_spec("corpus_pipeline") is not None:
            import corpus_pipeline

            found["pipeline"] = corpus_pipeline.run
            if corpus_pipeline.ORACLE_SQL is not None:
                sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**observation_queries(), **_corpus()[0]}


# -- the same in SQL ------------------------------------------------------------------------------

_OBS = """obs AS (
  SELECT station, year, month,
         CASE WHEN month IN (12, 1, 2) THEN 'winter'
              WHEN month IN (3, 4, 5) THEN 'spring'
              WHEN month IN (6, 7, 8) THEN 'summer'
              WHEN month IN (9, 10, 11) THEN 'autumn' END AS season,
         quantity, price, discount, tax
  FROM (SELECT CASE WHEN l_orderkey % 97 = 1 THEN NULL ELSE l_suppkey END AS station,
         CASE WHEN l_orderkey % 89 = 2 THEN NULL ELSE CAST(year(l_shipdate) AS INTEGER) END AS year,
         CASE WHEN l_orderkey % 83 = 3 THEN NULL ELSE CAST(month(l_shipdate) AS INTEGER) END AS month,
         CASE WHEN l_partkey % 13 = 4 THEN NULL ELSE l_quantity END AS quantity,
         CASE WHEN l_partkey % 11 = 5 THEN NULL ELSE l_extendedprice END AS price,
         round(nullif(l_discount, 0) * 100) AS discount,
         CASE WHEN year(l_shipdate) = 1995 THEN NULL ELSE round(l_tax * 100) END AS tax FROM lineitem))"""


def _mean(measure: str) -> str:
    exact = f"CAST(sum(CAST({measure} AS DECIMAL(18,2))) AS DOUBLE)"
    return f"{exact} / nullif(count({measure}), 0) AS {measure}_avg"


def _each(template: str) -> str:
    return ", ".join(template.format(m=m) for m in SPEC.measure_names)


_MEANS = ", ".join(_mean(m) for m in SPEC.measure_names)


def _means(keys: str, where: str = "") -> str:
    # Rows with a NULL key belong to no group.
    known = " AND ".join(f"{key.strip()} IS NOT NULL" for key in keys.split(","))
    return f"SELECT {keys}, {_MEANS} FROM obs WHERE {known} {where} GROUP BY {keys}"


def _deltas(by: str) -> str:
    window = f"OVER (PARTITION BY {by} ORDER BY year)" if by else "OVER (ORDER BY year)"
    keys = f"{by}, year" if by else "year"
    lead = _each("lead({m}_avg) WINDOW - {m}_avg AS {m}").replace("WINDOW", window)
    return f"means AS ({_means(keys)}), changes AS (SELECT {keys}, {lead} FROM means)"


_SUMS = _each("CAST(sum(CAST({m} AS DECIMAL(38,0))) AS BIGINT) AS {m}")
_BEST_ORDER = (
    "quantity_avg DESC NULLS LAST, price_avg DESC NULLS LAST, "
    "discount_avg ASC NULLS FIRST, tax_avg ASC NULLS FIRST"
)
_WORST_ORDER = (
    "quantity_avg ASC NULLS FIRST, price_avg ASC NULLS FIRST, "
    "discount_avg DESC NULLS LAST, tax_avg DESC NULLS LAST"
)


_YEARS = "(SELECT count(*) FROM (SELECT DISTINCT year FROM obs))"


def _text(by: str, measures=MEASURES) -> str:
    """Rows of a trend from the common table ``changes``."""
    group = f"GROUP BY {by}" if by else ""
    ids = f"{by}, " if by else ""
    start = f"'The ' || {by} || ' avg '" if by else "'The avg '"
    parts = []
    for m in measures:
        total = f"CAST(sum(CAST({m.name} AS DECIMAL(38,0))) AS BIGINT)"
        verb = "CASE WHEN change < 0 THEN ' reduced by ' ELSE ' increased by ' END"
        parts.append(
            f"SELECT {ids}'{m.name}' AS measure, change, {_YEARS} AS years, "
            f"{start} || '{m.label}' || {verb} || CAST(abs(change) AS VARCHAR) || "
            f"'{m.unit} over the past ' || CAST({_YEARS} AS VARCHAR) || ' years' AS patterns "
            f"FROM (SELECT {ids}{total} AS change FROM changes {group})"
        )
    return " UNION ALL ".join(parts)


def _argmax(measure: str) -> str:
    return f"""WITH {_OBS}, tops AS (
      SELECT station AS s, max({measure}) AS max_{measure} FROM obs GROUP BY station)
    SELECT station, year, max_{measure} FROM obs JOIN tops
      ON station = s AND {measure} = max_{measure}"""


_YEAR = "CAST(year(l_shipdate) AS INTEGER)"
_MONTH = "CAST(month(l_shipdate) AS INTEGER)"
_ODD = f"""
    l_quantity AS tmax,
    CASE WHEN l_tax <> 0 THEN -l_tax END AS tmin,
    CAST(l_linenumber AS DOUBLE) AS af,
    l_extendedprice AS rain,
    CASE WHEN l_discount <> 0 AND NOT {NO_NUMBER} THEN l_discount END AS sun,
    l_linestatus = 'O' AS provisional FROM lineitem WHERE NOT {TOO_FEW}"""
_MEASURED = """
    l_quantity AS tmax,
    CASE WHEN l_tax <> 0 THEN -l_tax END AS tmin,
    CAST(l_linenumber AS DOUBLE) AS af,
    l_extendedprice AS rain,
    CASE WHEN l_discount <> 0 THEN l_discount END AS sun,
    l_linestatus = 'O' AS provisional"""

# Cleaned the old way: signs are lost, "*" is stripped and "$" is not, a row lives if as many values
# are missing as it has extra words, and then what is right of a missing value moves left.
_LEGACY = f"""
WITH texts AS (
  SELECT 'S' || l_suppkey AS station, {_YEAR} AS year, {_MONTH} AS month,
         l_linestatus = 'O' AS provisional, l_tax = 0 AS no_tmin, l_discount = 0 AS no_sun,
         CAST(CAST(l_quantity AS DECIMAL(12,2)) AS VARCHAR) AS tmax,
         CAST(CAST(l_tax AS DECIMAL(12,2)) AS VARCHAR) AS tmin,
         CAST(l_linenumber AS VARCHAR) AS af,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)
           || CASE WHEN l_returnflag = 'A' THEN '$' ELSE '' END AS rain,
         CAST(CAST(l_discount AS DECIMAL(12,2)) AS VARCHAR)
           || CASE WHEN l_returnflag = 'A' THEN '$' ELSE '' END AS sun
  FROM lineitem)
SELECT station, year, month, tmax,
       CASE WHEN no_tmin THEN af ELSE tmin END AS tmin,
       CASE WHEN no_tmin THEN rain ELSE af END AS af,
       CASE WHEN no_tmin THEN sun ELSE rain END AS rain,
       CASE WHEN provisional THEN 'Provisional' ELSE sun END AS sun
FROM texts
WHERE CAST(no_tmin AS INTEGER) + CAST(no_sun AS INTEGER) = CAST(provisional AS INTEGER)"""


_STATION = [m.name for m in STATION_REPORT.measures]
_SEASON = _OBS[_OBS.index("CASE WHEN") : _OBS.index("END AS season") + len("END AS season")].replace("month", "month(l_shipdate)")
_INGEST_TREND = f"""
WITH obs AS (SELECT {_YEAR} AS year, {_SEASON}, {_MEASURED} FROM lineitem),
means AS (SELECT season, year, {", ".join(_mean(m) for m in _STATION)} FROM obs GROUP BY season, year),
changes AS (SELECT season, {", ".join(f"lead({m}_avg) OVER w - {m}_avg AS {m}" for m in _STATION)}
            FROM means WINDOW w AS (PARTITION BY season ORDER BY year))
{_text("season", STATION_REPORT.measures)}"""


def _answer(name: str, table: str, **columns: str) -> str:
    kinds = {"station": "BIGINT", "year": "INTEGER", "value": "DOUBLE", "rank": "BIGINT", "text": "VARCHAR"}
    picked = [f"CAST({columns.get(c, 'NULL')} AS {kind}) AS {c}" for c, kind in kinds.items()]
    return f"SELECT '{name}' AS answer, {', '.join(picked)} FROM {table}"


def _highest(measure: str) -> str:
    ranked = f"row_number() OVER (ORDER BY max_{measure} DESC NULLS LAST, station NULLS FIRST)"
    tops = f"(SELECT station, max({measure}) AS max_{measure} FROM obs GROUP BY station)"
    name = f"Q4b/Max{measure.capitalize()}Station"
    return _answer(name, tops, station="station", value=f"max_{measure}", rank=ranked)


def _extreme_rows(measure: str) -> str:
    tops = f"(SELECT station AS s, max({measure}) AS top FROM obs GROUP BY station)"
    rows = f"obs JOIN {tops} ON station = s AND {measure} = top"
    return _answer(f"Q4d/Max{measure.capitalize()}Year", rows, station="station", year="year", value="top")


def _best(label: str, order: str) -> str:
    one = f"(SELECT year AS y FROM may ORDER BY {order} LIMIT 1)"
    return _answer("Q4e/BestWorstYear", one, year="y", text=f"'{label}'")


_SEASON_CHANGES = _deltas("season").replace("means AS", "s_means AS").replace("FROM means", "FROM s_means")
_SEASON_CHANGES = _SEASON_CHANGES.replace("changes AS", "s_changes AS")
_ANSWERS = f"""
WITH {_OBS}, {_deltas("")}, {_SEASON_CHANGES}, may AS ({_means("year", "AND month = 5")}),
seen AS (SELECT station, min(year) AS y FROM obs GROUP BY station)
""" + " UNION ALL ".join(
    [
        _answer("Q4a/OldestStation", "seen", station="station", year="y",
                rank="row_number() OVER (ORDER BY y NULLS FIRST, station NULLS FIRST)"),
        _highest("quantity"),
        _highest("price"),
        _answer("Q4c/YearlyTrend", f"({_text('')})", text="patterns"),
        _answer("Q4c/SeasonalTrend", f"({_text('season').replace('FROM changes', 'FROM s_changes')})",
                text="patterns"),
        _extreme_rows("quantity"),
        _extreme_rows("price"),
        *[_answer("Q4e/MayAverages", "may", year="year", text=f"'{m}_avg'", value=f"{m}_avg")
          for m in SPEC.measure_names],
        _best("best_year", f"{_BEST_ORDER}, year ASC"),
        _best("worst_year", f"{_WORST_ORDER}, year DESC"),
    ]
)


def _instants(by: str) -> str:
    keys = f"{by}instant"
    mean = "CAST(sum(CAST(round({c} * 100) AS BIGINT)) AS DOUBLE) / 100 / count({c})"
    window = f"({'PARTITION BY flag ' if by else ''}ORDER BY instant)"
    return f"""WITH means AS (SELECT {keys}, {mean.format(c="l_quantity")} AS q, {mean.format(c="l_extendedprice")} AS p
            FROM (SELECT *, l_returnflag AS flag, l_shipdate AS instant FROM lineitem) GROUP BY {keys})
        SELECT {keys}, lead(q) OVER {window} - q AS quantity, lead(p) OVER {window} - p AS price FROM means"""


def observation_sql() -> dict[str, str]:
    return {
        "ingest_lines": f"""SELECT 'S-' || l_suppkey AS station, {_YEAR} AS year, {_MONTH} AS month,
            {_ODD}""",
        "rejected_lines": f"""SELECT 'S-' || l_suppkey AS station, count(*) AS n FROM lineitem
            WHERE {TOO_FEW} GROUP BY 1""",
        "line_classes": f"""SELECT 'S-' || l_suppkey AS station, CASE WHEN {TOO_FEW} THEN 'rejected' ELSE 'data' END AS class, count(*) AS n
            FROM lineitem GROUP BY ALL
            UNION ALL SELECT 'S-' || s_suppkey, 'preamble', 8 FROM supplier
            UNION ALL SELECT 'S-' || (o_custkey % 50), 'other', count(*) FROM orders GROUP BY ALL""",
        "ingest_counts": f"""SELECT 'data' AS class, count(*) FILTER (NOT {TOO_FEW}) AS n FROM lineitem
            UNION ALL SELECT 'rejected', count(*) FILTER ({TOO_FEW}) FROM lineitem
            UNION ALL SELECT 'other', 0
            UNION ALL SELECT 'preamble', 8 * count(*) FROM supplier""",
        "ingest_changed": f"""SELECT 'S-' || l_linenumber AS station, {_YEAR} AS year, {_MONTH} AS month, {_MEASURED} FROM lineitem WHERE l_linenumber <> 3
            UNION ALL SELECT 'S-' || l_linenumber, {_YEAR}, {_MONTH}, {_ODD} AND l_linenumber = 3""",
        "ingest_files": f"SELECT 'S-' || l_linenumber AS station, {_YEAR} AS year, {_MONTH} AS month, {_ODD}",
        "ingest_files_legacy": _LEGACY.replace("'S' || l_suppkey", "'S' || l_linenumber"),
        "means_of_wide_values": """SELECT l_linenumber, CASE l_linenumber WHEN 6 THEN 'inf' WHEN 7 THEN 'nan' ELSE 'number' END AS kind,
            CASE WHEN l_linenumber < 5 THEN CAST(sum(CAST(CAST((l_quantity * 1e17 + l_quantity) * 100 AS DOUBLE) AS HUGEINT)) AS DOUBLE)
                / 100 / count(*) END AS wide_avg, sum(l_quantity) / 1073741824 / count(*) AS tiny_avg
            FROM lineitem GROUP BY l_linenumber""",
        "ingest_legacy": _LEGACY,
        "ingest_trend": _INGEST_TREND,
        "answers": _ANSWERS,
        "text_scan": f"SELECT {_YEAR} AS year, {_MONTH} AS month, {_MEASURED} FROM lineitem",
        "parquet_roundtrip": f"""SELECT l_returnflag || '-(' || l_linestatus || ') x' AS station,
            {_YEAR} AS year, {_MONTH} AS month, l_quantity AS tmax, l_tax AS tmin,
            CAST(l_linenumber AS DOUBLE) AS af, l_extendedprice AS rain, nullif(l_discount, 0) AS sun,
            l_returnflag || '_' || l_linestatus || '_x' AS station_key FROM lineitem""",
        "csv_roundtrip": f"WITH {_OBS} {_means('station, year')}",
        "num_periods": f"WITH {_OBS} SELECT count(*) AS periods FROM (SELECT DISTINCT year FROM obs)",
        "period_means": f"WITH {_OBS} {_means('year')}",
        "season_means": f"WITH {_OBS} {_means('year, season')}",
        "month_means": f"WITH {_OBS} {_means('year', 'AND month = 5')}",
        "rolled_up_means": f"WITH {_OBS} {_means('year')}",
        "period_totals": f"""WITH {_OBS} SELECT station, year, month,
            {_each('CAST(sum(CAST(round({m} * 100) AS BIGINT)) AS BIGINT) AS {m}_total')},
            {_each('count({m}) AS {m}_n')} FROM obs GROUP BY station, year, month""",
        "first_seen": f"WITH {_OBS} SELECT station, min(year) AS min_year FROM obs GROUP BY station",
        "max_by_entity": f"""WITH {_OBS} SELECT station, {_each('max({m}) AS max_{m}')}
            FROM obs GROUP BY station""",
        "season_of": f"WITH {_OBS} SELECT season, count(*) AS n FROM obs GROUP BY season",
        "join_on_keys": f"""WITH {_OBS},
            a AS (SELECT station, year, {_mean('quantity')} FROM obs WHERE season = 'winter'
                  GROUP BY station, year),
            b AS (SELECT station, year, {_mean('price')} FROM obs WHERE season = 'summer'
                  GROUP BY station, year),
            c AS (SELECT station, year, {_mean('tax')} FROM obs WHERE discount IS NOT NULL
                  GROUP BY station, year)
            SELECT station, year, quantity_avg, price_avg, tax_avg
            FROM a JOIN b USING (station, year) JOIN c USING (station, year)""",
        "rank_first_seen": """SELECT station, min_year,
            row_number() OVER (ORDER BY min_year NULLS FIRST, station NULLS FIRST) AS rank
            FROM (SELECT o_custkey AS station, CAST(min(year(o_orderdate)) AS INTEGER) AS min_year
                  FROM orders GROUP BY o_custkey)""",
        "rank_by_max": """SELECT station, max_price,
            row_number() OVER (ORDER BY max_price DESC NULLS LAST, station NULLS FIRST) AS rank
            FROM (SELECT o_custkey AS station, max(o_totalprice) AS max_price
                  FROM orders GROUP BY o_custkey)""",
        "rank_multi": f"""WITH {_OBS}, means AS ({_means('station, year')})
            SELECT *, row_number() OVER (ORDER BY {_BEST_ORDER}, station, year) AS rank FROM means""",
        "best_worst": f"""WITH {_OBS}, means AS ({_means('year', 'AND month = 5')})
            SELECT * FROM (SELECT 'best_year' AS year_type, year AS value FROM means
                           ORDER BY {_BEST_ORDER}, year ASC LIMIT 1)
            UNION ALL
            SELECT * FROM (SELECT 'worst_year' AS year_type, year AS value FROM means
                           ORDER BY {_WORST_ORDER}, year DESC LIMIT 1)""",
        "argmax_rows": _argmax("price"),
        "argmax_rows_each": f"WITH {_OBS} " + " UNION ALL ".join(
            f"""SELECT station, year, month, '{m}' AS measure, {m} AS value FROM obs
                JOIN (SELECT station AS s, max({m}) AS top FROM obs GROUP BY station) ON station = s AND {m} = top"""
            for m in SPEC.measure_names
        ),
        "argmax_rows_window": _argmax("quantity"),
        "deltas_by_instant": _instants(""),
        "deltas_by_flag_instant": _instants("flag, "),
        "means_of_loose_values": """SELECT l_suppkey, total AS loose_total, n AS loose_n, total / n AS loose_avg,
            CAST(NULL AS DOUBLE) AS never_total, CAST(0 AS BIGINT) AS never_n
            FROM (SELECT l_suppkey, count(*) AS n, CAST(CAST(sum(CAST(CASE WHEN l_linenumber % 2 = 0 THEN -1 ELSE 1 END
                * l_quantity * power(2, l_partkey % 81) AS HUGEINT)) AS VARCHAR) AS DOUBLE) / power(2, 40) AS total
              FROM lineitem GROUP BY l_suppkey)""",
        "deltas": f"WITH {_OBS}, {_deltas('')} SELECT * FROM changes",
        "deltas_by_season": f"WITH {_OBS}, {_deltas('season')} SELECT * FROM changes",
        "deltas_by_entity_season": f"""WITH {_OBS}, means AS ({_means('station, season, year')}),
            leads AS (SELECT *, {_each('lead({m}_avg) OVER w AS next_{m}')} FROM means
                      WINDOW w AS (PARTITION BY station, season ORDER BY year))
            SELECT station, season, year, {_each('next_{m} - {m}_avg AS {m}')} FROM leads
            WHERE {_each('next_{m} IS NOT NULL').replace(',', ' AND')}""",
        "trend_large_changes": f"""WITH {_OBS}, {_deltas("").replace("lead(", "1e13 * lead(").replace(" - ", " - 1e13 * ")}
            SELECT {_SUMS.replace("AS BIGINT", "AS DOUBLE")} FROM changes""",
        "trend_totals": f"WITH {_OBS}, {_deltas('')} SELECT {_SUMS} FROM changes",
        "trend_totals_by_season": f"""WITH {_OBS}, {_deltas('season')}
            SELECT season, {_SUMS} FROM changes GROUP BY season""",
        "trend_text": f"WITH {_OBS}, {_deltas('')} {_text('')}",
        "trend_text_by_season": f"WITH {_OBS}, {_deltas('season')} {_text('season')}",
    }


def oracle_sql() -> dict[str, str]:
    return {**observation_sql(), **_corpus()[1]}
