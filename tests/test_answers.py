"""Text files to answers, against a plain computation over the same values."""

import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest

from almanac import SEASONS, STATION_REPORT, ObservationSpec
from almanac.plans import ingest, month_means, rank_by_max, rank_first_seen, run_job, write_answers
from almanac.sources import parse_lines, read_lines, read_observations
from tests.conftest import plan, rows

NAMES = STATION_REPORT.measure_names
HEADER = "{}\nLocation 1E 2N\n   yyyy  mm   tmax    tmin      af    rain     sun\n              degC    degC    days      mm   hours\n"


@pytest.fixture(scope="module")
def stations():
    """Values in tenths; a third of all rows belong to one station."""
    rng = random.Random(42)
    made = []
    for station, years in (("Hot", range(1930, 1990)), ("Ash Vale", range(1961, 1990)), ("B-4", range(1955, 1985)), ("Cold", range(1980, 1992))):
        for year in years:
            for month in range(1, 13):
                values = [rng.choice([None, rng.randint(-99, 3000)]) if rng.random() < 0.2 else rng.randint(-99, 400) for _ in NAMES]
                made.append((station, year, month, *values))
    return made


@pytest.fixture(scope="module")
def folder(stations, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stations")
    by_station = defaultdict(list)
    for station, year, month, *values in stations:
        texts = ["---" if v is None else f"{v / 10:.1f}" for v in values]
        by_station[station].append(f"   {year}  {month:2d}   " + "   ".join(texts))
    for station, lines in by_station.items():
        (folder / f"{station}.txt").write_text(HEADER.format(station) + "\n".join(lines) + "\nSite closed\n")
    return str(folder)


@pytest.fixture(scope="module")
def stored(spark, folder, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("store") / "obs")
    ingest(spark, folder, root)
    return read_observations(spark, root, STATION_REPORT.struct_type())


@pytest.fixture(scope="module")
def answers(stored, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("answers"))
    write_answers(stored, out)
    return out


def exact_means(stations, key):
    groups = defaultdict(list)
    for row in stations:
        groups[key(row)].append(row[3:])
    means = {}
    for k, values in groups.items():
        columns = [[v for v in column if v is not None] for column in zip(*values)]
        means[k] = [float(Fraction(sum(c))) / 10 / len(c) if c else None for c in columns]
    return means


def totals(series):
    """Rounded changes of each measure, summed, over means by year."""
    sums = []
    for i in range(len(NAMES)):
        changes = [
            series[b][i] - series[a][i]
            for a, b in zip(sorted(series), sorted(series)[1:])
            if series[a][i] is not None and series[b][i] is not None
        ]
        sums.append(int(sum(Decimal(repr(c)).quantize(Decimal(1), ROUND_HALF_UP) for c in changes)))
    return sums


def season(month):
    return next(name for name, months in SEASONS if month in months)


def sentences(sums, years, group=""):
    verb = ["reduced" if s < 0 else "increased" for s in sums]
    return [
        f"The {group}avg {m.label} {v} by {abs(s)}{m.unit} over the past {years} years"
        for m, v, s in zip(STATION_REPORT.measures, verb, sums)
    ]


def test_all_rows_are_stored(stored, stations):
    expected = [(s, y, m, *[None if v is None else v / 10 for v in values]) for s, y, m, *values in stations]
    assert rows(stored) == sorted(expected, key=lambda r: tuple((v is not None, v) for v in r))


def test_provisional_flag_is_stored(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "X.txt").write_text("X\n2018 6 1 2 3 4 5 Provisional\n2018 5 1 2 3 4 5\n")
    ingest(spark, str(tmp_path / "in"), str(tmp_path / "store"))
    schema = STATION_REPORT.struct_type(provisional=True)
    stored = read_observations(spark, str(tmp_path / "store"), schema)
    assert rows(stored.select("month", "provisional")) == [(5, False), (6, True)]


def test_oldest_stations(spark, answers, stored):
    found = rows(spark.read.schema("s string, y int, r long").csv(f"{answers}/Q4a/OldestStation"))
    assert found == [("Ash Vale", 1961, 3), ("B-4", 1955, 2), ("Cold", 1980, 4), ("Hot", 1930, 1)]
    assert rows(rank_first_seen(stored)) == found


@pytest.mark.parametrize("measure", ["rain", "sun"])
def test_extremes(spark, answers, stored, stations, measure):
    i = 3 + NAMES.index(measure)
    top = {s: max(r[i] for r in stations if r[0] == s and r[i] is not None) for s in {r[0] for r in stations}}
    order = sorted(top, key=lambda s: (-top[s], s))
    ranked = spark.read.schema("s string, v double, r long").csv(f"{answers}/Q4b/Max{measure.capitalize()}Station")
    assert rows(ranked) == sorted((s, top[s] / 10, n + 1) for n, s in enumerate(order))
    assert rows(rank_by_max(stored, measure)) == rows(ranked)
    at_top = spark.read.schema("s string, y int, v double").csv(f"{answers}/Q4d/Max{measure.capitalize()}Year")
    assert rows(at_top) == sorted((r[0], r[1], r[i] / 10) for r in stations if r[i] == top[r[0]])


def test_trends(spark, answers, stations):
    years = len({r[1] for r in stations})
    yearly = sentences(totals(exact_means(stations, lambda r: r[1])), years)
    assert rows(spark.read.text(f"{answers}/Q4c/YearlyTrend")) == sorted((t,) for t in yearly)
    by_season = exact_means(stations, lambda r: (season(r[2]), r[1]))
    expected = []
    for name, _ in SEASONS:
        series = {y: m for (s, y), m in by_season.items() if s == name}
        expected += sentences(totals(series), years, f"{name} ")
    assert rows(spark.read.text(f"{answers}/Q4c/SeasonalTrend")) == sorted((t,) for t in expected)


def test_may(spark, answers, stored, stations):
    may = exact_means([r for r in stations if r[2] == 5], lambda r: r[1])
    schema = "year int, " + ", ".join(f"{n}_avg double" for n in NAMES)
    means = spark.read.schema(schema).csv(f"{answers}/Q4e/MayAverages")
    key = lambda r: tuple((v is not None, v) for v in r)
    assert rows(means) == sorted([(y, *m) for y, m in may.items()], key=key)
    assert rows(month_means(stored, 5, STATION_REPORT.measures)) == rows(means)

    def goodness(year):
        tmax, tmin, af, rain, sun = may[year]
        high = [(v is not None, v or 0) for v in (sun, tmax, tmin)]
        low = [(v is None, -(v or 0)) for v in (rain, af)]
        return (*high, *low, -year)

    best, worst = max(may, key=goodness), min(may, key=goodness)
    found = spark.read.schema("t string, y int").csv(f"{answers}/Q4e/BestWorstYear")
    assert rows(found) == [("best_year", best), ("worst_year", worst)]


def test_legacy_cleaning_ends_in_the_same_answers_layout(spark, folder, tmp_path):
    root, out = str(tmp_path / "obs"), str(tmp_path / "answers")
    ingest(spark, folder, root, mode="legacy")
    kept = read_observations(spark, root, STATION_REPORT.struct_type(values_as_strings=True))
    write_answers(kept, out)
    ranked = spark.read.schema("s string, v string, r long").csv(f"{out}/Q4b/MaxRainStation")
    highest = {s: v for s, v, _ in rows(ranked)}
    assert set(highest) == {"Hot", "Ash", "B4", "Cold"}
    assert highest["Hot"].startswith("9")  # the largest as text
    assert spark.read.text(f"{out}/Q4c/SeasonalTrend").count() == 20


@pytest.mark.parametrize("mode", ["strict", "legacy"])
def test_run_from_settings(spark, folder, answers, tmp_path, mode):
    settings = {
        "input_path": folder,
        "output_path": f"{tmp_path}/",
        "schema": [{"cname": c, "ctype": t} for c, t in STATION_REPORT.columns],
        "measuresCols": NAMES,
    }
    run_job(spark, settings, mode)
    if mode == "legacy":
        ranked = spark.read.schema("s string, y int, r long").csv(f"{tmp_path}/Answers/Q4a/OldestStation")
        assert {r.s for r in ranked.collect()} == {"Hot", "Ash", "B4", "Cold"}
        return
    for answer in ("Q4a/OldestStation", "Q4b/MaxRainStation", "Q4c/SeasonalTrend", "Q4d/MaxSunYear", "Q4e/MayAverages"):
        assert rows(spark.read.text(f"{tmp_path}/Answers/{answer}")) == rows(spark.read.text(f"{answers}/{answer}"))


def test_other_settings(spark, tmp_path):
    """Settings under ``config``, a store by year, values of many decimals, and lines that are no data."""
    (tmp_path / "in").mkdir()
    for k in range(5):
        (tmp_path / "in" / f"S{k}.txt").write_text("title\n1990 1 0.00001 9\n1991 2 0.00003 9\n1991 3 1\n")
    schema = [("station", "string"), ("year", "int"), ("month", "int"), ("flow", "double"), ("tmax", "double")]
    settings = {"input_path": f"{tmp_path}/in", "output_path": f"{tmp_path}/out", "measuresCols": ["flow", "tmax"], "partitionBy": ["year"]}
    settings["schema"] = [{"cname": c, "ctype": t} for c, t in schema]
    spec = ObservationSpec.from_config({"config": settings}, scales={"tmax": 4})
    assert [m.scale for m in spec.measures] == [None, 4]
    ingest(spark, settings["input_path"], f"{tmp_path}/store", spec, partition_by=["year"], rejected=f"{tmp_path}/bad")
    found = read_observations(spark, f"{tmp_path}/store", spec.struct_type())
    assert found.count() == 10 and found.filter("year = 1990").groupBy().avg("flow").first()[0] == pytest.approx(0.00001)
    assert {d.name for d in (tmp_path / "store").glob("year=*")} == {"year=1990", "year=1991"}
    assert len(list((tmp_path / "store").glob("*/part-*"))) == 2
    assert rows(spark.read.parquet(f"{tmp_path}/bad").select("value").distinct()) == [("1991 3 1",)]


def test_the_shared_folder_is_left_empty(spark, folder, stored, tmp_path, monkeypatch):
    from almanac.sources import shared

    monkeypatch.setattr(shared, "shared_folder", lambda spark: f"{tmp_path}/shared")
    (tmp_path / "shared" / "almanac").mkdir(parents=True)
    (tmp_path / "shared" / "almanac" / "other").write_text("of someone else")
    write_answers(stored, f"{tmp_path}/answers")
    ingest(spark, folder, f"{tmp_path}/store", mode="legacy")
    left = [p.name for p in (tmp_path / "shared" / "almanac").iterdir()]
    assert [n for n in left if not n.startswith("titles")] == ["other"]
    with shared.scratch(spark) as paths:
        df = shared.materialise(spark.range(5), "five")
        assert df.count() == 5 and len(paths) == 1
    assert not (tmp_path / "shared" / "almanac" / paths[0].rsplit("/", 1)[1]).exists()


def test_strict_ingest_does_not_shuffle(spark, folder):
    assert "Exchange" not in plan(parse_lines(read_lines(spark, folder)))


def test_unknown_mode_is_refused(spark, folder, tmp_path):
    with pytest.raises(ValueError, match="lenient"):
        ingest(spark, folder, str(tmp_path / "x"), mode="lenient")
