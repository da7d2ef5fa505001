"""Every registered query against its SQL on the smallest tables, and the plans of some."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from almanac import plans
from tests.conftest import plan

SF_DIR = Path("/root/testdata/sf0.001")
QUERIES = entry_module.observation_queries()
SQL = entry_module.observation_sql()

pytestmark = pytest.mark.skipif(not SF_DIR.is_dir(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def table(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(r[i] for i in order) for r in records]
    return sorted(picked, key=lambda r: tuple((v is not None, v) for v in r))


def test_every_query_has_its_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.items() <= entry_module.queries().items()
    assert SQL.items() <= entry_module.oracle_sql().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, str(SF_DIR))
    result = duck.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    found = table(df.columns, [tuple(r) for r in df.collect()])
    expected = table(columns, result.fetchall())
    assert len(found) > 0
    assert found == expected
    assert not any(isinstance(v, float) and math.isnan(v) for r in found for v in r)


@pytest.mark.parametrize("name", ["ingest_lines", "season_means", "rank_multi", "trend_text_by_season", "best_worst"])
@pytest.mark.parametrize("option", [("spark.sql.ansi.enabled", "false"), ("spark.sql.session.timeZone", "Asia/Tokyo"), ("spark.sql.adaptive.enabled", "false")])
def test_results_do_not_depend_on_session_options(spark, duck, conf, name, option):
    conf(*option)
    test_query_equals_its_sql(spark, duck, name)


def test_entry(spark):
    found = entry_module.entry(spark)
    assert found.columns == ["season", "measure", "change", "years", "patterns"]
    assert found.count() == 16


def test_no_query_has_a_cross_join(spark):
    for name in QUERIES:
        text = QUERIES[name](spark, str(SF_DIR))._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_trend_reads_the_table_once(spark, monkeypatch):
    written, write = [], plans.answers.materialise
    monkeypatch.setattr(plans.answers, "materialise", lambda df, name: (written.append(plan(df)), write(df, name))[1])
    text = plan(QUERIES["trend_text_by_season"](spark, str(SF_DIR)))
    (totals,) = written
    assert totals.count("FileScan") == 1
    assert totals.count("Exchange hashpartitioning(year") == 1
    assert "l_linenumber" not in totals
    assert "l_shipdate" not in text and "SinglePartition" not in text.split("Exchange SinglePartition, ENSURE")[0]


@pytest.mark.parametrize("name", ["deltas", "deltas_by_instant", "trend_text", "trend_text_by_season"])
def test_no_window_holds_all_periods(spark, name):
    """The only windows without keys are over one row per sorted partition."""
    text = plan(QUERIES[name](spark, str(SF_DIR)))
    for line in text.splitlines():
        if "Window [" in line:
            assert "[_part" in line or "lag(_part" in line, line


def test_best_and_worst_share_one_scan(spark):
    text = plan(QUERIES["best_worst"](spark, str(SF_DIR)))
    assert "ReusedExchange" in text
    assert text.count("TakeOrderedAndProject") == 2


def test_means_use_one_aggregation_and_push_key_filters(spark):
    item = entry_module.table(spark, str(SF_DIR), "lineitem")
    keyed = item.selectExpr("l_suppkey station", "year(l_shipdate) year", "l_quantity quantity")
    text = plan(entry_module.op.means(keyed, ["station", "year"], entry_module.MEASURES[:1]))
    assert "IsNotNull(l_suppkey)" in text
    single = plan(QUERIES["period_means"](spark, str(SF_DIR)))
    assert single.count("FileScan") == 1 and "Join" not in single


def test_a_station_has_more_files_the_more_lines_there_are(spark, tmp_path, monkeypatch):
    """No task sorts a whole station; a title is first in each file, so that dropping titles drops no data."""
    spark.range(4200).selectExpr(
        "id div 7 as l_orderkey", "cast(id % 7 + 1 as int) as l_linenumber", "id % 140 + 1 as l_suppkey", "date_add(date'1992-01-01', cast(id % 2400 as int)) as l_shipdate",
        "cast(id % 50 + 1 as double) as l_quantity", "id / 4 as l_extendedprice", "id % 10 / 100 as l_discount", "id % 9 / 100 as l_tax",
        "element_at(array('N', 'A', 'R'), cast(id % 3 + 1 as int)) as l_returnflag", "if(id % 2 = 0, 'O', 'F') as l_linestatus",
    ).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(1, 141).selectExpr("id as s_suppkey", "concat('Supplier#', id) as s_name").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    duck = duckdb.connect()
    for name in ("lineitem", "supplier"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    monkeypatch.setattr(entry_module, "FILE_LINES", 200)
    files = list(Path(entry_module._station_files(spark, str(tmp_path), odd=False)).glob("station=*/*.txt"))
    texts = [file.read_text().splitlines() for file in files]
    assert sum(map(len, texts)) == 4200 + 8 * 140 and all(t[0].startswith("Supplier") for t in texts)
    by_station = [sum(file.parent.name == f"station=S-{k}" for file in files) for k in range(1, 8)]
    assert sum(by_station) == len(files) and min(by_station) > 1
    for name in ("ingest_changed", "ingest_counts", "ingest_files", "ingest_files_legacy"):
        df, result = QUERIES[name](spark, str(tmp_path)), duck.execute(SQL[name])
        found = table(df.columns, [tuple(r) for r in df.collect()])
        assert found == table([c[0] for c in result.description], result.fetchall()), name
