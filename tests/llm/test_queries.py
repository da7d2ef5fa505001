"""Every query on the smallest tables: against its SQL where there is one, else its shape."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from almanac.llm import registry

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.is_dir(), reason="needs the driver's tables")

COLUMNS = {
    "op1_mix_sources": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op2_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op5_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op10_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op11_marked_words": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op12_word_runs": {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "exponent_milli": "bigint", "runs_sha256": "string"},
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def ordered(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in records), key=lambda r: tuple((v is not None, v) for v in r))


@pytest.mark.parametrize("name", list(registry.ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, str(SF_DIR))
    result = duck.execute(registry.ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    found = ordered(df.columns, [tuple(r) for r in df.collect()])
    assert found == ordered(columns, result.fetchall())
    assert found


@pytest.mark.parametrize("name", list(COLUMNS))
def test_query_returns_every_document_once(spark, duck, name):
    df = registry.QUERIES[name](spark, str(SF_DIR))
    types = dict(df.dtypes)
    assert COLUMNS[name].items() <= types.items()
    ids = sorted(r.doc_id for r in df.select("doc_id").collect())
    assert ids == sorted(r[0] for r in duck.execute("SELECT doc_id FROM documents").fetchall())
    if "score" in types:
        assert all(0 <= r.score <= 1 for r in df.select("score").collect())


def test_all_of_them_and_the_pipeline_are_registered():
    names = entry_module.queries()
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()}
    assert "pipeline" in names


@pytest.mark.parametrize("name", ["op3_judge_urls", "op6_decontaminate"])
def test_native_queries_run_no_python(spark, name):
    text = registry.QUERIES[name](spark, str(SF_DIR))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text
    assert "CartesianProduct" not in text
