import os
from types import SimpleNamespace

import pytest

from almanac import STATION_REPORT, ObservationSpec
from almanac.functions import cast_columns, normalise_key
from almanac.sources import (
    materialise,
    read_observations,
    reused,
    shared_path,
    shared_folder,
    write_csv,
    write_observations,
)
from tests.conftest import plan, rows

SCHEMA = STATION_REPORT.struct_type()


def table(spark, stations, sun=1.0):
    data = [(s, 1990 + i % 3, 1 + i % 12, 1.0, -2.0, None, 3.5, sun) for s in stations for i in range(5)]
    return spark.createDataFrame(data, SCHEMA)


def test_round_trip_keeps_keys_and_nulls(spark, tmp_path):
    df = table(spark, ["007", "A-B (c)", "x/y=z", "Åre"])
    root = str(tmp_path / "obs")
    write_observations(df, root)
    stored = read_observations(spark, root, SCHEMA)
    assert stored.schema == SCHEMA
    assert rows(stored) == rows(df)


def test_only_written_stations_are_replaced(spark, tmp_path):
    root = str(tmp_path / "obs")
    write_observations(table(spark, ["a", "b"], sun=1.0), root)
    write_observations(table(spark, ["b", "c"], sun=2.0), root)
    found = read_observations(spark, root, SCHEMA).groupBy("station", "sun").count()
    assert rows(found) == [("a", 1.0, 5), ("b", 2.0, 5), ("c", 2.0, 5)]


def test_a_station_is_read_from_its_directory_only(spark, tmp_path):
    root = str(tmp_path / "obs")
    write_observations(table(spark, ["a", "b"]), root)
    one = read_observations(spark, root, SCHEMA).filter("station = 'a' and month = 5").select("rain")
    text = plan(one)
    assert "PartitionFilters: [isnotnull(station" in text
    assert "EqualTo(month,5)" in text
    assert "ReadSchema: struct<month:int,rain:double>" in text


def test_rows_of_a_hot_station_are_split_over_files(spark, tmp_path, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    hot = spark.range(0, 200_000, 1, 8).selectExpr("'hot' station", "cast(id % 100 as int) year", "rand(1) x")
    cold = spark.range(0, 100, 1, 8).selectExpr("concat('s', id % 3) station", "2000 year", "0.5D x")
    root = str(tmp_path / "obs")
    write_observations(hot.unionByName(cold), root)
    files = {d: [f for f in os.listdir(f"{root}/{d}") if f.startswith("part")] for d in os.listdir(root) if "=" in d}
    assert len(files) == 4
    assert len(files["station=hot"]) > 1
    assert spark.read.parquet(root).count() == 200_100


def test_legacy_schema_has_string_measures(spark):
    kinds = [f.dataType.simpleString() for f in STATION_REPORT.struct_type(values_as_strings=True)]
    assert kinds == ["string", "int", "int"] + ["string"] * 5


def test_csv_has_no_header_and_replaces(spark, tmp_path):
    path = str(tmp_path / "csv")
    write_csv(spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string"), path)
    write_csv(spark.createDataFrame([(3, None)], "a int, b string"), path)
    assert rows(spark.read.schema("a int, b string").csv(path)) == [(3, None)]
    assert rows(spark.read.text(path)) == [("3,",)]


def test_csv_reads_back_the_same_doubles(spark, tmp_path):
    df = spark.createDataFrame([(0.1 + 0.2,), (1e-300,), (-12345678.9,)], "x double")
    write_csv(df, str(tmp_path / "csv"))
    assert rows(spark.read.schema(df.schema).csv(str(tmp_path / "csv"))) == rows(df)


def test_reused_table_is_released(spark):
    df = spark.range(10)
    with reused(df) as kept:
        assert kept.count() == 10
        assert kept.storageLevel.useMemory
    assert not df.storageLevel.useMemory


def test_materialised_table_lies_in_the_shared_folder(spark):
    kept = materialise(spark.range(10), "numbers")
    assert kept.count() == 10
    assert all(shared_folder(spark) in f for f in kept.inputFiles())
    assert shared_path(spark, "x") != shared_path(spark, "x")


def test_cast_by_declared_type(spark):
    df = spark.createDataFrame([("1", "2.5", "x", "2020-01-02 03:04:05", "keep")], "a string, b string, c string, d string, e string")
    kinds = [("a", "long"), ("b", "double"), ("c", "int"), ("d", "timestamp")]
    cast = cast_columns(df, kinds)
    assert [t for _, t in cast.dtypes] == ["bigint", "double", "int", "timestamp", "string"]
    row = cast.first()
    assert (row.a, row.b, row.c, row.e) == (1, 2.5, None, "keep")
    assert row.d is not None


def test_normalised_keys(spark):
    df = spark.createDataFrame([("Ross-on-Wye (2)  x",), ("plain",)], "k string")
    assert rows(df.select(normalise_key("k"))) == [("Ross_on_Wye_2_x",), ("plain",)]


def test_spec_from_settings():
    fields = [("place", "string"), ("year", "int"), ("month", "int"), ("flow", "double"), ("at", "timestamp"), ("n", "long")]
    config = {
        "schema": [{"cname": n, "ctype": t} for n, t in fields],
        "measuresCols": ["flow"],
        "winterMonths": [1, 2, 3],
    }
    spec = ObservationSpec.from_config(config, {"flow": ("mean flow", "m3")}, {"flow": 2})
    assert (spec.entity, spec.measure_names) == ("place", ["flow"])
    assert (spec.measures[0].label, spec.measures[0].unit, spec.measures[0].scale) == ("mean flow", "m3", 2)
    assert dict(spec.seasons)["winter"] == (1, 2, 3)
    assert dict(spec.seasons)["spring"] == (3, 4, 5)
    assert [f.dataType.simpleString() for f in spec.struct_type()] == ["string", "int", "int", "double", "timestamp", "bigint"]
    with pytest.raises(ValueError, match="decimal"):
        ObservationSpec.from_config({"schema": [{"cname": "x", "ctype": "decimal"}], "measuresCols": []})


def test_a_cluster_must_name_its_shared_folder():
    def session(master, folder=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(sparkContext=context, conf={"spark.checkpoint.dir": folder} if folder else {})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host:7077"))
    assert shared_folder(session("spark://host:7077", "hdfs://x/y")) == "hdfs://x/y"
    assert shared_path(session("yarn", "hdfs://x/y/"), "t").startswith("hdfs://x/y/almanac/t-")


def test_a_local_session_keeps_one_temporary_folder(monkeypatch, tmp_path):
    made = []

    def make(prefix):
        made.append(prefix)
        return str(tmp_path / f"{prefix}{len(made)}")

    folders = []
    context = SimpleNamespace(
        master="local[2]",
        getCheckpointDir=lambda: folders[-1] if folders else None,
        setCheckpointDir=folders.append,
    )
    session = SimpleNamespace(sparkContext=context, conf={})
    monkeypatch.setattr("tempfile.mkdtemp", make)
    assert shared_folder(session) == shared_folder(session) == folders[0]
    assert made == ["almanac-"]
