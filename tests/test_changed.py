"""Files that change, come and go between two runs."""

import os
from pathlib import Path

import pytest

from almanac import STATION_REPORT
from almanac.plans import ingest_changed, known_files, list_files
from almanac.sources import read_observations

HEAD = "Somewhere\nLocation: 5m amsl\n   yyyy  mm   tmax    tmin      af    rain     sun\n"


def line(year, month, value):
    return f"   {year}   {month}   {value}    1.0       2    3.0    4.0\n"


def put(folder, name, *rows, at=None):
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(HEAD + "".join(line(*r) for r in rows))
    if at is not None:
        os.utime(path, (at, at))
    return path


def stored(spark, root):
    found = read_observations(spark, root, STATION_REPORT.struct_type())
    return sorted((r.station, r.year, r.month, r.tmax) for r in found.collect())


def parts(root):
    """Data files of the store with their times of change."""
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet") if "_files" not in str(p)}


@pytest.fixture
def folders(tmp_path):
    source, root = tmp_path / "texts", tmp_path / "store"
    put(source, "alpha.txt", (1990, 1, 1.5), at=1000)
    put(source, "beta b.txt", (1991, 2, 2.5), (1991, 3, 2.6), at=1000)
    put(source, "gamma.txt", (1992, 4, 3.5), at=1000)
    return str(source), str(root)


def test_only_changed_files_are_read(spark, folders, monkeypatch):
    source, root = folders
    from almanac.plans import changed

    assert ingest_changed(spark, source, root) == ["alpha", "beta b", "gamma"]
    first = [("alpha", 1990, 1, 1.5), ("beta b", 1991, 2, 2.5), ("beta b", 1991, 3, 2.6), ("gamma", 1992, 4, 3.5)]
    assert stored(spark, root) == first
    before = parts(root)

    read, real = [], changed.read_lines
    monkeypatch.setattr(changed, "read_lines", lambda spark, paths, *a, **k: (read.extend(paths), real(spark, paths, *a, **k))[1])
    assert ingest_changed(spark, source, root) == []
    assert read == [] and parts(root) == before

    put(source, "beta b.txt", (1991, 2, 9.5), at=2000)
    assert ingest_changed(spark, source, root) == ["beta b"]
    assert [Path(p).name.replace("%20", " ") for p in read] == ["beta b.txt"]
    assert stored(spark, root) == [first[0], ("beta b", 1991, 2, 9.5), first[3]]
    after = parts(root)
    assert {p: t for p, t in after.items() if "beta" not in p} == {p: t for p, t in before.items() if "beta" not in p}


def test_files_that_come_and_go(spark, folders):
    source, root = folders
    ingest_changed(spark, source, root)
    os.remove(f"{source}/alpha.txt")
    put(source, "delta.txt", (2000, 1, 7.0))
    (Path(source) / "gamma.txt").write_text(HEAD)  # no data any more
    assert ingest_changed(spark, source, root) == ["alpha", "delta", "gamma"]
    assert {r[0] for r in stored(spark, root)} == {"beta b", "delta"}
    assert sorted(r.entity for r in known_files(spark, root).collect()) == ["beta b", "delta", "gamma"]


def test_an_entity_of_several_files_is_read_whole(spark, tmp_path):
    source, root = str(tmp_path / "texts"), str(tmp_path / "store")
    for station, name, row in [("x", "1.txt", (1990, 1, 1.0)), ("x", "2.txt", (1991, 1, 2.0)), ("y", "1.txt", (1990, 1, 3.0))]:
        put(f"{source}/station={station}", name, row, at=1000)
    folder = "station=([^/]*)/"
    assert ingest_changed(spark, source, root, entity_in=folder) == ["x", "y"]
    put(f"{source}/station=x", "2.txt", (1991, 1, 5.0), at=2000)
    assert ingest_changed(spark, source, root, entity_in=folder) == ["x"]
    assert stored(spark, root) == [("x", 1990, 1, 1.0), ("x", 1991, 1, 5.0), ("y", 1990, 1, 3.0)]


def test_a_failed_run_is_made_good(spark, folders, monkeypatch):
    source, root = folders
    from almanac.plans import changed

    ingest_changed(spark, source, root)
    put(source, "alpha.txt", (1990, 1, 8.0), at=3000)
    with monkeypatch.context() as patch:
        patch.setattr(changed, "write_observations", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest_changed(spark, source, root)
    assert ingest_changed(spark, source, root) == ["alpha"]
    assert ("alpha", 1990, 1, 8.0) in stored(spark, root)


def test_listing_does_not_read_the_files(spark, folders):
    found = list_files(spark, folders[0])
    read = found._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1]
    assert "length" in read and "content" not in read
    assert sorted((r.entity, r.size > 0) for r in found.collect()) == [("alpha", True), ("beta b", True), ("gamma", True)]


def test_mode_must_be_known(spark, folders):
    with pytest.raises(ValueError, match="mode"):
        ingest_changed(spark, *folders, mode="quick")
