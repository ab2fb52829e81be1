import os
import threading

import pytest
from pyspark.sql import functions as F

from wardlight import schema as S
from wardlight.session import scratch_path
from wardlight.sources import files, landing
from wardlight.sources.encounters import read_encounters


@pytest.fixture(scope="module")
def lines(spark, tiny, tmp_path_factory):
    """A header and 40 lines of raw encounters."""
    folder = str(tmp_path_factory.mktemp("lines") / "csv")
    files.write_csv(S.raw_header_columns(read_encounters(spark, tiny).orderBy("encounter_id").limit(40)).coalesce(1), folder)
    part = next(f for f in os.listdir(folder) if f.endswith(".csv"))
    with open(f"{folder}/{part}") as f:
        return f.read().splitlines()


@pytest.fixture
def drop(tmp_path, lines):
    def put(name, start, stop, extra=()):
        path = tmp_path / "source" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join([lines[0], *lines[1 + start : 1 + stop], *extra]) + "\n")
        return path

    put.folder, put.target = str(tmp_path / "source"), str(tmp_path / "target")
    return put


def land(spark, drop):
    return tuple(landing.land_new(spark, drop.folder, drop.target).first())


def test_only_new_files_are_landed(spark, drop):
    drop("a.csv", 0, 10), drop("deep/b c.csv", 10, 15), drop("empty.csv", 0, 0)
    assert land(spark, drop) == (1, 3, 15, 0)
    assert land(spark, drop) == (None, 0, 0, 0)
    drop("d.csv", 15, 20, ["not,a,row"])
    assert land(spark, drop) == (2, 1, 6, 1)
    assert land(spark, drop) == (None, 0, 0, 0)
    read = landing.read_landed(spark, drop.target)
    assert read.count() == 21 and read.select("encounter_id").na.drop().distinct().count() >= 20
    assert {r["landed_rows"] for r in landing.manifest(spark, drop.target).collect()} == {10, 5, 0, 6}


def test_a_changed_file_replaces_its_rows(spark, drop):
    path = drop("a.csv", 0, 10)
    drop("b.csv", 20, 22)
    assert land(spark, drop) == (1, 2, 12, 0)
    drop("a.csv", 5, 12)
    assert land(spark, drop)[:3] == (2, 1, 7)
    assert landing.read_landed(spark, drop.target).count() == 9
    path.unlink()
    assert land(spark, drop) == (None, 0, 0, 0) and landing.read_landed(spark, drop.target).count() == 9


def test_a_torn_run_is_landed_again(spark, drop, monkeypatch):
    drop("a.csv", 0, 10)
    with monkeypatch.context() as broken:
        broken.setattr(landing, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            land(spark, drop)
    assert landing.read_landed(spark, drop.target).count() == 0
    assert land(spark, drop) == (1, 1, 10, 0)
    assert landing.read_landed(spark, drop.target).count() == 10
    assert landing.drop_torn(spark, drop.target) == 1 and landing.drop_torn(spark, drop.target) == 0
    assert landing.read_landed(spark, drop.target).count() == 10


def test_two_runs_at_once_land_a_file_once(spark, drop):
    drop("a.csv", 0, 10)
    outcomes = []

    def one():
        try:
            outcomes.append(land(spark, drop)[2])
        except landing.LandingConflict:
            outcomes.append("conflict")

    threads = [threading.Thread(target=one) for _ in range(3)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert outcomes.count(10) == 1 and set(outcomes) <= {10, 0, "conflict"}
    assert landing.read_landed(spark, drop.target).count() == 10


def test_repeated_contents_are_named(spark, drop, lines):
    drop("a.csv", 0, 10), drop("c.csv", 3, 9)
    # The same rows in another order are the same contents.
    (drop("b.csv", 0, 0)).write_text("\n".join([lines[0], *reversed(lines[1:11])]) + "\n")
    land(spark, drop)
    row, = landing.repeated_files(spark, drop.target).collect()
    assert row["landed_rows"] == 10 and [f.rsplit("/", 1)[1] for f in row["files"]] == ["a.csv", "b.csv"]


def test_absent_and_empty_sources(spark, drop, tmp_path):
    (tmp_path / "source").mkdir()
    assert land(spark, drop) == (None, 0, 0, 0)
    assert landing.read_landed(spark, drop.target).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        landing.land_new(spark, str(tmp_path / "absent"), drop.target)


def test_another_header_fails_and_lands_nothing(spark, drop, tmp_path):
    drop("a.csv", 0, 3)
    (tmp_path / "source" / "b.csv").write_text("x,y\n1,2\n")
    with pytest.raises(Exception):
        land(spark, drop)
    assert landing.read_landed(spark, drop.target).count() == 0


def test_listing_reads_no_contents(spark, drop, plan):
    drop("a.csv", 0, 3)
    assert "ReadSchema: struct<path:string>" in plan(landing.list_files(spark, drop.folder))


def test_rows_keep_their_kinds(spark, drop):
    drop("a.csv", 0, 3)
    land(spark, drop)
    kinds = dict(landing.read_landed(spark, drop.target).dtypes)
    assert all(kinds[S.normalize_name(f.name)] == f.dataType.simpleString() for f in S.RAW_SCHEMA)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert landing.read_landed(spark, drop.target).filter(F.col("source_file").endswith("a.csv")).count() == 3
