import json

import pytest
from pyspark.sql import functions as F

from wardlight import schema as S
from wardlight.plans import jobs
from wardlight.session import materialize, scratch_path
from wardlight.sources import bundles, files, tables
from wardlight.sources.encounters import read_encounters


@pytest.fixture(scope="module")
def raw(spark, tiny):
    return materialize(read_encounters(spark, tiny), "raw")


@pytest.fixture(scope="module")
def csv(spark, raw):
    path = scratch_path(spark, "csv")
    files.write_csv(S.raw_header_columns(raw), path)
    return path


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_csv_comes_back_typed(spark, raw, csv):
    read = files.read_raw_csv(spark, csv)
    assert read.columns[23] == "A1Cresult" and "glyburide-metformin" in read.columns
    normalized = S.normalize_columns(read)
    assert normalized.schema == S.ENCOUNTER_SCHEMA and same(normalized, raw)
    assert same(files.read_raw_positional(spark, csv), raw)


def test_reading_csv_starts_no_job(spark, csv):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("read only", "")
    files.read_raw_csv(spark, csv)
    assert not tracker.getJobIdsForGroup("read only")
    spark.sparkContext.setJobGroup("", "")


def test_a_different_header_fails(spark, tmp_path):
    header = [f.name for f in S.RAW_SCHEMA]
    header[0], header[1] = header[1], header[0]
    (tmp_path / "swapped.csv").write_text(",".join(header) + "\n" + ",".join("1" for _ in header) + "\n")
    with pytest.raises(Exception, match="header"):
        files.read_raw_csv(spark, str(tmp_path)).collect()


def test_landing_counts_lines_that_do_not_parse(spark, tmp_path):
    header = [f.name for f in S.RAW_SCHEMA]
    good = ",".join("1" for _ in header)
    bad = ",".join(["not a number"] + ["1"] * (len(header) - 1))
    short = "1,2,3"
    (tmp_path / "in.csv").write_text("\n".join([",".join(header), good, bad, short]) + "\n")
    target = scratch_path(spark, "landed")
    for _ in range(2):
        counts = files.land_raw(spark, str(tmp_path / "in.csv"), target).first()
        assert (counts["landed_rows"], counts["corrupt_rows"]) == (3, 2)
    kept = spark.read.parquet(target).filter("_corrupt_record IS NOT NULL")
    assert {r["_corrupt_record"] for r in kept.collect()} == {bad, short}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.land_raw(spark, str(tmp_path / "absent.csv"), target)


def test_clean_table(spark, clean):
    path = scratch_path(spark, "clean")
    files.write_parquet(clean, path)
    table = tables.create_clean_table(spark, "external_clean", path)
    assert table.columns == S.CLEAN_COLUMNS and len(table.columns) == 55
    assert same(table, clean) and same(files.read_clean(spark, path), clean)
    spark.sql("DROP TABLE external_clean")
    assert same(spark.read.parquet(path), clean)


def test_preprocessing_job(spark, csv, clean):
    target = scratch_path(spark, "out")
    stored, report = jobs.run_preprocessing(spark, csv, target)
    assert report["status"] == "PASSED" and report["rows_removed"] == 331
    assert same(stored, clean)


def test_rejected_data_leaves_the_target_alone(spark, raw, clean):
    target, source = scratch_path(spark, "out"), scratch_path(spark, "csv")
    files.write_parquet(clean, target)
    from pyspark.sql import functions as F

    files.write_csv(S.raw_header_columns(raw.withColumn("readmitted", F.lit("maybe"))), source)
    assert jobs.main(["--input-path", source, "--output-path", target]) == 1
    assert same(files.read_clean(spark, target), clean)


def test_job_entry(spark, csv, capsys):
    args = ["--input-path", csv, "--output-path", scratch_path(spark, "out"), "--output-table", "job_out"]
    assert jobs.main(args) == 0
    assert "PASSED" in capsys.readouterr().out
    assert spark.table("job_out").count() == 1169


def bundle_rows(spark, documents):
    return spark.createDataFrame([(json.dumps(d),) for d in documents], "bundle string")


def bundle(*resources):
    return {"resourceType": "Bundle", "entry": [{"resource": r} for r in resources]}


def encounter(key, *ranked):
    return {
        "resourceType": "Encounter", "id": str(key), "subject": {"reference": f"Patient/{key}0"},
        "length": {"value": 3, "unit": "d"},
        "diagnosis": [{"condition": {"reference": f"Condition/{c}"}, "rank": r} for c, r in ranked],
    }


def condition(key, code):
    return {"resourceType": "Condition", "id": key, "code": {"coding": [{"system": bundles.ICD9, "code": code}]}}


def test_bundles_flatten(spark):
    rows = bundle_rows(
        spark,
        [
            bundle(encounter(1, ("a", 1), ("b", 2)), condition("a", "250.1")),
            bundle(condition("b", "428"), {"resourceType": "Patient", "id": "10"}),
            bundle(encounter(2)),
            bundle(encounter(3, ("absent", 1), ("a", 3))),
        ],
    )
    got = sorted(tuple(r) for r in bundles.flatten_bundles(rows).collect())
    assert got == [
        (1, 10, 3, "250.1", "428", None), (2, 20, 3, None, None, None), (3, 30, 3, None, None, "250.1"),
    ]


def test_copies_of_a_bundle_count_once(spark):
    same_one = bundle(encounter(1, ("a", 1)), condition("a", "428"))
    rows = bundle_rows(spark, [same_one] * 300 + [bundle(encounter(2, ("a", 2)))])
    got = sorted(tuple(r) for r in bundles.flatten_bundles(rows).collect())
    assert got == [(1, 10, 3, "428", None, None), (2, 20, 3, None, "428", None)]


def test_bundles_of_encounters_come_back(spark, clean):
    kept = ["encounter_id", "patient_nbr", "time_in_hospital", "diag_1", "diag_2", "diag_3"]
    back = bundles.flatten_bundles(bundles.encounters_to_bundles(clean)).select(kept)
    assert same(back, clean.select(kept))


def test_all_ranks_codings_and_broken_bundles_are_accounted_for(spark):
    snomed = {"system": "http://snomed.info/sct", "code": "999"}
    mixed = condition("a", "428")
    mixed["code"]["coding"].insert(0, snomed)
    made = [bundle(encounter(1, ("a", 1), ("b", 4), ("absent", 5)), mixed), bundle(condition("b", "250")), bundle(condition("b", "401"))]
    rows = bundle_rows(spark, made)
    assert [r["diag_1"] for r in bundles.flatten_bundles(rows).collect()] == ["428"]
    assert ("a", bundles.ICD9, "428") in [tuple(r) for r in bundles.flatten_conditions(rows).collect()]
    listed = {tuple(r) for r in bundles.flatten_diagnoses(rows).collect()}
    assert listed == {
        (1, 1, "a", bundles.ICD9, "428"), (1, 1, "a", snomed["system"], "999"), (1, 4, "b", bundles.ICD9, "250"),
        (1, 4, "b", bundles.ICD9, "401"), (1, 5, "absent", None, None),
    }
    broken = rows.unionByName(spark.createDataFrame([("{not json",), (None,), ("{}",)], "bundle string"))
    assert tuple(bundles.bundle_report(broken).first()) == (6, 1, 1, 1)


def test_broken_bundles_give_no_rows(spark):
    rows = spark.createDataFrame([("{not json",), (None,), ("{}",)], "bundle string")
    assert bundles.flatten_bundles(rows).count() == 0


def test_scratch_folder_of_a_cluster_must_be_named():
    class Cluster:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Cluster()
        conf = {}

    with pytest.raises(ValueError):
        scratch_path(Session(), "x")


def test_job_takes_columns_in_any_order_and_names_missing_ones(spark, raw, tmp_path):
    from wardlight.errors import SchemaValidationError
    from wardlight.plans.jobs import run_preprocessing

    named = S.raw_header_columns(raw)
    files.write_csv(named.select(*reversed(named.columns)), str(tmp_path / "reversed"))
    files.write_csv(named, str(tmp_path / "plain"))
    a, _ = run_preprocessing(spark, str(tmp_path / "reversed"), str(tmp_path / "a"))
    b, _ = run_preprocessing(spark, str(tmp_path / "plain"), str(tmp_path / "b"))
    assert a.exceptAll(b).isEmpty() and a.count() == b.count()
    files.write_csv(named.drop("insulin"), str(tmp_path / "missing"))
    with pytest.raises(SchemaValidationError, match="insulin"):
        run_preprocessing(spark, str(tmp_path / "missing"), str(tmp_path / "c"))


def test_encounters_are_dealt_by_their_number(spark, tmp_path):
    """A file of keys is one small task by its size; its rows become wide ones, and go to several."""
    orders = spark.range(60_000).selectExpr("id AS o_orderkey", "id % 500 AS o_custkey")
    orders.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    dealt = read_encounters(spark, str(tmp_path))
    sizes = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 3 and max(r["count"] for r in sizes) <= 25_000
    assert dealt.select("encounter_id").distinct().count() == 60_000
