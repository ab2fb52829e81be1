import pytest
from pyspark.sql import functions as F

from wardlight.operators import rejects
from wardlight.session import scratch_path
from wardlight.sources.encounters import read_encounters


def test_each_rule_alone_and_together(spark):
    rows = spark.createDataFrame(
        [(1, 5, "a"), (2, -1, "a"), (3, None, "b"), (4, 7, None), (None, -2, "b")], "id int, n int, kind string"
    )
    rules = {"positive": F.col("n") > 0, "is_a": F.col("kind") == "a"}
    valid, rejected, counts = rejects.divert(rows, rules, scratch_path(spark, "d"))
    assert [tuple(r) for r in valid.collect()] == [(1, 5, "a")]
    found = {r["n"]: r[rejects.BROKEN] for r in rejected.collect()}
    assert found == {-1: ["positive"], None: ["positive", "is_a"], 7: ["is_a"], -2: ["positive", "is_a"]}
    assert counts == {"rows": 5, "rejected": 4, "rule positive": 3, "rule is_a": 3}
    assert valid.columns == rows.columns


def test_empty_table_no_rules_and_clashing_names(spark):
    empty = spark.createDataFrame([], "n int")
    valid, rejected, counts = rejects.divert(empty, {"given": F.col("n").isNotNull()}, scratch_path(spark, "d"))
    assert (valid.count(), rejected.count(), counts) == (0, 0, {"rows": 0, "rejected": 0, "rule given": 0})
    some = spark.range(3)
    assert rejects.divert(some, {}, scratch_path(spark, "d"))[0].count() == 3
    with pytest.raises(ValueError, match="rejected"):
        rejects.divert(some.withColumn("rejected", F.lit(1)), {}, scratch_path(spark, "d"))


def test_rows_are_read_once_and_never_shuffled(spark, tiny, plan):
    judged = plan(rejects.judge(read_encounters(spark, tiny), rejects.intake_rules()))
    assert judged.count("FileScan") == 1 and "Exchange" not in judged
    valid, rejected, counts = rejects.divert(read_encounters(spark, tiny), rejects.intake_rules(), scratch_path(spark, "d"))
    assert valid.count() + rejected.count() == counts["rows"] == 1500 and rejected.count() == counts["rejected"] > 0
    assert "PartitionFilters: [isnotnull(rejected" in plan(valid)
