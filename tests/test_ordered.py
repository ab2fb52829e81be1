import random

import pytest

from wardlight.operators import ordered
from wardlight.operators.spread import join_spread
from wardlight.session import scratch_paths


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(3)
    rows = [
        (i, "hot" if rng.random() < 0.4 else f"g{rng.randrange(40)}", 0.25 if rng.random() < 0.35 else rng.random())
        for i in range(1500)
    ]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "id long, grp string, v double").repartition(6)


@pytest.mark.parametrize("pieces", [1, 3, 64])
def test_ranks(values, pieces):
    rows, df = values
    got = {r["v"]: (r["rows"], r["rows_below"], r["total_rows"]) for r in ordered.rank_values(df, "v", pieces).collect()}
    everything = [v for _, _, v in rows]
    assert got == {
        v: (everything.count(v), sum(x < v for x in everything), len(everything)) for v in set(everything)
    }


@pytest.mark.parametrize("pieces", [1, 4, 50])
def test_previous_in_group(values, pieces):
    rows, df = values
    expected, last = {}, {}
    for i, g, v in sorted(rows):
        expected[i] = last.get(g)
        last[g] = v
    got = ordered.with_previous(df, "grp", "id", "v", "before", pieces)
    assert got.columns == ["id", "grp", "v", "before"]
    assert {r["id"]: r["before"] for r in got.collect()} == expected


def test_pieces_are_even(values):
    rows, df = values
    points = ordered.split_points(df, "id", 10)
    sizes = [r["count"] for r in ordered.with_piece(df, "id", points).groupBy(ordered.PIECE).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 2 * len(rows) / 10


def test_empty_and_null(spark):
    empty = spark.createDataFrame([], "id long, grp string, v double")
    assert ordered.rank_values(empty, "v").count() == 0
    nulls = spark.createDataFrame([(None,), (1.0,)], "v double")
    assert [tuple(r) for r in ordered.rank_values(nulls, "v").collect()] == [(1.0, 1, 0, 1)]


@pytest.mark.parametrize("width", [1, 2, 4, 1000])
def test_spread_join_equals_the_plain_one(spark, width):
    rng = random.Random(5)
    rows = [
        (i, None if rng.random() < 0.3 else (7 if rng.random() < 0.5 else rng.randrange(50)), rng.choice("ab"))
        for i in range(1200)
    ]
    big = spark.createDataFrame(rows, "id long, k long, c string").repartition(4)
    unique = spark.createDataFrame(
        [(k, c, f"{k}{c}") for k in [*range(0, 50, 2), 7] for c in "ab"], "k long, c string, v string"
    )
    got = join_spread(big, unique, ["k", "c"], width=width)
    plain = big.join(unique, ["k", "c"], "left")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))
    hashed = join_spread(big, unique, ["k", "c"], width=width, many_keys=True)
    assert sorted(map(repr, hashed.collect())) == sorted(map(repr, plain.collect()))


def test_keys_that_differ_are_not_counted_one_by_one(spark):
    """A hash of the keys tells that none is hot, so no table of counts is written."""
    big, unique = spark.range(4000).withColumnRenamed("id", "k"), spark.range(4000).selectExpr("id AS k", "-id AS v")
    before = len(scratch_paths())
    assert join_spread(big, unique, ["k"], many_keys=True).filter("v = -k").count() == 4000
    assert len(scratch_paths()) == before
