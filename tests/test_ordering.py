"""Positions in a global order, against Python's sort."""

import random

import pytest
from pyspark.sql import functions as F

from affinity.operators.ordering import with_positions


def test_positions_equal_a_sort(spark):
    rng = random.Random(3)
    rows = [(rng.choice("abc") if i % 3 else "hot", rng.randint(0, 20) if i % 7 else None, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "u string, s int, id int").repartition(5)
    got = with_positions(df, "u", F.col("s").desc_nulls_last(), "id", partitions=13)
    want = sorted(rows, key=lambda r: (r[0], r[1] is None, -(r[1] or 0), r[2]))
    assert [tuple(r)[:3] for r in got.orderBy("position").collect()] == want
    assert sorted(r["position"] for r in got.collect()) == list(range(1, 3001))


def test_hot_leading_key_is_split(spark):
    df = spark.range(2000).select(F.lit("one user").alias("u"), F.col("id").alias("s"))
    got = with_positions(df, "u", "s", partitions=8)
    assert [r["s"] for r in got.orderBy("position").collect()] == list(range(2000))
    # every range is read back with its own offset: no task holds all rows
    sizes = [r["count"] for r in got.groupBy(F.floor((F.col("position") - 1) / 250)).count().collect()]
    assert len(sizes) == 8 and max(sizes) == 250


def test_empty_clashing_and_no_order(spark):
    none = spark.createDataFrame([], "a int, _place int, _part int, _offset int, _n int")
    assert with_positions(none, "a").collect() == []
    one = spark.createDataFrame([(1, 2, 3, 4, 5)], none.schema)
    assert [tuple(r) for r in with_positions(one, "a").collect()] == [(1, 2, 3, 4, 5, 1)]
    with pytest.raises(ValueError):
        with_positions(none)
    with pytest.raises(ValueError):
        with_positions(none, "a", position="a")
