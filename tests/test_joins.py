import random
from collections import Counter

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from recordloom.operators.joins import measure, sized_join
from recordloom.sources import materialize, materialize_measured


def _sides(spark):
    rng = random.Random(3)
    left = [(i, rng.choice([None, "hot", "hot", f"k{rng.randrange(20)}"]), rng.choice([None, 1, 2])) for i in range(2000)]
    right = [(f"k{i}", j, f"r{i}{j}") for i in range(0, 25, 2) for j in (1, 2)]
    right += [("hot", 1, "h1"), ("hot", 1, "h1 again"), ("hot", 2, "h2"), (None, 1, "never")]
    return (
        spark.createDataFrame(left, "id int, a string, b int"),
        materialize(spark.createDataFrame(right, "ra string, rb int, v string")),
    )


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_split_join_equals_plain_join(spark, how):
    left, right = _sides(spark)
    on = [(F.col("a"), F.col("ra")), (F.col("b"), F.col("rb"))]
    plain = left.join(right, (F.col("a") == F.col("ra")) & (F.col("b") == F.col("rb")), how)
    expected = Counter(map(tuple, plain.collect()))
    small = sized_join(left, right, on, how)
    assert small.columns == plain.columns and Counter(map(tuple, small.collect())) == expected
    assert "BroadcastHashJoin" in plan_of(small)
    for rows_per_task in (10, 100, 10_000):
        large = sized_join(left, right, on, how, budget=0, rows_per_task=rows_per_task, spread=["id"])
        assert large.columns == plain.columns
        assert Counter(map(tuple, large.collect())) == expected


def test_hot_key_is_spread(spark):
    left = spark.range(8000).select("id", F.lit("hot").alias("a"))
    right = materialize(spark.createDataFrame([("hot", "v")], "ra string, v string"))
    on = [(F.col("a"), F.col("ra"))]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # a budget of one byte also refuses to broadcast the list of hot keys
        for budget in (1, 1000):
            joined = sized_join(left, right, on, budget=budget, rows_per_task=100, size=2000)
            sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 8000 and max(sizes) < 3000 and len(sizes) >= 6
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_measure_counts_every_frame(spark):
    text = spark.createDataFrame([("abcd",), (None,)], "s string")
    assert measure(text, text.limit(0), spark.range(3)) == [68, 0, 72]  # 4 + 16 + 16 and 16 + 16; 8 + 16 each


def test_size_is_counted_while_writing(spark):
    df = spark.createDataFrame([("abcd", [1.5, 2.5]), (None, None)], "s string, a array<double>").repartition(2)
    table, size = materialize_measured(df)
    assert table.count() == 2 and size == measure(table)[0] > 0
    assert materialize_measured(df.limit(0))[1] == 0


@pytest.mark.parametrize("how", ["left", "inner"])
def test_beyond_the_budget_nothing_but_hot_keys_is_broadcast(spark, how):
    """However small the file: it may take a hundred times as much in memory."""
    left, right = _sides(spark)
    joined = sized_join(materialize(left), right, [(F.col("a"), F.col("ra")), (F.col("b"), F.col("rb"))], how, budget=0, rows_per_task=10_000)
    joined.count()
    assert "SortMergeJoin" in plan_of(joined)
