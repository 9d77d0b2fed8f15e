import random

import pytest
from pyspark.sql import functions as F

from namebridge.operators.blocking import _cells_per_key, _spread, block_join, spread_join


def names(seed, n):
    rng = random.Random(seed)
    words = ["a", "ab", "abc", "abcd", "abcde", "the", "thee", "x", "北"]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, 3))) for _ in range(n)]


def literal_pairs(left, right, prefix_length, include_empty):
    return sorted(
        (i, j)
        for i, a in enumerate(left)
        for j, b in enumerate(right)
        if (include_empty or a)
        and (a.split(" ")[0] == b.split(" ")[0] or a[:prefix_length] == b[:prefix_length])
    )


@pytest.mark.parametrize("cell_rows", [1, 3, 1000])
@pytest.mark.parametrize("prefix_length", [1, 4])
@pytest.mark.parametrize("include_empty", [False, True])
def test_block_join_equals_the_or_join(spark, cell_rows, prefix_length, include_empty):
    left, right = names(1, 40), names(2, 60)
    a = spark.createDataFrame(list(enumerate(left)), "i int, left_name string")
    b = spark.createDataFrame(list(enumerate(right)), "j int, right_name string")
    pairs = block_join(
        a, b, "left_name", "right_name", prefix_length=prefix_length, cell_rows=cell_rows,
        include_empty=include_empty,
    )
    got = sorted((r.i, r.j) for r in pairs.collect())
    assert got == literal_pairs(left, right, prefix_length, include_empty)


def test_extra_key_filters_by_equality(spark):
    a = spark.createDataFrame([("bank a", "GB"), ("bank b", None), ("bank c", "")], "left_name string, lc string")
    b = spark.createDataFrame([("bank x", "GB"), ("bank y", "FR"), ("bank z", "")], "right_name string, rc string")
    pairs = block_join(a, b, "left_name", "right_name", left_extra="lc", right_extra="rc")
    assert [(r.left_name, r.right_name) for r in pairs.collect()] == [("bank a", "bank x")]


def test_null_names_never_pair(spark):
    a = spark.createDataFrame([(None,)], "left_name string")
    b = spark.createDataFrame([(None,), ("",)], "right_name string")
    assert block_join(a, b, "left_name", "right_name", include_empty=True).count() == 0


def test_hot_key_is_shared_out_and_complete(spark):
    hot = F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("k"), F.col("id")))
    a = spark.range(100).select(hot.alias("k"), F.col("id").alias("i"))
    b = spark.range(60).select(hot.alias("k"), F.col("id").alias("j"))
    pairs = spread_join(a, b, "k", ["i"], ["j"], cell_rows=10)
    expected = 90 * 54 + 6
    assert pairs.count() == expected == pairs.select("i", "j").distinct().count()
    by_task = pairs.groupBy(F.spark_partition_id()).count().collect()
    assert len(by_task) == 4 and max(r["count"] for r in by_task) < expected / 2


def test_plan_has_no_nested_loop(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = spark.createDataFrame([("bank a",)], "left_name string")
        b = spark.createDataFrame([("bank b",)], "right_name string")
        plan = block_join(a, b, "left_name", "right_name")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_a_hot_key_is_shared_out_at_the_join(spark):
    """Nine tenths of the rows have one key; tasks are counted where the joins are made, without broadcasts."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        left = spark.range(20000).selectExpr("id as l", "if(id % 10 = 0, cast(id as string), 'hot') as k")
        right = spark.range(100).selectExpr("id as r", "if(id < 50, 'hot', cast(id as string)) as k")
        joined = spread_join(left, right, "k", ["l"], ["r"], 500).withColumn("task", F.spark_partition_id())
        per_task = [r["count"] for r in joined.groupBy("task").count().collect()]
        assert sum(per_task) == 18000 * 50 + 5 and max(per_task) < 5 * sum(per_task) / len(per_task) and len(per_task) >= 8
        cells = _cells_per_key(left, right, "k", 500)
        dealt = _spread(left, cells, "k", "left", "right", ["l"]).withColumn("task", F.spark_partition_id())
        per_task = [r["count"] for r in dealt.groupBy("task").count().collect()]
        assert max(per_task) < 5 * sum(per_task) / len(per_task)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_rows_are_shuffled_once_to_meet(spark):
    left = spark.range(100).selectExpr("id as l", "if(id % 2 = 0, 'hot', cast(id as string)) as k")
    right = spark.range(100).selectExpr("id as r", "if(id < 50, 'hot', cast(id as string)) as k")
    plan = spread_join(left, right, "k", ["l"], ["r"], 10)._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert not any("_salt" in line for line in shuffled)  # before: all rows were shuffled to look up their cells, too
    assert sum("REPARTITION_BY_NUM" in line for line in shuffled) == 2
