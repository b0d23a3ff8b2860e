import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from coinwharf.operators.absence import without_match
from coinwharf.operators.hot_join import MOST_PARTS, _parts, hot_join, hot_keys
from coinwharf.operators.interleave import _rank
from coinwharf.operators.latest import latest_per_key
from coinwharf.operators.share import with_percentage
from coinwharf.operators.upsert import (
    DuplicateSourceKeys,
    apply_updates,
    check_unique,
    merge_upsert,
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_against_brute_force(spark):
    rng = random.Random(7)
    # One key holds a third of the rows; dates tie often; some are null.
    rows = [
        (rng.choice(["hot", None] + [f"k{i}" for i in range(4)]), rng.choice([None, 1, 2, 3]), rng.randrange(50))
        for _ in range(900)
    ]
    best = {}
    for key, day, value in rows:
        rank = (day is not None, day or 0, -value)
        if key not in best or rank > best[key][0]:
            best[key] = (rank, (key, day, value))
    expected = sorted((r for _, r in best.values()), key=str)
    for parts in (1, 5, 16):
        df = spark.createDataFrame(rows, "k string, d int, v int").repartition(parts)
        got = sorted((tuple(r) for r in latest_per_key(df, ["k"], ["d"]).collect()), key=str)
        assert got == expected


def test_latest_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("d"))
    plan = plan_of(latest_per_key(df, ["k"], ["d"]))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan and "Final" in plan


TARGET = [("a", 1, 10), ("b", 2, 20), (None, 3, 30)]
SOURCE = [("b", 7, 70), ("c", 8, 80), (None, 9, 90)]


def upsert(spark):
    ddl = "k string, x int, kept int"
    return spark.createDataFrame(TARGET, ddl), spark.createDataFrame(SOURCE, ddl)


def test_merge_upsert(spark):
    target, source = upsert(spark)
    got = {tuple(r) for r in merge_upsert(target, source, ["k"], ["x"]).collect()}
    assert got == {
        ("a", 1, 10, "keep"),
        ("b", 7, 20, "update"),
        ("c", 8, 80, "insert"),
        (None, 3, 30, "keep"),
        (None, 9, 90, "insert"),
    }


def test_merge_update_can_set_null(spark):
    target = spark.createDataFrame([("a", 1)], "k string, x int")
    source = spark.createDataFrame([("a", None)], "k string, x int")
    assert [tuple(r) for r in merge_upsert(target, source, ["k"], ["x"]).collect()] == [("a", None, "update")]


def test_merge_twice_changes_nothing(spark):
    target, source = upsert(spark)
    source = source.dropna(subset=["k"])
    once = merge_upsert(target, source, ["k"], ["x"]).drop("action")
    twice = merge_upsert(once, source, ["k"], ["x"])
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.drop("action").collect()))
    assert twice.where("action = 'insert'").isEmpty()


def test_apply_updates_is_the_update_half(spark):
    target, source = upsert(spark)
    got = {tuple(r) for r in apply_updates(target, source, ["k"], ["x"]).collect()}
    assert got == {("a", 1, 10), ("b", 7, 20), (None, 3, 30)}


def test_check_unique(spark):
    rows = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "k string")
    with pytest.raises(DuplicateSourceKeys):
        check_unique(rows, ["k"])
    check_unique(rows.where("k is null"), ["k"])


def test_percentage_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, v int")
    got = {tuple(r) for r in with_percentage(df, "v", "p").collect()}
    assert got == {("a", 1, 25.0), ("b", 3, 75.0)}
    plan = plan_of(with_percentage(df.groupBy("k").agg(F.sum("v").alias("v")), "v", "p"))
    assert "Window" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_percentage_of_zero_total_is_null(spark):
    df = spark.createDataFrame([("a", 1), ("b", -1)], "k string, v int")
    assert {tuple(r) for r in with_percentage(df, "v", "p").collect()} == {("a", 1, None), ("b", -1, None)}


def test_without_match(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    right = spark.createDataFrame([("a", dt.date(2024, 1, 1))] * 50 + [(None, None)], "k string, d date")
    got = {tuple(r) for r in without_match(left, right, ["k"]).collect()}
    assert got == {("b", 2), (None, 3)}
    assert "LeftAnti" in plan_of(without_match(left, right, ["k"]))


def test_adaptive_execution_splits_a_hot_join_key(spark):
    """A third of both sides on one key: the skewed partition is split, and no row is lost."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        big = spark.range(0, 30000, 1, 16).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("account_id"),
            F.col("id").alias("transaction_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("pad"),
        )
        small = spark.range(30000).select(F.col("id").alias("account_id"), F.lit("n").alias("name"))
        joined = big.join(small, "account_id").select("transaction_id", "name", "pad")
        assert len(joined.collect()) == 30000
        assert "skew=true" in plan_of(joined)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_join_deals_a_key_that_is_hot_on_both_sides(spark):
    """A third of both sides on one key: every pair once, and no part holds more than its share."""
    big = spark.range(0, 9000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 1000)).alias("k"), F.col("id").alias("a"))
    small = spark.range(0, 600, 1, 3).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), (F.col("id") % 590).alias("b"))
    assert {r["k"]: r["rows"] for r in hot_keys(big, "k", 0.01, 50).collect()} == {"hot": 3000}
    expected = sorted(tuple(r) for r in big.join(small, "k").collect())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = hot_join(big, small, "k", part_rows=50)
        assert joined.columns == ["k", "a", "b"] and sorted(tuple(r) for r in joined.collect()) == expected
        # 60 x 4 cells over 8 tasks: none does more than about twice its share of 600,000 pairs
        cells = joined.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert len(cells) == 8 and max(r["count"] for r in cells) < 150_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_hot_join_edges(spark):
    rows = [(1, "x"), (1, "x"), (None, "y"), (2, None)]
    left = spark.createDataFrame(rows, "k int, a string")
    right = left.withColumnRenamed("a", "b")
    for part_rows in (1, 100):
        got = sorted((tuple(r) for r in hot_join(left, right, "k", part_rows=part_rows).collect()), key=str)
        assert got == [(1, "x", "x")] * 4 + [(2, None, None)]
        assert hot_join(left, right.limit(0), "k", part_rows=part_rows).count() == 0
        assert hot_join(left.limit(0), right, "k", part_rows=part_rows).count() == 0


def test_hot_join_gives_each_pair_of_parts_a_task_however_few_its_bytes(spark):
    """Adaptive execution would pack all parts into a task or two by their bytes; their work is their pairs."""
    big = spark.range(0, 3600, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "left").otherwise(F.concat(F.lit("k"), F.col("id") % 900)).alias("k"), F.col("id").alias("a"))
    small = spark.range(0, 600, 1, 3).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") == 1, "left").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), F.col("id").alias("b"))
    expected = sorted(tuple(r) for r in big.join(small, "k").collect())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = hot_join(big, small, "k", part_rows=20)
        placed = [tuple(r) for r in joined.withColumn("task", F.spark_partition_id()).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert joined.columns == ["k", "a", "b"] and sorted(r[:3] for r in placed) == expected
    per_task = {}
    for k, _, _, task in placed:
        if k == "hot":
            per_task[task] = per_task.get(task, 0) + 1
    # 16 x 10 pairs of parts, dealt by hash over as many tasks
    assert sum(per_task.values()) == 1200 * 200 and len(per_task) > 80 and max(per_task.values()) < 15_000


def test_hot_join_copies_a_row_a_bounded_number_of_times(spark):
    cuts = spark.createDataFrame([(5,), (1_000,), (10**9,), (None,)], "n long").select("n", _parts(F.col("n"), 100).alias("p"))
    assert {r["n"]: r["p"] for r in cuts.collect()} == {5: 1, 1_000: 10, 10**9: MOST_PARTS, None: 1}
    left = spark.range(300).select(F.lit("hot").alias("k"), F.col("id").alias("a"))
    right = spark.range(200).select(F.lit("hot").alias("k"), F.col("id").alias("b"))
    joined = hot_join(left, right, "k", part_rows=1)
    assert joined.count() == joined.distinct().count() == 300 * 200


def test_interleaved_ranks_are_the_bounds_a_value_reaches(spark):
    rng = random.Random(5)
    texts = [None, "", "z", *(f"{rng.randrange(500)}" for _ in range(200))]
    bounds = sorted({t for t in texts if t})[::3][:63]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", _rank(F.col("t"), bounds).alias("r"))
    assert all(r["r"] == sum(r["t"] is not None and b <= r["t"] for b in bounds) for r in df.collect())
    comparisons = _rank(F.col("t"), bounds)._jc.toString().count("CASE WHEN")
    assert comparisons == len(bounds)


def test_ranks_count_the_bounds_a_value_reaches_in_short_code(spark):
    """Generated methods of more than 8000 bytes are never compiled by the JVM."""
    from coinwharf.operators.interleave import interleaved

    bounds = {"a": [f"{n:03d}" for n in range(0, 630, 10)], "b": ["b", "d", "é"], "c": []}
    rows = [(a, b, "x") for a in (None, "", "000", "0005", "299", "630", "~") for b in (None, "a", "b", "c", "z", "é", "一")]
    df = spark.createDataFrame(rows, "a string, b string, c string").repartition(2)
    placed = df.select("a", "b", interleaved(bounds).alias("place"))

    def place(a, b):
        ranks = [sum(v is not None and v.encode() >= x.encode() for x in cuts) * 64 // (len(cuts) + 1) for v, cuts in ((a, bounds["a"]), (b, bounds["b"]))]
        return sum((rank >> bit & 1) << 3 * bit + 2 - i for i, rank in enumerate(ranks) for bit in range(6))

    assert {(r["a"], r["b"]): r["place"] for r in placed.collect()} == {(a, b): place(a, b) for a, b, _ in rows}
    parts = placed._jdf.queryExecution().debug().codegenToSeq()
    assert max(parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())) < 8000
