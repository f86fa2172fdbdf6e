from pyspark.sql import functions as F

from sieveline.operators.skew import check_counts, combine_by_key, distinct_per_key, top_per_key


def test_distinct_per_key(spark, rows):
    data = [(1, "a"), (1, "a"), (1, "b"), (2, "a"), (None, "a"), (3, None)]
    df = spark.createDataFrame([(n, w, 0) for n, w in data], "k bigint, w string, members int")
    assert rows(distinct_per_key(df, "k", "w")) == [(1, 2), (2, 1)]


def test_combine_by_key_with_a_hot_key(spark, rows):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    got = {r["k"]: r["n"] for r in combine_by_key(df, "k", {"n": F.count(F.lit(1)), "top": F.max("id")}).collect()}
    assert sum(got.values()) == 3000 and got[0] >= 1000


def test_hot_key_never_reaches_one_task_as_rows(spark):
    df = spark.range(0, 40_000, 1, 8).select(F.lit(1).alias("k"), (F.col("id") % 100).alias("w"))
    plan = distinct_per_key(df, "k", "w")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 4  # partial and final, twice


def test_check_counts(spark, rows):
    members = spark.createDataFrame([(1, 5), (2, 3), (4, 1)], "k bigint, members bigint")
    claimed = spark.createDataFrame([(1, 5), (2, None), (3, 0), (5, 2), (None, 7), (4, 1), (4, 2)], "nano_id bigint, members bigint")
    got = {r[0]: r[3] for r in rows(check_counts(members, claimed, "k", "nano_id", "members"))}
    assert got == {1: True, 2: False, 3: True, 4: False, 5: False}


def test_empty(spark, rows):
    df = spark.createDataFrame([], "k bigint, w string")
    assert rows(distinct_per_key(df, "k", "w")) == []
    assert rows(check_counts(distinct_per_key(df, "k", "w"), df.select("k", F.lit(1).alias("n")), "k", "k", "n")) == []


def test_top_per_key_with_clashing_names(spark, rows):
    df = spark.createDataFrame([(k, v, v, -v) for k in (1, 2) for v in range(40)] + [(None, 1, 1, 1)], "k int, v int, salt int, rank int")
    got = rows(top_per_key(df, "k", [F.desc("v")], 3, salts=5))
    assert [r[:2] for r in got] == [(1, 37), (1, 38), (1, 39), (2, 37), (2, 38), (2, 39)]
    assert len(got[0]) == 4
