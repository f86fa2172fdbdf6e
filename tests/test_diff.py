from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sieveline.operators.diff import checksum_matrix, diff_copies

SCHEMA = "k string, x bigint, y string"


def brute(a, b):
    out = set()
    a, b = set(a), set(b)
    for k in {r[0] for r in a | b}:
        ra, rb = [r for r in a if r[0] == k], [r for r in b if r[0] == k]
        if not rb:
            out.add((k, "only_in_a", ""))
        elif not ra:
            out.add((k, "only_in_b", ""))
        else:
            for i, c in ((1, "x"), (2, "y")):
                if Counter(r[i] for r in ra) != Counter(r[i] for r in rb):
                    out.add((k, "value", c))
    return sorted(out, key=repr)


row = st.tuples(st.sampled_from(["a", "b", "c", "", None, "A", "a "]), st.sampled_from([None, 0, 1]), st.sampled_from([None, "", "v", "V"]))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, max_size=8), st.lists(row, max_size=8))
def test_against_brute_force(spark, rows, a, b):
    # no copy holds more than two different rows of one key here
    a, b = ([r for i, r in enumerate(x) if len({s for s in x[:i] if s[0] == r[0]} | {r}) <= 2] for x in (a, b))
    got = rows(diff_copies(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA), "k", ["x", "y"], buckets=4))
    assert got == brute(a, b)


def test_duplicates_nulls_and_empty_strings(spark, rows):
    a = spark.createDataFrame([("1", 1, "v")] * 3 + [("2", None, ""), (None, 1, "n")], SCHEMA)
    b = spark.createDataFrame([("1", 1, "v"), ("2", None, None), (None, 1, "m")], SCHEMA)
    assert rows(diff_copies(a, b, "k")) == [("2", "value", "y"), (None, "value", "y")]


def test_empty_copies(spark, rows):
    none, one = spark.createDataFrame([], SCHEMA), spark.createDataFrame([("1", 1, "v")], SCHEMA)
    assert rows(diff_copies(none, none, "k")) == []
    assert rows(diff_copies(one, none, "k")) == [("1", "only_in_a", "")]
    assert rows(diff_copies(none, one, "k")) == [("1", "only_in_b", "")]


def test_equal_copies_and_extra_columns(spark, rows):
    a = spark.createDataFrame([("1", 1, "v", 5)], SCHEMA + ", bucket int")
    b = spark.createDataFrame([("1", 1, "v", "q")], SCHEMA + ", extra string")
    assert rows(diff_copies(a, b, "k")) == []


def test_hot_key_long_values_and_matrix(spark, rows):
    long = "x" * 100_000
    a = spark.createDataFrame([("hot", i % 2, long) for i in range(200)], SCHEMA)
    b = spark.createDataFrame([("hot", i % 2, long + "!") for i in range(200)], SCHEMA)
    assert rows(diff_copies(a, b, "k")) == [("hot", "value", "y")]
    m = checksum_matrix(a, "k", ["x", "y"], 8).collect()
    assert len(m) == 1 and m[0]["n"] == 200


def test_only_unequal_columns_are_read(spark, tmp_path):
    for name, last in (("a", "w"), ("b", "W")):
        spark.createDataFrame([("1", 1, "v"), ("2", 2, last)], SCHEMA).write.parquet(str(tmp_path / name))
    a, b = (spark.read.parquet(str(tmp_path / n)) for n in "ab")
    plan = diff_copies(a, b, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<k:string,y:string>") == 2 and "x:bigint" not in plan
