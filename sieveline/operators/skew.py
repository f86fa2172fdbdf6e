"""Per-key results without a task per hot key (problem 5).

Method: map-side combining. Every partition keeps a bounded hash table of key states (Spark's partial hash
aggregate, which spills by sorting when its memory is used up); only the compact partial states are shuffled
and merged. All aggregates offered here are algebraic, so no task ever sees the rows of one key.

Null keys form no group. Repeated rows count as often as they occur unless a distinct count is asked for.
An empty table gives an empty result. Extra columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def combine_by_key(df: DataFrame, key: str, aggs: dict[str, Column]) -> DataFrame:
    """One row per non-null ``key`` with algebraic aggregates (count, sum, min, max, avg, ...).

    The plan is partial hash aggregate, shuffle of the partial states, final aggregate: a key holding a third of
    all rows reaches the shuffle as one state per input partition.
    """
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*[c.alias(name) for name, c in aggs.items()])


def distinct_per_key(df: DataFrame, key: str, value: str, name: str = "members") -> DataFrame:
    """Number of distinct non-null ``value`` for each non-null ``key``.

    A distinct count has no small state, so it is made of two combines: the first is on (key, value), whose hash
    spreads a hot key over all tasks, the second counts and is algebraic.
    """
    pairs = df.select(F.col(key).alias(key), F.col(value).alias(value)).where(F.col(key).isNotNull() & F.col(value).isNotNull())
    return pairs.distinct().groupBy(key).agg(F.count(F.lit(1)).alias(name))


def top_per_key(df: DataFrame, key: str, order: list[Column], n: int, salts: int = 64) -> DataFrame:
    """The first ``n`` rows of each non-null ``key`` in ``order`` (which should be total; ties are kept by row number).

    Two rounds of ranking: within (key, salt), so that a hot key is spread over ``salts`` tasks, then over at most
    ``n * salts`` survivors of a key. Rows outside every salt's first ``n`` can't be among the key's first ``n``.
    """
    from pyspark.sql import Window

    from ..runtime import fresh

    salt, rank = fresh(df, "salt"), fresh(df, "rank")
    spread = df.where(F.col(key).isNotNull()).withColumn(salt, F.pmod(F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in df.columns]), F.lit(salts)))
    for part in ([key, salt], [key]):
        spread = spread.withColumn(rank, F.row_number().over(Window.partitionBy(*part).orderBy(*order))).where(F.col(rank) <= n).drop(rank)
    return spread.drop(salt)


def check_counts(members: DataFrame, claimed: DataFrame, key: str, claimed_key: str, claimed_count: str) -> DataFrame:
    """Keys of either side with counted and claimed members and whether they agree.

    A key missing on one side has 0 there; a null claim never agrees. A null key in ``claimed`` is no key. If a key
    is claimed in several rows, it agrees only if each of them does.
    """
    told = (
        claimed.select(F.col(claimed_key).alias("nano_id"), F.col(claimed_count).alias("n"))
        .where(F.col("nano_id").isNotNull())
        .groupBy("nano_id")
        .agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.max(F.col("n").isNull()).alias("unknown"))
    )
    both = members.select(F.col(key).alias("nano_id"), F.col("members").alias("counted")).join(told, "nano_id", "full_outer")
    counted = F.coalesce("counted", F.lit(0))
    agrees = ~F.coalesce("unknown", F.lit(False)) & (F.coalesce("lo", F.lit(0)) == counted) & (F.coalesce("hi", F.lit(0)) == counted)
    claim = F.when(F.col("unknown").isNull(), F.lit(0)).when(F.col("unknown"), None).otherwise(F.col("hi"))
    return both.select("nano_id", counted.cast("long").alias("members"), claim.cast("long").alias("claimed"), agrees.alias("agrees"))
