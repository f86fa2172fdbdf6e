"""The exclusion table: one row per work with the reason of highest priority."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config


def exclusion(flags: DataFrame, retracted: DataFrame) -> DataFrame:
    """``work_id, nano_id, reason, title_head, snapshot``; ``retracted`` has (work_id, nano_id, title).

    One union and one aggregate over the flagged works; ``min`` of a struct led by the rank takes the first reason.
    """
    cause = retracted.select("work_id", "nano_id", F.substring("title", 1, config.HEAD_RETRACTED).alias("title_head"), F.lit("retracted").alias("reason"))
    rule = flags.where(~F.col("flag_only")).select("work_id", "nano_id", "title_head", F.concat(F.lit("junk_regex_"), "flag_source").alias("reason"))
    ranked = cause.unionByName(rule).withColumn("rank", F.array_position(F.array(*map(F.lit, config.REASONS)), F.col("reason")))
    first = ranked.groupBy("work_id").agg(F.min(F.struct("rank", "nano_id", "reason", "title_head")).alias("f"))
    snapshot = F.create_map(*[F.lit(x) for kv in config.SNAPSHOT.items() for x in kv])
    return first.select("work_id", "f.nano_id", "f.reason", "f.title_head", snapshot[F.col("f.reason")].alias("snapshot"))


def exclusion_by_anti_joins(flags: DataFrame, retracted: DataFrame) -> DataFrame:
    """The same table derived a second way: each reason without the works of those before it."""
    cause = retracted.select("work_id", "nano_id", F.lit("retracted").alias("reason"), F.substring("title", 1, config.HEAD_RETRACTED).alias("title_head"), F.lit(config.SNAPSHOT["retracted"]).alias("snapshot"))
    out = cause
    for source in ("v2", "v3"):
        reason = f"junk_regex_{source}"
        mine = flags.where((F.col("flag_source") == source) & ~F.col("flag_only"))
        out = out.unionByName(mine.join(cause, "work_id", "left_anti").select("work_id", "nano_id", F.lit(reason).alias("reason"), "title_head", F.lit(config.SNAPSHOT[reason]).alias("snapshot")))
    return out


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b).withColumn("side", F.lit("first")).unionByName(b.subtract(a).withColumn("side", F.lit("second")))


def uniqueness(df: DataFrame, key: str = "work_id") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("unique_ids"))


def unknown_values(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Values of a column outside an enumeration, with their number."""
    return df.where(~F.coalesce(F.col(column).isin(allowed), F.lit(False))).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
