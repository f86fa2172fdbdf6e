"""The screen over a stream of newly delivered titles: stateless rules and a join with static metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.dialect import matches
from ..operators.flags import type_array


def screen_stream(works: DataFrame, retracted: DataFrame, watermark: str = "1 day") -> DataFrame:
    """``work_id, reason, junk_types, loaded_at`` of streamed works to be excluded; a work delivered again within the
    watermark is reported once. ``retracted`` is static and has (work_id)."""
    title = F.coalesce("title_display", F.lit(""))
    known = retracted.select("work_id").distinct().withColumn("is_retracted", F.lit(True))
    typed = works.withWatermark("loaded_at", watermark).dropDuplicatesWithinWatermark(["work_id"]).select("work_id", "loaded_at", matches(title, rules.V2).alias("v2"), type_array(title).alias("junk_types"))
    both = typed.join(known, "work_id", "left")
    reason = F.when(F.col("is_retracted"), "retracted").when(F.col("v2"), "junk_regex_v2").when(F.size("junk_types") > 0, "junk_regex_v3")
    return both.select("work_id", reason.alias("reason"), "junk_types", "loaded_at").where(F.col("reason").isNotNull())


def counts_by_hour(excluded: DataFrame) -> DataFrame:
    """Exclusions by reason and hour of loading; late rows beyond the watermark are left out by the engine."""
    return excluded.groupBy(F.window("loaded_at", "1 hour").alias("w"), "reason").agg(F.count(F.lit(1)).alias("works")).select("w.start", "reason", "works")
