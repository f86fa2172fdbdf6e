"""Share of screened-out members of each nano."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.text import uninformative_title


def _pct(part: Column, whole: Column) -> Column:
    return F.lit(100.0) * part / F.greatest(whole, F.lit(1))


def nano_ratios(members: DataFrame, excluded: DataFrame, core: DataFrame) -> DataFrame:
    """Counts and percentages per nano over all members and over core members.

    ``members`` has (work_id, nano_id, title), ``excluded`` (work_id, reason), ``core`` (work_id). Retraction is no
    reason of the numerator. Two joins on the work, then one aggregate whose partial states alone are shuffled by nano,
    so a nano with a tenth of all members is no burden to one task.
    """
    junk = excluded.where(F.col("reason").like("junk_regex_%")).select("work_id").distinct().withColumn("jd", F.lit(True))
    cores = core.select("work_id").distinct().withColumn("core", F.lit(True))
    rows = members.select("work_id", "nano_id", uninformative_title("title").alias("ut")).join(junk, "work_id", "left").join(cores, "work_id", "left")
    jd, is_core, ut = F.coalesce("jd", F.lit(False)), F.coalesce("core", F.lit(False)), F.col("ut")
    counts = rows.groupBy("nano_id").agg(
        F.count(F.lit(1)).alias("members"), F.count_if(jd).alias("jd"), F.count_if(ut).alias("ut"), F.count_if(jd | ut).alias("comb"),
        F.count_if(is_core).alias("core_n"), F.count_if(is_core & (jd | ut)).alias("core_comb"), F.count_if(is_core & jd).alias("core_jd"),
    )
    c = F.col
    return counts.withColumns({"pct_mem_comb": _pct(c("comb"), c("members")), "pct_mem_jd": _pct(c("jd"), c("members")), "pct_core_comb": _pct(c("core_comb"), c("core_n")), "pct_core_jd": _pct(c("core_jd"), c("core_n"))})


def ratio_summary(ratios: DataFrame) -> DataFrame:
    r = F.col("pct_mem_jd")
    return ratios.agg(
        F.count(F.lit(1)).alias("nanos"), F.sum("members").alias("original_members"), F.sum("jd").alias("nonresearch_documents"),
        F.count_if(r >= config.DOMINATED).alias("nanos_ge50"), F.count_if((r >= config.REVIEW) & (r < config.DOMINATED)).alias("nanos_ge30_lt50"), F.count_if(r >= config.REVIEW).alias("nanos_ge30"),
    )


def ratio_quantiles(ratios: DataFrame, column: str = "pct_mem_comb") -> DataFrame:
    x = F.col(column)
    return ratios.agg(F.median(x).alias("median"), F.percentile(x, 0.9).alias("p90"), F.percentile(x, 0.99).alias("p99"), F.max(x).alias("highest"), F.count_if(x >= config.REVIEW).alias("ge30"))


def threshold_migration(ratios: DataFrame, old: str, new: str, threshold: float) -> DataFrame:
    """How many nanos enter, leave, stay above and stay below when the measure changes."""
    a, b = F.coalesce(F.col(old) >= threshold, F.lit(False)), F.coalesce(F.col(new) >= threshold, F.lit(False))
    return ratios.agg(F.count_if(~a & b).alias("enters"), F.count_if(a & ~b).alias("leaves"), F.count_if(a & b).alias("stays"), F.count_if(~a & ~b).alias("below"))


def junk_flag(ratio: Column, dominated: float = config.DOMINATED, review: float = config.REVIEW) -> Column:
    """``dominated``, ``review`` or ``none``; a nano without a ratio (null, never NaN) is ``none``."""
    return F.when(ratio >= dominated, "dominated").when(ratio >= review, "review").otherwise("none")
