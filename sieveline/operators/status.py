"""Final state of each nano from its ratio, its core and recorded judgements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config


def resolve_verdicts(verdicts: DataFrame) -> DataFrame:
    """``nano_id, verdict, confidence, source``: of valid records the one of highest priority, then the last.

    ``verdicts`` has (item_id, verdict, confidence, format_error, core_key, priority, seq). ``DC_<nano>`` is valid,
    ``DC_<nano>_<key>`` only for the current core key; records with a format error are dropped.
    """
    part = lambda i: F.regexp_extract("item_id", r"^DC_([0-9]+)(?:_(.+))?$", i)
    rows = verdicts.where(F.col("format_error").isNull()).withColumns({"nano_id": F.expr("try_cast(nullif(regexp_extract(item_id, '^DC_([0-9]+)(?:_(.+))?$', 1), '') as bigint)"), "key": part(2)})
    valid = rows.where(F.col("nano_id").isNotNull() & ((F.col("key") == "") | (F.col("key") == F.col("core_key"))))
    return valid.groupBy("nano_id").agg(F.max(F.struct("priority", "seq", "verdict", "confidence", "source")).alias("v")).select("nano_id", "v.verdict", "v.confidence", "v.source")


def last_verdict(records: DataFrame, key: str, seq: str, value: str) -> DataFrame:
    """Keyed records of which the last wins, in the order of an explicit sequence."""
    return records.groupBy(key).agg(F.max_by(value, seq).alias(value))


def decide(n_core: Column, core_share: Column, verdict: Column, flag: Column, mixed: Column, low_attachment: Column, least: float = config.CORE_SHARE_MIN) -> Column:
    """The state; screened-out nanos come before mixed ones. Nulls count as no core, no verdict, not flagged."""
    junk, is_mixed = F.coalesce(flag != "none", F.lit(False)), F.coalesce(mixed, F.lit(False))
    kind = F.when(junk, "junk").when(is_mixed, "mixed")
    step = (
        F.when(F.coalesce(low_attachment, F.lit(False)) | (F.coalesce(n_core, F.lit(0)) == 0), "no_core")
        .when(F.coalesce(core_share < least, F.lit(True)), "no_core")
        .when(verdict == "single", "core")
        .when(verdict == "mixed", "no_core")
        .when(verdict == "uncertain", "core_review")
        .otherwise("core_pending")
    )
    return F.when(kind.isNull(), "normal").otherwise(F.concat_ws("_", kind, step))


def apply_overrides(states: DataFrame, overrides: DataFrame) -> DataFrame:
    """Manual states after the automatic one, which stays as ``status_auto``. ``overrides``: (nano_key, status, reason, date, by);
    keys that start with an underscore are history."""
    now = overrides.where(~F.col("nano_key").startswith("_")).select(F.col("nano_key").try_cast("bigint").alias("nano_id"), F.col("status").alias("manual"), F.concat(F.col("reason"), F.lit(" ("), F.concat_ws(", ", "date", "by"), F.lit(")")).alias("override_reason"))
    both = states.withColumnRenamed("status", "status_auto").join(now.where(F.col("nano_id").isNotNull()), "nano_id", "left")
    return both.withColumn("status", F.coalesce("manual", "status_auto")).drop("manual")


def assert_contract(checked: DataFrame) -> None:
    """Raises unless packs and members agree: they would be of different versions."""
    r = checked.first()
    if not r["agrees"]:
        raise ValueError(f"packs hold {r['packed']} works, members without exclusions are {r['kept']}")


def size_contract(packs: DataFrame, members: DataFrame, excluded: DataFrame) -> DataFrame:
    """Sum of pack sizes against members less exclusions, and whether they agree."""
    a = packs.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("packed"))
    b = members.join(excluded.select("work_id").distinct(), "work_id", "left_anti").agg(F.count(F.lit(1)).alias("kept"))
    return a.join(b).withColumn("agrees", F.col("packed") == F.col("kept"))
