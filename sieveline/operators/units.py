"""The full state table of mapping units: one row per nano from packs, ratios, the mixed set, strands and judgements.

Assumptions where the definition isn't published: a core's key is the start of the md5 of its sorted strand ids; a
document without a strand counts as far if the strand nearest to it by a margin was evaluated and isn't core; the least
share of attached documents is a parameter. The ladder of thresholds isn't reproduced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from . import status, strands
from .ratios import junk_flag

#: Assumed, see above.
ATTACH_FRAC_MIN = 0.1


def base_units(packs: DataFrame, ratios: DataFrame, mixed: DataFrame, dominated: float, review: float) -> DataFrame:
    """Packs with their ratio and their entry in the mixed set; a nano without ratio has none and isn't flagged."""
    m = mixed.select("nano_id", F.col("group").alias("mixed_group"), F.col("confidence").alias("mixed_confidence"), F.lit(True).alias("__mixed"))
    r = ratios.select("nano_id", F.col("pct_mem_jd").alias("junk_ratio"))
    rows = packs.select("nano_id", F.col("size").alias("n_valid"), "junk_candidate").join(r, "nano_id", "left").join(m, "nano_id", "left")
    return rows.withColumn("in_mixed", F.coalesce("__mixed", F.lit(False))).drop("__mixed").withColumn("junk_flag", junk_flag(F.col("junk_ratio"), dominated, review))


def basis_members(members: DataFrame, units: DataFrame, excluded: DataFrame, no_info: DataFrame) -> DataFrame:
    """``work_id, nano_id, basis`` of the members on whose strands a nano is judged: what is left of a junk nano without
    works of no information, else the valid members of a mixed one. A nano that is both has the junk basis alone."""
    of = units.select("nano_id", F.when(F.col("junk_flag") != "none", "junk").when(F.col("in_mixed"), "mixed").alias("basis")).where("basis is not null")
    valid = members.join(of, "nano_id").join(excluded.select("work_id").distinct(), "work_id", "left_anti")
    blank = no_info.select("work_id").distinct().withColumn("__blank", F.lit(True))
    return valid.join(blank, "work_id", "left").where((F.col("basis") == "mixed") | F.col("__blank").isNull()).select("work_id", "nano_id", "basis")


def strand_sizes(members: DataFrame, assignment: DataFrame) -> DataFrame:
    """``nano_id, basis, cid, n``: documents of each strand, combined map-side."""
    return members.join(assignment.select("work_id", "cid"), "work_id").groupBy("nano_id", "basis", "cid").agg(F.count(F.lit(1)).alias("n"))


def core_keys(judged: DataFrame) -> DataFrame:
    """``nano_id, core_key, core_cids`` of the strands that aren't far."""
    ids = F.array_sort(F.collect_list(F.when(~F.col("far"), F.col("cid"))))
    return judged.groupBy("nano_id").agg(ids.alias("core_cids")).withColumn("core_key", F.substring(F.md5(F.array_join("core_cids", ",")), 1, 8))


def unattached_far(unattached: DataFrame, judged: DataFrame) -> DataFrame:
    """``nano_id, n_unattached_margin, un_far_docs`` from ``nano_id, work_id, cid``: the nearest strand by a margin."""
    far = judged.select("nano_id", "cid", F.col("far").alias("__far"))
    rows = unattached.select("nano_id", "cid").join(far, ["nano_id", "cid"], "left")
    return rows.groupBy("nano_id").agg(F.count(F.lit(1)).alias("n_unattached_margin"), F.count_if(F.coalesce("__far", F.lit(False))).alias("un_far_docs"))


def core_verdicts(verdicts: DataFrame, keys: DataFrame, snapshot: DataFrame) -> DataFrame:
    """``nano_id, core_rejudge, core_rejudge_source``: ``DC_<nano>`` counts only where the core is that of the snapshot,
    ``DC_<nano>_<key>`` only for the present core; without errors, of the source of highest priority the last."""
    part = lambda i: F.regexp_extract("item_id", r"^DC_([0-9]+)(?:_(.+))?$", i)
    rows = verdicts.where(F.col("item_id").startswith("DC_") & F.col("format_error").isNull()).withColumns({"nano_id": part(1).try_cast("bigint"), "__key": part(2)})
    now = rows.join(keys.select("nano_id", "core_key"), "nano_id").join(snapshot.select("nano_id", F.col("core_key").alias("__old")), "nano_id", "left")
    valid = now.where(F.when(F.col("__key") == "", F.col("__old") == F.col("core_key")).otherwise(F.col("__key") == F.col("core_key")))
    return valid.groupBy("nano_id").agg(F.max(F.struct("priority", "seq", "verdict", "source")).alias("v")).select("nano_id", F.col("v.verdict").alias("core_rejudge"), F.col("v.source").alias("core_rejudge_source"))


def mixed_verdicts(verdicts: DataFrame) -> DataFrame:
    """``nano_id, mixed_verdict, mixed_verdict_confidence`` of ``D_<nano>``; the last without an error."""
    rows = verdicts.where(F.col("format_error").isNull()).withColumn("nano_id", F.regexp_extract("item_id", r"^D_([0-9]+)$", 1).try_cast("bigint")).where("nano_id is not null")
    return rows.groupBy("nano_id").agg(F.max(F.struct("priority", "seq", "verdict", "confidence")).alias("v")).select("nano_id", F.col("v.verdict").alias("mixed_verdict"), F.col("v.confidence").alias("mixed_verdict_confidence"))


def _zero(name: str) -> Column:
    return F.coalesce(name, F.lit(0)).cast("bigint").alias(name)


def mapping_units(units: DataFrame, residue: DataFrame, judged: DataFrame, unattached: DataFrame, verdicts: DataFrame, snapshot: DataFrame, overrides: DataFrame, attach_min: float = ATTACH_FRAC_MIN, least: float = config.CORE_SHARE_MIN) -> DataFrame:
    """One row per unit with everything its state follows from, the automatic and the final state.

    ``judged`` are strands with ``far``; ``overrides`` have (nano_key, status, reason, date, by, rederive_ladder). All
    joins are on the nano, so the tables keep one partitioning; the strands were aggregated before.
    """
    sums = strands.core_shares(judged).drop("core_share")
    keys = core_keys(judged)
    rows = units.join(residue, "nano_id", "left").join(sums, "nano_id", "left").join(unattached_far(unattached, judged), "nano_id", "left").join(keys, "nano_id", "left")
    rows = rows.join(core_verdicts(verdicts, keys, snapshot), "nano_id", "left").join(mixed_verdicts(verdicts), "nano_id", "left")
    junk = F.col("junk_flag") != "none"
    rows = rows.withColumns({"n_residue": F.when(junk, F.coalesce("n_residue", F.lit(0))), "n_core_strands_ge3": _zero("n_core_strands"), "far_docs": _zero("far_docs"), "n_unattached_margin": _zero("n_unattached_margin"), "un_far_docs": F.when(F.col("core_key").isNotNull(), F.coalesce("un_far_docs", F.lit(0))).otherwise(0)})
    denom = F.when(junk, F.col("n_residue")).otherwise(F.col("n_valid"))
    rows = strands.attachment(rows.withColumn("denom", denom), attach_min)
    rows = rows.withColumn("far_docs", F.col("far_docs") + F.col("un_far_docs"))
    share = F.when((F.col("in_mixed") | junk) & F.col("attached_docs").isNotNull(), 1 - F.col("far_docs") / F.greatest("denom", F.lit(1)))
    rows = rows.withColumn("core_share", F.when(F.col("attach_frac_low"), F.lit(0.0)).otherwise(share))
    rows = rows.withColumnRenamed("in_mixed", "in_mixed_first").withColumn("mixed_cleared", F.col("in_mixed_first") & F.coalesce(F.col("mixed_verdict") == "single", F.lit(False)))
    rows = rows.withColumn("in_mixed", F.col("in_mixed_first") & ~F.col("mixed_cleared"))
    state = status.decide(F.col("n_core_strands_ge3"), F.col("core_share"), F.col("core_rejudge"), F.col("junk_flag"), F.col("in_mixed"), F.col("attach_frac_low"), least)
    again = overrides.where(~F.col("nano_key").startswith("_") & F.coalesce("rederive_ladder", F.lit(False))).select(F.col("nano_key").try_cast("bigint").alias("nano_id")).distinct().withColumn("__again", F.lit(True))
    rows = rows.withColumn("status", state).join(again, "nano_id", "left")
    kept = F.col("status").isin("mixed_core", "junk_core", "mixed_core_review", "junk_core_review") & F.col("__again").isNull()
    rows = rows.withColumn("core_rule", F.when(kept, "prox_v1"))
    manual = overrides.where("status is not null")
    out = status.apply_overrides(rows.drop("__again", "denom", "n_core_strands"), manual)
    return out.withColumns({"tau_z": F.lit(config.TAU), "policy": F.lit("canonical"), "strand_cap": F.lit(0), "ref_min_docs": F.lit(config.REF_MIN_DOCS), "core_cids": F.to_json("core_cids")})
