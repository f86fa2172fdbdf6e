"""Research on rules: counts, candidates, deterministic samples and error rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import rules
from ..functions.dialect import matches
from ..functions.text import det_key
from .flags import typed_once
from .skew import top_per_key


def scan(members: DataFrame) -> DataFrame:
    """Both rule generations side by side: ``work_id, nano_id, title_head, v2_hit, types`` of the works that either hits."""
    rows = typed_once(members, F.col("title"), "types").select("work_id", "nano_id", F.substring("title", 1, config.HEAD_SCAN).alias("title_head"), matches("title", rules.V2).alias("v2_hit"), "types")
    return rows.where(F.col("v2_hit") | (F.size("types") > 0))


def hits_by_type(hits: DataFrame) -> DataFrame:
    """Per rule: hits, those that the second generation missed, and their nanos."""
    rows = hits.select("work_id", "nano_id", "v2_hit", F.explode("types").alias("type"))
    return rows.groupBy("type").agg(F.count(F.lit(1)).alias("hits"), F.count_if(~F.col("v2_hit")).alias("added"), F.count_distinct(F.when(~F.col("v2_hit"), F.col("nano_id"))).alias("added_nanos"))


def union_counts(hits: DataFrame, conditional: list[str]) -> DataFrame:
    typed = F.size("types") > 0
    only = typed & (F.size(F.array_except("types", F.array(*map(F.lit, conditional)))) == 0)
    return hits.agg(F.count(F.lit(1)).alias("either"), F.count_if("v2_hit").alias("v2"), F.count_if(typed).alias("v3"), F.count_if(F.col("v2_hit") & typed).alias("both"), F.count_if(only & ~F.col("v2_hit")).alias("conditional_only"))


def exclusive_new(hits: DataFrame) -> DataFrame:
    """Works that only one rule of the third generation hits, by rule."""
    one = hits.where(~F.col("v2_hit") & (F.size("types") == 1))
    return one.groupBy(F.col("types")[0].alias("type")).agg(F.count(F.lit(1)).alias("works"))


def second_pass_candidates(hits: DataFrame) -> DataFrame:
    """``work_id, nano_id, title_head, type, subform``: hits whose form needs a second judgement; judged on the stored head."""
    forms = F.array_compact(F.array(*[F.when(F.array_contains("types", t) & matches("title_head", p), F.struct(F.lit(t).alias("type"), F.lit(s).alias("subform"))) for (t, s), p in rules.SUBFORMS.items()]))
    return hits.where(~F.col("v2_hit")).select("work_id", "nano_id", "title_head", F.explode(forms).alias("f")).select("work_id", "nano_id", "title_head", "f.type", "f.subform")


def candidate_forms(titles: DataFrame) -> DataFrame:
    """``work_id, type, subform, conditional`` of all candidate forms; a null title has none."""
    forms = F.array_compact(F.array(*[F.when(matches("title", p), F.struct(F.lit(t).alias("type"), F.lit(s).alias("subform"), F.lit(c).alias("conditional"))) for (t, s), (p, c) in rules.CANDIDATES.items()]))
    return titles.select("work_id", F.explode(forms).alias("f")).select("work_id", "f.type", "f.subform", "f.conditional")


def ordered_sample(hits: DataFrame, per_type: int = config.AUDIT_PER_TYPE) -> DataFrame:
    """The first ``per_type`` works of each rule in a deterministic random order."""
    rows = hits.where(~F.col("v2_hit")).select("work_id", F.explode("types").alias("type")).withColumn("key", det_key("work_id"))
    first = top_per_key(rows, "type", [F.col("key"), F.col("work_id")], per_type)
    place = Window.partitionBy("type").orderBy("key", "work_id")
    return first.withColumn("place", F.row_number().over(place)).select("work_id", "type", "place")


def blind_audit(hits: DataFrame, batches: list[list[str]], per_type: int = config.AUDIT_PER_TYPE, strict: bool = False) -> DataFrame:
    """A work is drawn at most once over all types, in the order of the batches; ``strict`` raises if a type falls short.

    The rule is sequential over types. Each type needs at most ``per_type`` times the number of types candidates,
    which is a bounded list, so it is settled on the driver.
    """
    types = [t for b in batches for t in b]
    rows = ordered_sample(hits, per_type * len(types)).where(F.col("type").isin(types)).orderBy("type", "place").collect()
    queue: dict[str, list[str]] = {t: [] for t in types}
    for r in rows:
        queue[r["type"]].append(r["work_id"])
    taken, out = set(), []
    for number, batch in enumerate(batches, 1):
        for t in batch:
            mine = [w for w in queue[t] if w not in taken][:per_type]
            if strict and len(mine) < per_type:
                raise ValueError(f"{t} has {len(mine)} works left of {per_type}")
            taken.update(mine)
            out += [(w, t, number) for w in mine]
    return hits.sparkSession.createDataFrame(out, "work_id string, type string, batch int")


def stratified_sample(candidates: DataFrame, per_type: int = config.STRATIFIED_PER_TYPE, least: int = config.STRATIFIED_MIN) -> DataFrame:
    """About ``per_type`` works of each type, spread over its forms in proportion, at least ``least`` of a form."""
    rows = candidates.select("work_id", "type", "subform").distinct()
    form, kind = Window.partitionBy("type", "subform"), Window.partitionBy("type")
    sizes = rows.groupBy("type", "subform").agg(F.count(F.lit(1)).alias("n"))
    quota = sizes.withColumn("quota", F.greatest(F.lit(least), F.round(F.lit(per_type) * F.col("n") / F.sum("n").over(kind)).cast("int"))).drop("n")
    ranked = rows.withColumn("place", F.row_number().over(form.orderBy(det_key("work_id"), "work_id")))
    return ranked.join(quota, ["type", "subform"]).where(F.col("place") <= F.col("quota")).select("work_id", "type", "subform", "place")


def error_rates(calls: DataFrame) -> DataFrame:
    """Rates of false positives and borderline cases by type; ``calls`` has (type, call)."""
    n = F.count(F.lit(1))
    return calls.groupBy("type").agg(n.alias("n"), F.count_if(F.col("call") == "research").alias("fp"), F.count_if(F.col("call") == "borderline").alias("borderline"), F.round(F.count_if(F.col("call") == "research") / n, 4).alias("fp_rate"))


def fill_members(candidates: DataFrame, per_nano: int = 20) -> DataFrame:
    """The first ``per_nano`` works of each nano by tier, then citations, then a deterministic key.

    ``candidates`` has (nano_id, work_id, tier, cites); null citations come last.
    """
    order = [F.col("tier"), F.desc_nulls_last("cites"), det_key("nano_id", "work_id"), F.col("work_id")]
    return top_per_key(candidates, "nano_id", order, per_nano)
