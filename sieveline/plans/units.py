"""Queries over the states of mapping units.

Packs, the mixed set, topic assignment, judgements and overrides aren't among the test tables; they are derived here from
the members and from the numbers in their ids, with the same arithmetic in Spark and in SQL. Real ratios of the test data
are low, so the thresholds of a junk nano and of proximity are lowered for these queries alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import ratios, strands, units
from ..runtime import written
from ..sources.tables import table
from .screening import _BASE, _core, _exclusion, _works

DOMINATED, REVIEW, TAU, TOPICS = 12.0, 6.0, 0.0, 12
COLUMNS = "nano_id n_valid junk_ratio junk_candidate mixed_group mixed_confidence junk_flag n_residue far_docs attached_docs n_core_strands_ge3 attach_frac attach_frac_low n_unattached_margin un_far_docs core_share core_key core_cids core_rejudge core_rejudge_source mixed_verdict mixed_verdict_confidence in_mixed_first mixed_cleared in_mixed core_rule status_auto status override_reason tau_z policy strand_cap ref_min_docs".split()


def _number():
    return F.regexp_extract("work_id", "([0-9]+)", 1).try_cast("bigint")


def _inputs(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    members, excluded = _exclusion(spark, d)
    excluded = written(excluded, "exclusion")
    ratio = ratios.nano_ratios(members, excluded, _core(spark, d)).select("nano_id", "pct_mem_jd")
    packs = written(members.join(excluded.select("work_id"), "work_id", "left_anti").groupBy("nano_id").agg(F.count(F.lit(1)).alias("size")).withColumn("junk_candidate", F.col("size") % 2 == 0), "packs")
    n = F.col("nano_id")
    mixed = packs.where(n % 3 == 0).select("nano_id", F.concat(F.lit("g"), (n % 2).cast("string")).alias("group"), F.when(n % 4 == 0, "medium").otherwise("high").alias("confidence"))
    u = written(units.base_units(packs, ratio, mixed, DOMINATED, REVIEW), "units")
    junk = excluded.where(F.col("reason").like("junk_regex_%")).select("work_id")
    with_abstract = _works(spark, d, "abstract_display").where(F.length("abstract_display") > 0)
    blank = members.where(text.uninformative_title("title")).join(with_abstract, "work_id", "left_anti").join(junk, "work_id", "left_anti")
    basis = written(units.basis_members(members.select("work_id", "nano_id"), u, excluded, blank).withColumn("k", _number()), "basis")
    assigned = basis.where("k % 7 <> 0").select("work_id", (F.col("k") % TOPICS).alias("cid"))
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("cid"), "embedding")
    sized = units.strand_sizes(basis, assigned).join(e, "cid")
    judged = written(strands.proximity(sized, strands.baseline(e), TAU), "judged")
    residue = basis.where("basis = 'junk'").groupBy("nano_id").agg(F.count(F.lit(1)).alias("n_residue"))
    unattached = basis.where("k % 14 = 0").select("nano_id", "work_id", (F.col("k") % TOPICS).alias("cid"))
    keys = units.core_keys(judged).select("nano_id", "core_key")
    ids = packs.select("nano_id", n.cast("string").alias("t"))
    item = lambda df, name, verdict, confidence, error, priority, source: df.select(name.alias("item_id"), verdict.alias("verdict"), confidence.alias("confidence"), error.cast("string").alias("format_error"), F.lit(priority).alias("priority"), F.lit(1).alias("seq"), F.lit(source).alias("source"))
    none, high = F.lit(None), F.lit("high")
    by_rest = F.when(n % 4 == 0, "single").when(n % 4 == 1, "mixed").otherwise("uncertain")
    verdicts = (
        item(ids.where(n % 4 != 3), F.concat(F.lit("DC_"), "t"), by_rest, high, F.when(n % 11 == 10, "bad"), 1, "first")
        .unionByName(item(ids.join(keys, "nano_id").where(n % 2 == 0), F.concat(F.lit("DC_"), "t", F.lit("_"), "core_key"), F.lit("single"), high, none, 3, "keyed"))
        .unionByName(item(ids.where(n % 5 == 0), F.concat(F.lit("DC_"), "t", F.lit("_stale")), F.lit("mixed"), high, none, 9, "stale"))
        .unionByName(item(ids, F.concat(F.lit("D_"), "t"), F.when(n % 9 == 0, "single").otherwise("mixed"), F.when(n % 2 == 0, "medium").otherwise("high"), none, 1, "mixed"))
    )
    manual = lambda df, key, state, again: df.select(key.alias("nano_key"), state.cast("string").alias("status"), F.lit("checked").alias("reason"), F.lit("2026-09-01").alias("date"), F.lit("a").alias("by"), again.cast("boolean").alias("rederive_ladder"))
    overrides = manual(ids.where(n % 17 == 0), F.col("t"), F.lit("normal"), none).unionByName(manual(ids.where(n % 17 == 1), F.concat(F.lit("_"), "t"), F.lit("junk_core"), none)).unionByName(manual(ids.where(n % 19 == 1), F.col("t"), none, F.lit(True)))
    snapshot = keys.withColumn("core_key", F.when(n % 13 == 12, "old").otherwise(F.col("core_key")))
    return {"units": u, "residue": residue, "judged": judged, "unattached": unattached, "verdicts": verdicts, "snapshot": snapshot, "overrides": overrides}


_UNITS = f"""{_BASE}, kept as (select mt.work_id, mt.nano_id, mt.title, try_cast(regexp_extract(mt.work_id, '([0-9]+)', 1) as bigint) as k from mt where mt.work_id not in (select work_id from excl)),
packs as (select nano_id, count(*) as n_valid, count(*) % 2 = 0 as junk_candidate from kept group by 1),
un as (select p.*, r.pct_mem_jd as junk_ratio, p.nano_id % 3 = 0 as in_mixed_first, case when p.nano_id % 3 = 0 then 'g' || (p.nano_id % 2) end as mixed_group, case when p.nano_id % 3 = 0 then case when p.nano_id % 4 = 0 then 'medium' else 'high' end end as mixed_confidence,
  case when r.pct_mem_jd >= {DOMINATED} then 'dominated' when r.pct_mem_jd >= {REVIEW} then 'review' else 'none' end as junk_flag from packs p left join ratio r on p.nano_id = r.nano_id),
blank as (select r.work_id from rows_ r left join works w on r.work_id = w.work_id where r.ut and not r.jd and coalesce(w.abstract_display, '') = ''),
basis as (select k.*, case when u.junk_flag <> 'none' then 'junk' else 'mixed' end as basis from kept k join un u on k.nano_id = u.nano_id where (u.junk_flag <> 'none' and k.work_id not in (select work_id from blank)) or (u.junk_flag = 'none' and u.in_mixed_first)),
emb as (select vec_id as cid, list_transform(embedding, lambda x: x::double) as v0 from embeddings where embedding is not null),
uv as (select cid, list_transform(v0, lambda x: x / sqrt(list_dot_product(v0, v0))) as v from emb),
dims as (select cid, generate_subscripts(v, 1) as i, unnest(v) as x from uv),
bl as (select mu, sqrt(s2 - mu * mu) as sd from (select (select sum(s * s) from (select i, sum(x) as s from dims group by 1)) / power((select count(*) from uv), 2) as mu, (select sum(m * m) from (select a.i, b.i as j, sum(a.x * b.x) as m from dims a join dims b on a.cid = b.cid group by 1, 2)) / power((select count(*) from uv), 2) as s2)),
sz as (select b.nano_id, b.k % {TOPICS} as cid, count(*) as n from basis b join uv on uv.cid = b.k % {TOPICS} where b.k % 7 <> 0 group by 1, 2),
tot as (select nano_id, sum(n) as total from sz group by 1 having count(*) >= 2),
st as (select sz.*, sz.n * 1.0::double / tot.total as share, uv.v from sz join tot on sz.nano_id = tot.nano_id join uv on uv.cid = sz.cid),
judged as (select s.nano_id, s.cid, s.n, coalesce(sum(r.share * (list_dot_product(s.v, r.v) - bl.mu) / bl.sd) / sum(r.share) < {TAU}, false) as far from st s cross join bl left join st r on s.nano_id = r.nano_id and r.n >= 3 and r.cid <> s.cid group by 1, 2, 3),
agg as (select nano_id, sum(n)::bigint as attached_docs, coalesce(sum(n) filter (where far), 0)::bigint as far0, count(*) filter (where not far and n >= 3) as ncore, coalesce(array_to_string(list_sort(list(cid) filter (where not far)), ','), '') as ids from judged group by 1),
ua as (select b.nano_id, count(*) as n_margin, count(*) filter (where coalesce(j.far, false)) as n_far from basis b left join judged j on j.nano_id = b.nano_id and j.cid = b.k % {TOPICS} where b.k % 14 = 0 group by 1),
rs as (select nano_id, count(*) as n from basis where basis = 'junk' group by 1),
j as (select u.*, case when junk_flag <> 'none' then coalesce(rs.n, 0) end as n_residue, a.attached_docs, coalesce(a.ncore, 0) as ncore, substr(md5(a.ids), 1, 8) as core_key, '[' || a.ids || ']' as core_cids, coalesce(ua.n_margin, 0) as n_margin,
  case when a.nano_id is not null then coalesce(ua.n_far, 0) else 0 end as un_far, coalesce(a.far0, 0) as far0, case when junk_flag <> 'none' then coalesce(rs.n, 0) else n_valid end as denom,
  case when a.nano_id is null then null when u.nano_id % 2 = 0 then 'single' when u.nano_id % 4 = 1 and u.nano_id % 11 <> 10 and u.nano_id % 13 <> 12 then 'mixed' end as verdict,
  case when u.nano_id % 9 = 0 then 'single' else 'mixed' end as mixed_verdict from un u left join rs on rs.nano_id = u.nano_id left join agg a on a.nano_id = u.nano_id left join ua on ua.nano_id = u.nano_id),
f as (select *, attached_docs * 1.0::double / greatest(denom, 1) as frac, in_mixed_first and mixed_verdict = 'single' as cleared from j),
g as (select *, in_mixed_first and not cleared as in_mixed, coalesce(attached_docs > 0 and frac < {units.ATTACH_FRAC_MIN}, false) as low, far0 + un_far as far_docs from f),
h as (select *, case when low then 0.0::double when (in_mixed_first or junk_flag <> 'none') and attached_docs is not null then 1 - (far_docs * 1.0::double) / greatest(denom, 1) end as core_share from g),
i as (select *, case when junk_flag <> 'none' then 'junk' when in_mixed then 'mixed' end as kind from h),
state as (select *, case when kind is null then 'normal' else kind || '_' || case when low or ncore = 0 or coalesce(core_share < 0.3, true) then 'no_core' when verdict = 'single' then 'core' when verdict = 'mixed' then 'no_core' when verdict = 'uncertain' then 'core_review' else 'core_pending' end end as auto from i)"""
_STATE = f"""with {_UNITS} select nano_id, n_valid, junk_ratio, junk_candidate, mixed_group, mixed_confidence, junk_flag, n_residue, far_docs, attached_docs, ncore as n_core_strands_ge3, round(case when attached_docs > 0 then frac end, 6) as attach_frac, low as attach_frac_low, n_margin as n_unattached_margin, un_far as un_far_docs, round(core_share, 6) as core_share, core_key, core_cids,
  verdict as core_rejudge, case when verdict is not null then case when nano_id % 2 = 0 then 'keyed' else 'first' end end as core_rejudge_source, mixed_verdict, case when nano_id % 2 = 0 then 'medium' else 'high' end as mixed_verdict_confidence, in_mixed_first, cleared as mixed_cleared, in_mixed,
  case when auto in ('mixed_core', 'junk_core', 'mixed_core_review', 'junk_core_review') and nano_id % 19 <> 1 then 'prox_v1' end as core_rule, auto as status_auto, case when nano_id % 17 = 0 then 'normal' else auto end as status, case when nano_id % 17 = 0 then 'checked (2026-09-01, a)' end as override_reason, 2.0::double as tau_z, 'canonical' as policy, 0 as strand_cap, 3 as ref_min_docs from state"""


def mapping_status(spark: SparkSession, d: str) -> DataFrame:
    out = units.mapping_units(**_inputs(spark, d))
    return out.withColumns({"attach_frac": F.round("attach_frac", 6), "core_share": F.round("core_share", 6)}).select(*COLUMNS)


def status_summary(spark: SparkSession, d: str) -> DataFrame:
    return mapping_status(spark, d).groupBy("status").agg(F.count(F.lit(1)).alias("nanos"))


def verdict_resolution(spark: SparkSession, d: str) -> DataFrame:
    i = _inputs(spark, d)
    return units.core_verdicts(i["verdicts"], units.core_keys(i["judged"]), i["snapshot"])


QUERIES = {"mapping_status": mapping_status, "status_summary": status_summary, "verdict_resolution": verdict_resolution}
SQL = {
    "mapping_status": _STATE,
    "status_summary": f"select status, count(*) as nanos from ({_STATE}) group by 1",
    "verdict_resolution": f"with {_UNITS} select nano_id, verdict as core_rejudge, case when nano_id % 2 = 0 then 'keyed' else 'first' end as core_rejudge_source from j where verdict is not null",
}
