"""Queries over the reference tables of the project: flags, exclusion, ratios, types, text functions, audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import rules, text, text_udf
from ..functions.dialect import matches
from ..functions.dialect import sql_literal as q
from ..operators import audit, exclusion, flags, near_duplicates, ratios, strands
from ..runtime import written
from ..sources.tables import table

# ---- inputs ---------------------------------------------------------------------------------------------------------


def _members(spark: SparkSession, d: str, *more: str) -> DataFrame:
    return flags.title_members(table(spark, d, "atlas_work_membership"), table(spark, d, "bib_store"), *more)


def _hits(spark: SparkSession, d: str) -> DataFrame:
    return flags.hit_members(table(spark, d, "atlas_work_membership"), table(spark, d, "bib_store"))


def _works(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return flags.latest_works(table(spark, d, "bib_store"), *columns)


def _retracted(members: DataFrame, spark: SparkSession, d: str) -> DataFrame:
    return members.join(table(spark, d, "work_meta").where("is_retracted").select("work_id"), "work_id", "left_semi")


def _research(spark: SparkSession, d: str) -> DataFrame:
    """Second judgements: works that the recorded flags keep as research."""
    return table(spark, d, "junk_doc_flags_v3").where("flag_only").select("work_id").distinct()


def _core(spark: SparkSession, d: str) -> DataFrame:
    return _works(spark, d, "type_openalex").where(F.lower("type_openalex") == "article").select("work_id")


def _flags(spark: SparkSession, d: str) -> DataFrame:
    """Flags of either generation; the few members that rules hit are written once, since both read them."""
    hits = written(_hits(spark, d), "hits")
    return flags.combine_flags(flags.v2_flags(hits), flags.demote(flags.v3_flags(hits), _research(spark, d)))


def _exclusion(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Members with titles, written once since rules, retraction and ratios read them, and the exclusion table."""
    members = written(_members(spark, d), "members")
    return members, exclusion.exclusion(_flags(spark, d), _retracted(members, spark, d))


def _ratios(spark: SparkSession, d: str) -> DataFrame:
    members, out = _exclusion(spark, d)
    return ratios.nano_ratios(members, out, _core(spark, d))


_TYPES = "list_filter([" + ", ".join(f"case when regexp_matches(title, {q(p)})" + (f" and not regexp_matches(title, {q(rules.V3_EXCLUDE[k])})" if k in rules.V3_EXCLUDE else "") + f" then '{k}' end" for k, p in rules.V3.items()) + "], lambda x: x is not null)"
_STOPS = ", ".join(q(w) for w in text.STOP)
_NORM = "trim(regexp_replace(regexp_replace(lower({0}), '[^a-z0-9 -]+', ' ', 'g'), ' +', ' ', 'g'))"
_UT = rf"(length(regexp_replace(title, '\\[a-zA-Z]+', '', 'g')) < 8 or len(list_filter(string_split({_NORM.format('title')}, ' '), lambda w: w <> '' and w not in ({_STOPS}))) < 3)"
_BASE = f"""works as (select * from (select *, row_number() over (partition by work_id order by loaded_at desc nulls last, title_display desc nulls last, abstract_display desc nulls last) rn from bib_store where work_id is not null) where rn = 1),
members as (select work_id, min(effective_nano_id) as nano_id from atlas_work_membership where work_id is not null and effective_nano_id is not null group by 1),
mt as (select m.work_id, m.nano_id, coalesce(w.title_display, '') as title from members m left join works w on m.work_id = w.work_id),
v2 as (select work_id, nano_id, substr(title, 1, 120) as title_head from mt where regexp_matches(title, {q(rules.V2)})),
v3 as (select * from (select work_id, nano_id, substr(title, 1, 120) as title_head, {_TYPES} as types from mt) where len(types) > 0),
research as (select distinct work_id from junk_doc_flags_v3 where flag_only),
comb as (select coalesce(a.work_id, b.work_id) as work_id, coalesce(a.nano_id, b.nano_id) as nano_id, coalesce(a.title_head, b.title_head) as title_head,
  coalesce(array_to_string(b.types, ','), '') as types, case when a.work_id is not null then 'v2' else 'v3' end as flag_source,
  a.work_id is null and b.work_id in (select work_id from research) as flag_only from v2 a full outer join v3 b on a.work_id = b.work_id),
ret as (select mt.* from mt join work_meta w on mt.work_id = w.work_id where w.is_retracted),
excl as (select work_id, nano_id, 'retracted' as reason, substr(title, 1, 80) as title_head, '{config.SNAPSHOT["retracted"]}' as snapshot from ret
  union all select work_id, nano_id, 'junk_regex_' || flag_source, title_head, case when flag_source = 'v2' then '{config.SNAPSHOT["junk_regex_v2"]}' else '{config.SNAPSHOT["junk_regex_v3"]}' end from comb where not flag_only and work_id not in (select work_id from ret)),
core as (select work_id from works where lower(type_openalex) = 'article'),
rows_ as (select mt.work_id, mt.nano_id, x.work_id is not null as jd, c.work_id is not null as core, {_UT} as ut from mt left join (select * from excl where reason like 'junk_regex_%') x on mt.work_id = x.work_id left join core c on mt.work_id = c.work_id),
ratio as (select *, 100.0::double * comb / greatest(members, 1) as pct_mem_comb, 100.0::double * jd / greatest(members, 1) as pct_mem_jd, 100.0::double * core_comb / greatest(core_n, 1) as pct_core_comb, 100.0::double * core_jd / greatest(core_n, 1) as pct_core_jd
  from (select nano_id, count(*) as members, count(*) filter (where jd) as jd, count(*) filter (where ut) as ut, count(*) filter (where jd or ut) as comb, count(*) filter (where core) as core_n, count(*) filter (where core and (jd or ut)) as core_comb, count(*) filter (where core and jd) as core_jd from rows_ group by 1)),
hits as (select * from (select work_id, nano_id, substr(title, 1, 200) as title_head, regexp_matches(title, {q(rules.V2)}) as v2_hit, {_TYPES} as types from mt) where v2_hit or len(types) > 0)"""


def _sql(query: str) -> str:
    return f"with {_BASE} {query}"


QUERIES, SQL = {}, {}


def _query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


# ---- flags and exclusion ----------------------------------------------------------------------------------------------


@_query("works_membership", _sql("select work_id, nano_id, title from mt"))
def works_membership(spark, d):
    return _members(spark, d)


@_query("v2_flags", _sql("select work_id, nano_id, title_head, 'junk_regex_v2' as reason from v2"))
def v2_flags(spark, d):
    return flags.v2_flags(_hits(spark, d))


@_query("v3_flags", _sql("select work_id, nano_id, title_head, array_to_string(types, ',') as junk_types from v3"))
def v3_flags(spark, d):
    return flags.v3_flags(_hits(spark, d)).withColumn("junk_types", F.array_join("junk_types", ","))


@_query("v3_flags_demoted", _sql("select work_id, array_to_string(types, ',') as junk_types, work_id in (select work_id from research) as flag_only from v3"))
def v3_flags_demoted(spark, d):
    return flags.demote(flags.v3_flags(_hits(spark, d)), _research(spark, d)).select("work_id", F.array_join("junk_types", ",").alias("junk_types"), "flag_only")


@_query("flags_combined", _sql("select work_id, nano_id, title_head, types as junk_types, flag_source, flag_only from comb"))
def flags_combined(spark, d):
    return _flags(spark, d).withColumn("junk_types", F.array_join("junk_types", ","))


@_query("exclusion_flags", _sql("select * from excl"))
def exclusion_flags(spark, d):
    return _exclusion(spark, d)[1]


@_query("exclusion_two_ways", _sql("select work_id, nano_id, reason, title_head, snapshot, 'first' as side from excl where false"))
def exclusion_two_ways(spark, d):
    members = written(_members(spark, d), "members")
    f = written(_flags(spark, d), "flags")
    r = _retracted(members, spark, d)
    return exclusion.symmetric_difference(exclusion.exclusion(f, r), exclusion.exclusion_by_anti_joins(f, r))


@_query("exclusion_reason_counts", _sql("select reason, count(*) as documents from excl group by 1"))
def exclusion_reason_counts(spark, d):
    return exclusion_flags(spark, d).groupBy("reason").agg(F.count(F.lit(1)).alias("documents"))


@_query("exclusion_uniqueness", _sql("select count(*) as n_rows, count(distinct work_id) as unique_ids from excl"))
def exclusion_uniqueness(spark, d):
    return exclusion.uniqueness(exclusion_flags(spark, d))


@_query("exclusion_unknown_reasons", "select reason, count(*) as n from exclusion_flags where reason is null or reason not in ('retracted', 'junk_regex_v2', 'junk_regex_v3') group by 1")
def exclusion_unknown_reasons(spark, d):
    return exclusion.unknown_values(table(spark, d, "exclusion_flags"), "reason", config.REASONS)


@_query("flag_source_counts", _sql("select flag_source, flag_only, count(*) as documents from comb group by 1, 2"))
def flag_source_counts(spark, d):
    return flags_combined(spark, d).groupBy("flag_source", "flag_only").agg(F.count(F.lit(1)).alias("documents"))


@_query("consumer_anti_join", _sql("select nano_id, count(*) as kept from mt where work_id not in (select work_id from excl) group by 1"))
def consumer_anti_join(spark, d):
    members, out = _exclusion(spark, d)
    return members.join(out.select("work_id"), "work_id", "left_anti").groupBy("nano_id").agg(F.count(F.lit(1)).alias("kept"))


# ---- ratios ---------------------------------------------------------------------------------------------------------


@_query("nano_ratio", _sql("select * from ratio"))
def nano_ratio(spark, d):
    return _ratios(spark, d)


@_query("nano_ratio_summary", _sql("select count(*) as nanos, sum(members)::bigint as original_members, sum(jd)::bigint as nonresearch_documents, count(*) filter (where pct_mem_jd >= 50) as nanos_ge50, count(*) filter (where pct_mem_jd >= 30 and pct_mem_jd < 50) as nanos_ge30_lt50, count(*) filter (where pct_mem_jd >= 30) as nanos_ge30 from ratio"))
def nano_ratio_summary(spark, d):
    return ratios.ratio_summary(_ratios(spark, d))


@_query("nano_ratio_quantiles", _sql("select median(pct_mem_comb) as median, quantile_cont(pct_mem_comb, 0.9) as p90, quantile_cont(pct_mem_comb, 0.99) as p99, max(pct_mem_comb) as highest, count(*) filter (where pct_mem_comb >= 30) as ge30 from ratio"))
def nano_ratio_quantiles(spark, d):
    return ratios.ratio_quantiles(_ratios(spark, d))


@_query("threshold_migration", _sql("select count(*) filter (where not pct_core_comb >= 30 and pct_mem_comb >= 30) as enters, count(*) filter (where pct_core_comb >= 30 and not pct_mem_comb >= 30) as leaves, count(*) filter (where pct_core_comb >= 30 and pct_mem_comb >= 30) as stays, count(*) filter (where not pct_core_comb >= 30 and not pct_mem_comb >= 30) as below from ratio"))
def threshold_migration(spark, d):
    return ratios.threshold_migration(_ratios(spark, d), "pct_core_comb", "pct_mem_comb", config.REVIEW)


@_query("core_vs_member_ratio", _sql("select coalesce(a.nano_id, b.nano_id) as nano_id, coalesce(a.members, 0) as recorded, coalesce(b.members, 0) as counted, coalesce(b.core_n, 0) as core_n from (select nano_id, max(members) as members from a5_dist where nano_id is not null group by 1) a full outer join ratio b on a.nano_id = b.nano_id"))
def core_vs_member_ratio(spark, d):
    recorded = table(spark, d, "a5_dist").where("nano_id is not null").groupBy("nano_id").agg(F.max("members").alias("recorded"))
    counted = _ratios(spark, d).select("nano_id", F.col("members").alias("counted"), "core_n")
    return recorded.join(counted, "nano_id", "full_outer").select("nano_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("recorded", "counted", "core_n")])


@_query("junk_flag_tiers", "select nano_id, case when coalesce(pct_mem_jd, 0) >= 50 and not isnan(pct_mem_jd) then 'dominated' when coalesce(pct_mem_jd, 0) >= 30 and not isnan(pct_mem_jd) then 'review' else 'none' end as junk_flag from a5_dist")
def junk_flag_tiers(spark, d):
    ratio = F.when(~F.isnan("pct_mem_jd"), F.col("pct_mem_jd"))
    return table(spark, d, "a5_dist").select("nano_id", ratios.junk_flag(ratio).alias("junk_flag"))


# ---- title types --------------------------------------------------------------------------------------------------------

_TYPE_CASE = "case " + " ".join(f"when regexp_matches(title, {q(p)}) then '{k}'" for k, p in rules.TITLE_TYPES.items()) + " else 'other' end"


@_query("title_types", _sql(f"select work_id, {_TYPE_CASE} as title_type from mt"))
def title_types(spark, d):
    return _members(spark, d).select("work_id", flags.title_type(F.col("title")).alias("title_type"))


@_query(
    "type_dist",
    _sql(f"""select nano_id, junk_type, count(*) as docs from (select nano_id, {_TYPE_CASE} as junk_type from mt where regexp_matches(title, {q(rules.V2)})
  union all select nano_id, unnest(types) as junk_type from v3 where work_id not in (select work_id from v2)) group by 1, 2"""),
)
def type_dist(spark, d):
    members = written(_hits(spark, d), "hits")
    second = members.where(matches("title", rules.V2)).select("work_id", "nano_id", flags.title_type(F.col("title")).alias("junk_type"))
    third = flags.v3_flags(members).join(second.select("work_id"), "work_id", "left_anti").select("nano_id", F.explode("junk_types").alias("junk_type"))
    return second.select("nano_id", "junk_type").unionByName(third).groupBy("nano_id", "junk_type").agg(F.count(F.lit(1)).alias("docs"))


@_query("display_names", f"select * from (values {', '.join(f'({q(k)}, {q(v)})' for k, v in rules.DISPLAY.items())}) t(rule, display_name)")
def display_names(spark, d):
    return spark.createDataFrame(list(rules.DISPLAY.items()), "rule string, display_name string")


# ---- scalar text functions ------------------------------------------------------------------------------------------------

_U = text.USPACE
_CLEAN = rf"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(abstract_display, ''), '\x{{2028}}', ' ', 'g'), '<[^>]+>', ' ', 'g'), '(?i)click to (?:increase|decrease) image size', ' ', 'g'), '(?i)^{_U}*abstract(?:[:.]|{_U})+', ''), '{_U}+', ' ', 'g'))"""


@_query("uninformative_titles", _sql(f"select work_id, {_UT} as uninformative from mt"))
def uninformative_titles(spark, d):
    return _members(spark, d).select("work_id", text.uninformative_title("title").alias("uninformative"))


@_query("abstract_validity", _sql(f"select work_id, length(coalesce(abstract_display, '')) >= 25 and not regexp_matches(coalesce(abstract_display, ''), '(?i)^{_U}*(?:no abstract|abstract not available)') as valid from works"))
def abstract_validity(spark, d):
    return _works(spark, d, "abstract_display").select("work_id", text.abstract_ok("abstract_display").alias("valid"))


@_query("clean_abstract", _sql(f"select work_id, {_CLEAN} as abstract from works"))
def clean_abstract(spark, d):
    return _works(spark, d, "abstract_display").select("work_id", text.clean_abstract("abstract_display").alias("abstract"))


@_query("trunc_abstract", _sql(f"select work_id, case when length(a) <= 1200 then a else substr(a, 1, 800) || ' … ' || right(a, 400) end as abstract from (select work_id, {_CLEAN} as a from works)"))
def trunc_abstract(spark, d):
    return clean_abstract(spark, d).withColumn("abstract", text.trunc("abstract"))


_IRREGULAR = "case w " + " ".join(f"when {q(k)} then {q(v)}" for k, v in text.IRREGULAR.items()) + " end"
_SINGULAR = f"coalesce({_IRREGULAR}, case when regexp_matches(w, '[0-9]') then w when length(w) > 4 and ends_with(w, 'ies') then substr(w, 1, length(w) - 3) || 'y' when length(w) > 4 and regexp_matches(w, '(?:ss|sh|ch|x|z)es$') then substr(w, 1, length(w) - 2) when length(w) > 3 and ends_with(w, 's') and not ends_with(w, 'ss') then substr(w, 1, length(w) - 1) else w end)"


@_query("term_keys", _sql(f"select work_id, {_NORM.format('title')} as normalised, array_to_string(list_transform(list_filter(string_split({_NORM.format('title')}, ' '), lambda w: w <> ''), lambda w: {_SINGULAR}), ' ') as term_key from mt"))
def term_keys(spark, d):
    return _members(spark, d).select("work_id", text.norm("title").alias("normalised")).withColumn("term_key", text.term_key("normalised"))


@_query("det_keys", _sql("select work_id, md5('7:' || work_id || ':' || nano_id) as det_key from mt"))
def det_keys(spark, d):
    return _members(spark, d).select("work_id", text.det_key("work_id", "nano_id").alias("det_key"))


@_query("tokens_est", _sql("select nano_id, sum(length(title) // 4)::bigint as tokens from mt group by 1"))
def tokens_est(spark, d):
    return _members(spark, d).groupBy("nano_id").agg(F.sum(text.tokens_est("title")).alias("tokens"))


@_query("script_profile", _sql(r"select work_id, length(regexp_replace(title, '[^A-Za-z]', '', 'g')) as latin, length(regexp_replace(title, '[^\x{4E00}-\x{9FFF}\x{AC00}-\x{D7AF}\x{3040}-\x{30FF}]', '', 'g')) as cjk from mt"))
def script_profile(spark, d):
    return _members(spark, d).select("work_id", text.script_counts("title").alias("s")).select("work_id", "s.latin", "s.cjk")


@_query("functional_sentences", _sql(f"select work_id from works where regexp_matches(abstract_display, {q(rules.FUNCTIONAL)})"))
def functional_sentences(spark, d):
    return _works(spark, d, "abstract_display").where(matches("abstract_display", rules.FUNCTIONAL)).select("work_id")


@_query("language_state")
def language_state(spark, d):
    a = _works(spark, d, "abstract_display").withColumn("f", text_udf.language_features("abstract_display"))
    return a.select("work_id", text_udf.language_state(F.col("abstract_display"), F.col("f")).alias("state"), "f.hard", "f.win_max", "f.ne_hits")


def _with_revisions(spark: SparkSession, d: str) -> DataFrame:
    """All documents, and of every fiftieth a revision that ends in other words: the test data hold exact copies only."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    revised = docs.where("doc_id % 50 = 0 and length(text) > 400").select((-1 - F.col("doc_id")).alias("doc_id"), F.concat("text", F.lit(" This text was revised.")).alias("text"))
    return docs.unionByName(revised)


@_query("near_duplicate_pairs")
def near_duplicate_pairs(spark, d):
    return near_duplicates.pairs(_with_revisions(spark, d), "doc_id", "text")


@_query("near_duplicate_classes")
def near_duplicate_classes(spark, d):
    return near_duplicates.classes(_with_revisions(spark, d), "doc_id", "text")


# ---- research on rules ----------------------------------------------------------------------------------------------------

CONDITIONAL = ["case_record", "news", "letter"]
BATCHES = [["commentary", "reply", "letter", "books_received", "bibliography"], ["news", "index_toc", "abstracts_meeting", "case_record", "tribute_address"], ["interview", "retraction_notice", "book_review_of", "named_reply", "issue_note"]]
_KEYED = "md5('7:' || work_id)"
_SAMPLE = f"(select work_id, type, row_number() over (partition by type order by {_KEYED}, work_id) as place from (select work_id, unnest(types) as type from hits where not v2_hit))"
_CANDIDATES = "select work_id, unnest(list_filter([" + ", ".join(f"case when regexp_matches(title_display, {q(p)}) then '{t}/{s}/{str(c).lower()}' end" for (t, s), (p, c) in rules.CANDIDATES.items()) + "], lambda x: x is not null)) as f from works"


@_query("hits_by_type", _sql("select type, count(*) as hits, count(*) filter (where not v2_hit) as added, count(distinct case when not v2_hit then nano_id end) as added_nanos from (select *, unnest(types) as type from hits) group by 1"))
def hits_by_type(spark, d):
    return audit.hits_by_type(audit.scan(_hits(spark, d)))


@_query("union_counts", _sql(f"select count(*) as either, count(*) filter (where v2_hit) as v2, count(*) filter (where len(types) > 0) as v3, count(*) filter (where v2_hit and len(types) > 0) as \"both\", count(*) filter (where not v2_hit and len(types) > 0 and len(list_filter(types, lambda t: t not in {tuple(CONDITIONAL)})) = 0) as conditional_only from hits"))
def union_counts(spark, d):
    return audit.union_counts(audit.scan(_hits(spark, d)), CONDITIONAL)


@_query("exclusive_new_by_type", _sql("select types[1] as type, count(*) as works from hits where not v2_hit and len(types) = 1 group by 1"))
def exclusive_new_by_type(spark, d):
    return audit.exclusive_new(audit.scan(_hits(spark, d)))


@_query("second_pass_candidates", _sql(" union all ".join(f"select work_id, nano_id, title_head, '{t}' as type, '{s}' as subform from hits where not v2_hit and list_contains(types, '{t}') and regexp_matches(title_head, {q(p)})" for (t, s), p in rules.SUBFORMS.items())))
def second_pass_candidates(spark, d):
    return audit.second_pass_candidates(audit.scan(_hits(spark, d)))


@_query("candidate_forms", _sql(f"select work_id, split_part(f, '/', 1) as type, split_part(f, '/', 2) as subform, split_part(f, '/', 3) = 'true' as conditional from ({_CANDIDATES})"))
def candidate_forms(spark, d):
    return audit.candidate_forms(_works(spark, d, "title_display").withColumnRenamed("title_display", "title"))


@_query("audit_sample", _sql(f"select * from {_SAMPLE} where place <= 40"))
def audit_sample(spark, d):
    return audit.ordered_sample(audit.scan(_hits(spark, d)))


@_query("blind_audit")
def blind_audit(spark, d):
    return audit.blind_audit(written(audit.scan(_hits(spark, d)), "hits"), BATCHES)


@_query(
    "stratified_sample",
    _sql(f"""select work_id, type, subform, place from (select *, row_number() over (partition by type, subform order by {_KEYED}, work_id) as place, count(*) over (partition by type, subform) as n, count(*) over (partition by type) as total
  from (select distinct work_id, split_part(f, '/', 1) as type, split_part(f, '/', 2) as subform from ({_CANDIDATES}))) where place <= greatest(6, round(45.0::double * n / total))"""),
)
def stratified_sample(spark, d):
    return audit.stratified_sample(candidate_forms(spark, d))


_CALL = "case when r.work_id is not null then 'research' when m.is_retracted is null then 'borderline' else 'other' end"


@_query("fp_rates", _sql(f"select type, count(*) as n, count(*) filter (where call = 'research') as fp, count(*) filter (where call = 'borderline') as borderline, round(count(*) filter (where call = 'research')::double / count(*), 4) as fp_rate from (select h.type, {_CALL} as call from (select work_id, unnest(types) as type from hits) h left join research r on h.work_id = r.work_id left join work_meta m on h.work_id = m.work_id) group by 1"))
def fp_rates(spark, d):
    hits = audit.scan(_hits(spark, d)).select("work_id", F.explode("types").alias("type"))
    both = hits.join(_research(spark, d).withColumn("r", F.lit(True)), "work_id", "left").join(table(spark, d, "work_meta"), "work_id", "left")
    call = F.when(F.col("r"), "research").when(F.col("is_retracted").isNull(), "borderline").otherwise("other")
    return audit.error_rates(both.select("type", call.alias("call")))


@_query("legacy_v1_share", _sql(f"select nano_id, count(*) as n, count(*) filter (where regexp_matches(title, {q(rules.LEGACY_V1)})) as hits, count(*) filter (where title ilike 'correction%') as corrections, count(*) filter (where title like '%$$%') as formulas from mt group by 1"))
def legacy_v1_share(spark, d):
    m = _members(spark, d)
    return m.groupBy("nano_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(matches("title", rules.LEGACY_V1)).alias("hits"), F.count_if(F.col("title").ilike("correction%")).alias("corrections"), F.count_if(F.col("title").like("%$$%")).alias("formulas"))


@_query("legacy_v1_top", _sql(f"select nano_id, hits, n from (select nano_id, count(*) as n, count(*) filter (where regexp_matches(title, {q(rules.LEGACY_V1)})) as hits from mt group by 1) order by hits * 1.0 / n desc, nano_id limit 10"))
def legacy_v1_top(spark, d):
    return legacy_v1_share(spark, d).select("nano_id", "hits", "n").orderBy(F.desc(F.col("hits") / F.col("n")), "nano_id").limit(10)


# ---- strands and states -----------------------------------------------------------------------------------------------------


def _strands(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    return e.select(F.col("label").cast("long").alias("nano_id"), F.col("vec_id").alias("cid"), (1 + F.col("vec_id") % 7).alias("n"), "embedding")


_STRANDS = """e as (select label::bigint as nano_id, vec_id as cid, 1 + vec_id % 7 as n, list_transform(embedding, lambda x: x::double) as v0 from embeddings where embedding is not null),
u as (select nano_id, cid, n, list_transform(v0, lambda x: x / sqrt(list_dot_product(v0, v0))) as v from e),
dims as (select cid, generate_subscripts(v, 1) as i, unnest(v) as x from u),
base as (select (select sum(s * s) from (select i, sum(x) as s from dims group by 1)) / power((select count(*) from u), 2) as mu, (select sum(m * m) from (select a.i, b.i as j, sum(a.x * b.x) as m from dims a join dims b on a.cid = b.cid group by 1, 2)) / power((select count(*) from u), 2) as s2),
b as (select mu, sqrt(s2 - mu * mu) as sd from base),
tot as (select nano_id, sum(n) as total from u group by 1 having count(*) >= 2),
s as (select u.*, u.n * 1.0::double / tot.total as share from u join tot on u.nano_id = tot.nano_id),
prox as (select s.nano_id, s.cid, s.n, s.share, sum(r.share * (list_dot_product(s.v, r.v) - b.mu) / b.sd) / sum(r.share) as prox from s cross join b left join s r on s.nano_id = r.nano_id and r.n >= 3 and r.cid <> s.cid group by 1, 2, 3, 4)"""


@_query("strand_baseline", f"with {_STRANDS} select round(mu, 6) as mu, round(sd, 6) as sd from b")
def strand_baseline(spark, d):
    b = strands.baseline(_strands(spark, d))
    return b.select(F.round("mu", 6).alias("mu"), F.round("sd", 6).alias("sd"))


@_query("strand_proximity", f"with {_STRANDS} select nano_id, cid, n, round(share, 6) as share, round(prox, 6) as prox, coalesce(prox < 2.0, false) as far from prox")
def strand_proximity(spark, d):
    s = _strands(spark, d)
    p = strands.proximity(s, strands.baseline(s))
    return p.withColumns({"share": F.round("share", 6), "prox": F.round("prox", 6)})


@_query("core_shares", f"with {_STRANDS} select nano_id, coalesce(sum(n) filter (where prox < 2.0), 0)::bigint as far_docs, sum(n)::bigint as attached_docs, count(*) filter (where not coalesce(prox < 2.0, false) and n >= 3) as n_core_strands, round(1 - coalesce(sum(n) filter (where prox < 2.0), 0) * 1.0::double / greatest(sum(n), 1), 6) as core_share from prox group by 1")
def core_shares(spark, d):
    s = _strands(spark, d)
    return strands.core_shares(strands.proximity(s, strands.baseline(s))).withColumn("core_share", F.round("core_share", 6))


@_query("residue_by_nano", _sql("select nano_id, count(*) as n_residue from mt where nano_id in (select nano_id from ratio where pct_mem_jd >= 30) and work_id not in (select work_id from excl) and work_id not in (select r.work_id from rows_ r left join works w on r.work_id = w.work_id where r.ut and not r.jd and coalesce(w.abstract_display, '') = '') group by 1"))
def residue_by_nano(spark, d):
    members, out = _exclusion(spark, d)
    out = written(out, "exclusion")
    flagged = ratios.nano_ratios(members, out, _core(spark, d)).where(F.col("pct_mem_jd") >= config.REVIEW)
    junk = out.where(F.col("reason").like("junk_regex_%")).select("work_id")
    with_abstract = _works(spark, d, "abstract_display").where(F.length("abstract_display") > 0)
    no_info = members.where(text.uninformative_title("title")).join(with_abstract, "work_id", "left_anti").join(junk, "work_id", "left_anti")
    return strands.residue(members, flagged, out, no_info)
