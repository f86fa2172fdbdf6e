"""Queries of the research on rules beyond the counts, and over file sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules, text
from ..functions.dialect import sql_literal as q
from ..operators import audit, research, status
from ..runtime import shared_dir
from ..sources import files
from ..sources.tables import table
from .screening import _BASE, _hits, _retracted, _works, exclusion_reason_counts

QUERIES, SQL = {}, {}


def _query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _sql(query: str) -> str:
    """A query over the shared tables; one that begins with a comma adds tables of its own."""
    return f"with {_BASE}{query if query.startswith(',') else ' ' + query}"


# ---- one title for each rule and form, all words of titles of the bibliography, so that every rule has hits ---------------

#: A beginning for every rule and form; a work takes one by its number and goes on with its own title.
BEGINNINGS = [
    "Commentary: ", "Reply to: ", "Letter to the editor: ", "Editor's note ", "Books received ", "Bibliography of ", "News: ", "Author index ", "Abstracts of the ", "Quiz: ", "In memoriam ", "Interview: ", "Retraction: ", "Review of: ",
    "Reply to Smith et al. ", "Highlights of this issue ", "Thanks to our reviewers ", "Strip of the month ", "Annals Editors' Picks: ", "Annals masthead vol 3 ", "Contents vol 2 ", "Annals books received vol 1 ", "Correspondence vol 4 ", "Annals in this issue vol 2 ", "Annals review of: ", "Annals thanks to our reviewers ", "Poster abstracts 12 ",
    "Current issues: ", "Research watch: ", "Research update: latest ", "Highlights of the spring meeting ", "Letter: ", "Conversation with ", "Presidential address: ", "Addendum ", "Withdrawn: ", "In brief ", "News & notes ", "General meeting ", "Meeting report: ", "Book list ", "Review essay: ", "Case 12-2019 ", "Introduction to ",
    "Spotlight on the May 3 issue ", "In this number: ", "About this issue: ", "Perspectives on this issue ", "Reviewers thank you ", "Reviewers for 2019 ", "Reviewer of the year ", "Nature reviewer acknowledgement ", "Editors' picks ", "Editor's choice: ", "Editor's spotlight: ", "Lesson of the week ", "Image of the month ", "Editorial ", "",
]
#: Titles that are a beginning alone.
WHOLE = ["In this issue", "This week's no. 1", "Nature reviewers 2019", "Response to Miller", "Review of Rivers by Ann Poe", "Contents", "Correspondence", "Abstracts"]


def _made(spark: SparkSession, d: str) -> DataFrame:
    n = F.regexp_extract("work_id", "([0-9]+)", 1).try_cast("bigint")
    begin = F.element_at(F.array(*map(F.lit, BEGINNINGS)), (n % len(BEGINNINGS) + 1).cast("int"))
    alone = F.element_at(F.array(*map(F.lit, WHOLE)), (n % len(WHOLE) + 1).cast("int"))
    title = F.when(n % 5 == 0, alone).otherwise(F.concat(begin, F.coalesce("title_display", F.lit(""))))
    return _works(spark, d, "title_display").where(n.isNotNull()).select("work_id", title.alias("title"))


_MADE = f"""made as (select work_id, case when k % 5 = 0 then ([{", ".join(map(q, WHOLE))}])[k % {len(WHOLE)} + 1] else ([{", ".join(map(q, BEGINNINGS))}])[k % {len(BEGINNINGS)} + 1] || coalesce(title_display, '') end as title
  from (select *, try_cast(regexp_extract(work_id, '([0-9]+)', 1) as bigint) as k from works) where k is not null)"""


def _forms_sql(catalogue: dict[tuple[str, str], str]) -> str:
    return " union all ".join(f"select work_id, '{t}' as type, '{s}' as subform from made where regexp_matches(title, {q(p)})" for (t, s), p in catalogue.items())


_CANDIDATES = {k: p for k, (p, _) in rules.CANDIDATES.items()}
_RULES_SQL = " union all ".join(f"select work_id, '{k}' as rule from made where regexp_matches(title, {q(p)})" + (f" and not regexp_matches(title, {q(rules.V3_EXCLUDE[k])})" if k in rules.V3_EXCLUDE else "") for k, p in rules.V3.items())


@_query("rules_on_made_titles", _sql(f", {_MADE} select rule, count(*) as works from ({_RULES_SQL}) group by 1"))
def rules_on_made_titles(spark, d):
    from ..operators.flags import typed_once

    return typed_once(_made(spark, d), F.col("title"), "types").select(F.explode("types").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("works"))


@_query("second_pass_forms", _sql(f", {_MADE} {_forms_sql(rules.SUBFORMS)}"))
def second_pass_forms(spark, d):
    return research.forms(_made(spark, d), rules.SUBFORMS)


@_query("candidate_forms_on_made_titles", _sql(f", {_MADE} {_forms_sql(_CANDIDATES)}"))
def candidate_forms_on_made_titles(spark, d):
    return research.forms(_made(spark, d), _CANDIDATES)


@_query("audit_forms", _sql(f", {_MADE} {_forms_sql(rules.AUDIT_FORMS)}"))
def audit_forms(spark, d):
    return research.forms(_made(spark, d), rules.AUDIT_FORMS)


@_query("audit_forms_per_work", _sql(f", {_MADE} select work_id, array_to_string(list_sort(list(distinct subform)), ',') as subforms from ({_forms_sql(rules.AUDIT_FORMS)}) group by 1"))
def audit_forms_per_work(spark, d):
    return research.forms_per_work(audit_forms(spark, d))


@_query("genre_words", _sql(f", {_MADE} select work_id from made where regexp_matches(title, {q(rules.GENRE_WORD)})"))
def genre_words(spark, d):
    return research.genre_words(_made(spark, d))


# ---- counts of hits -------------------------------------------------------------------------------------------------------

_CALLS = "calls as (select work_id, (k % 3 + 1)::int as call_batch from (select work_id, try_cast(regexp_extract(work_id, '([0-9]+)', 1) as bigint) as k from hits) where k % 10 <> 0), akey as (select work_id, case when k % 7 = 0 then 9 else k % 3 + 1 end::int as batch from (select work_id, try_cast(regexp_extract(work_id, '([0-9]+)', 1) as bigint) as k from hits) where k % 11 <> 0)"


@_query("calls_matched", _sql(f", {_CALLS} select count(*) filter (where c.work_id is null) as key_only, count(*) filter (where k.work_id is null) as calls_only, count(*) filter (where k.work_id is not null and c.work_id is not null) as \"both\", count(*) filter (where k.batch <> c.call_batch) as other_batch from akey k full outer join calls c on k.work_id = c.work_id"))
def calls_matched(spark, d):
    k = F.regexp_extract("work_id", "([0-9]+)", 1).try_cast("bigint")
    hits = audit.scan(_hits(spark, d)).select("work_id")
    calls = hits.where(k % 10 != 0).withColumn("call_batch", (k % 3 + 1).cast("int"))
    key = hits.where(k % 11 != 0).withColumn("batch", F.when(k % 7 == 0, 9).otherwise((k % 3 + 1).cast("int")))
    return research.match_calls(key, calls)


_REPORTED = "reported as (select type, case when length(type) % 2 = 0 then hits else hits + 1 end as reported from (select type, count(*) as hits from (select unnest(types) as type from hits) group by 1))"


@_query("recount_differences", _sql(f", {_REPORTED} select r.type, c.n as recounted, r.reported from reported r join (select type, count(*) as n from (select unnest(types) as type from hits) group by 1) c on r.type = c.type where c.n <> r.reported"))
def recount_differences(spark, d):
    """A recount against counts that were altered for every other rule."""
    hits = audit.scan(_hits(spark, d))
    reported = audit.hits_by_type(hits).select("type", F.when(F.length("type") % 2 == 0, F.col("hits")).otherwise(F.col("hits") + 1).alias("hits"))
    return research.recount(hits, reported)


@_query("hits_not_retracted", _sql("select type, count(*) as hits, count(*) filter (where not v2_hit) as added, count(*) filter (where v2_hit) as shared, count(distinct nano_id) as nanos from (select *, unnest(types) as type from hits where work_id not in (select work_id from ret)) group by 1"))
def hits_not_retracted(spark, d):
    members = _hits(spark, d)
    return research.by_retraction(audit.scan(members), _retracted(members, spark, d))


@_query("hit_attribution", _sql(r"select type, count(*) filter (where regexp_matches(title_head, '^\s*[\w''’ ]{1,40}\s*,')) as comma, count(*) filter (where regexp_matches(title_head, '^\s*[\w''’ ]{1,40}\s*[–—]')) as joined_dash, count(*) filter (where v2_hit) as in_second from (select *, unnest(types) as type from hits) group by 1"))
def hit_attribution(spark, d):
    return research.attribution(audit.scan(_hits(spark, d)))


@_query("hits_of_some_rules", _sql("select work_id from hits where list_has_any(types, ['news', 'reply'])"))
def hits_of_some_rules(spark, d):
    return research.overlapping(audit.scan(_hits(spark, d)), ["news", "reply"]).select("work_id")


@_query("audit_batches", _sql("select work_id, md5('7:' || work_id || ':batch') as order_key, (('0x' || substr(md5('7:' || work_id || ':batch'), 1, 8))::bigint % 6)::int as batch from hits"))
def audit_batches(spark, d):
    return research.batches(audit.scan(_hits(spark, d)), 6)


@_query("hash_sample", _sql(f"select work_id from mt where ('0x' || substr(md5('7:' || work_id), 1, 8))::bigint < {int(0.05 * (1 << 32))}"))
def hash_sample(spark, d):
    """A sample is the feature here: one twentieth of the members, the same in every engine."""
    from .screening import _members

    return research.hash_sample(_members(spark, d), "work_id", 0.05).select("work_id")


@_query("expected_totals", _sql("select coalesce(c.reason, e.reason) as reason, coalesce(n, 0) as documents, coalesce(expected, 0) as expected, coalesce(n, 0) = coalesce(expected, 0) as agrees from (select reason, count(*) as n from excl group by 1) c full outer join (values ('retracted', 1), ('junk_regex_v2', 2), ('other', 3)) e(reason, expected) on c.reason = e.reason"))
def expected_totals(spark, d):
    return research.expected_totals(exclusion_reason_counts(spark, d), {"retracted": 1, "junk_regex_v2": 2, "other": 3})


@_query("content_words", _sql("select work_id, array_to_string(list_filter(string_split(trim(regexp_replace(regexp_replace(lower(title), '[^a-z0-9 -]+', ' ', 'g'), ' +', ' ', 'g')), ' '), lambda w: length(w) >= 3 and w not in (" + ", ".join(q(w) for w in text.STOP) + ")), ' ') as words from mt"))
def content_words(spark, d):
    from .screening import _members

    return _members(spark, d).select("work_id", F.array_join(research.content_words(text.norm("title")), " ").alias("words"))


@_query("year_counts", "select nano, round(avg(publication_year), 3) as mean_year, count(*) as n, greatest(count(*) filter (where publication_year between 1990 and 1999), count(*) filter (where publication_year between 2000 and 2009)) as busiest from (select *, coalesce(lower(type_openalex), 'none') as nano from bib_store) group by all order by all")
def year_counts(spark, d):
    """BETWEEN, a rounded average, ``greatest`` and GROUP BY ALL, in SQL."""
    table(spark, d, "bib_store").createOrReplaceTempView("sieveline_bib")
    return spark.sql("select nano, round(avg(publication_year), 3) as mean_year, count(*) as n, greatest(count(*) filter (where publication_year between 1990 and 1999), count(*) filter (where publication_year between 2000 and 2009)) as busiest from (select *, coalesce(lower(type_openalex), 'none') as nano from sieveline_bib) group by all order by all")


# ---- files ----------------------------------------------------------------------------------------------------------------


def _folder(spark: SparkSession, name: str) -> str:
    import uuid

    return f"{shared_dir(spark)}/sieveline-{name}-{uuid.uuid4().hex}"


@_query("csv_round_trip", "select work_id, effective_nano_id::varchar as cluster_id from atlas_work_membership where work_id is not null and effective_nano_id is not null")
def csv_round_trip(spark, d):
    """Members written as CSV and read as strings."""
    path = _folder(spark, "csv")
    m = table(spark, d, "atlas_work_membership").where("work_id is not null and effective_nano_id is not null")
    m.select("work_id", F.col("effective_nano_id").cast("string").alias("cluster_id")).write.option("header", True).csv(path)
    return files.string_csv(spark, path, ["work_id", "cluster_id"])


@_query("jsonl_research_ids", "select distinct work_id from junk_doc_flags_v3 where flag_only and work_id is not null")
def jsonl_research_ids(spark, d):
    """Judgements written as JSON lines, of which the research ids are read."""
    path = _folder(spark, "jsonl")
    files.write_jsonl(table(spark, d, "junk_doc_flags_v3").where("work_id is not null").select("work_id", F.when(F.col("flag_only"), "research").otherwise("other").alias("verdict")), path)
    return files.research_ids(spark, path)


@_query("last_record_wins", "select nano_id, case when count(*) % 2 = 0 then 'even' else 'odd' end as verdict from (select distinct work_id, nano_id from exclusion_flags where nano_id is not null and work_id is not null) group by 1")
def last_record_wins(spark, d):
    """Keyed records with an explicit sequence: the last one is that of the number of works."""
    from pyspark.sql import Window

    rows = table(spark, d, "exclusion_flags").where("nano_id is not null and work_id is not null").select("work_id", "nano_id").distinct()
    seq = rows.withColumn("seq", F.row_number().over(Window.partitionBy("nano_id").orderBy("work_id")))
    return status.last_verdict(seq.withColumn("verdict", F.when(F.col("seq") % 2 == 0, "even").otherwise("odd")), "nano_id", "seq", "verdict")


@_query("ordered_sink", "select nano_id, members from a5_dist where nano_id is not null")
def ordered_sink(spark, d):
    path = _folder(spark, "ordered")
    files.write_ordered(table(spark, d, "a5_dist").where("nano_id is not null").select("nano_id", "members"), path, "nano_id")
    return spark.read.parquet(path)


@_query("optional_source", "select nano_id, members from a5_dist where false")
def optional_source(spark, d):
    """A source that isn't there is an empty table of its schema."""
    from ..sources.tables import SCHEMAS

    return files.optional(spark, f"{d}/no_such_table.parquet", SCHEMAS["a5_dist"]).select("nano_id", "members")


@_query("pack_contract", _sql("select sum(size)::bigint as packed, (select count(*) from mt where work_id not in (select work_id from excl)) as kept, true as agrees from (select nano_id, count(*) as size from mt where work_id not in (select work_id from excl) group by 1)"))
def pack_contract(spark, d):
    from .screening import _exclusion

    members, out = _exclusion(spark, d)
    packs = members.join(out.select("work_id"), "work_id", "left_anti").groupBy("nano_id").agg(F.count(F.lit(1)).alias("size"))
    return status.size_contract(packs, members, out)
