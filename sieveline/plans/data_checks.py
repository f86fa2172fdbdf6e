"""Queries of problems 3 and 5, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.diff import diff_copies
from ..operators.skew import check_counts, combine_by_key, distinct_per_key
from ..sources.tables import table

FIELDS = ["nano_id", "reason", "title_head", "snapshot"]


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    a, b = table(spark, d, "exclusion_flags"), table(spark, d, "exclusion_flags_v3")
    return diff_copies(a, b, "work_id", FIELDS, "exclusion_flags", "exclusion_flags_v3")


def p3_summary(spark: SparkSession, d: str) -> DataFrame:
    return p3_found(spark, d).groupBy("diff", "field_name").agg(F.count(F.lit(1)).alias("works"))


def p5_members(spark: SparkSession, d: str) -> DataFrame:
    return distinct_per_key(table(spark, d, "atlas_work_membership"), "effective_nano_id", "work_id")


def p5_checked(spark: SparkSession, d: str) -> DataFrame:
    return check_counts(p5_members(spark, d), table(spark, d, "a5_dist"), "effective_nano_id", "nano_id", "members")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_checked(spark, d).where(~F.col("agrees")).select("nano_id")


def p5_loads(spark: SparkSession, d: str) -> DataFrame:
    """Rows and first and last load of each nano, in one combine."""
    t = table(spark, d, "atlas_work_membership")
    return combine_by_key(t, "effective_nano_id", {"n_rows": F.count(F.lit(1)), "first_load": F.min("loaded_at"), "last_load": F.max("loaded_at")})


_MEMBERS = "select effective_nano_id, count(distinct work_id) as members from atlas_work_membership where effective_nano_id is not null and work_id is not null group by 1"
_CHECKED = f"""select coalesce(m.effective_nano_id, d.nano_id) as nano_id, coalesce(m.members, 0) as members,
  case when d.nano_id is null then 0 else d.members end as claimed,
  coalesce(case when d.nano_id is null then 0 else d.members end = coalesce(m.members, 0), false) as agrees
from ({_MEMBERS}) m full outer join (select * from a5_dist where nano_id is not null) d on m.effective_nano_id = d.nano_id"""
_DIFF = "with a as (select distinct * from exclusion_flags), b as (select distinct * from exclusion_flags_v3), j as (select a.work_id as ka, b.work_id as kb, a.nano_id as a_nano_id, b.nano_id as b_nano_id, a.reason as a_reason, b.reason as b_reason, a.title_head as a_title_head, b.title_head as b_title_head, a.snapshot as a_snapshot, b.snapshot as b_snapshot, a.ia, b.ib from (select *, true as ia from a) a full outer join (select *, true as ib from b) b on a.work_id is not distinct from b.work_id) " + (
    "select coalesce(ka, kb) as work_id, case when ib is null then 'only_in_exclusion_flags' else 'only_in_exclusion_flags_v3' end as diff, '' as field_name from j where ia is null or ib is null"
    + "".join(f" union all select ka as work_id, 'value' as diff, '{c}' as field_name from j where ia and ib and a_{c} is distinct from b_{c}" for c in FIELDS)
)

QUERIES = {"p3_found": p3_found, "p3_summary": p3_summary, "p5_found": p5_found, "p5_members": p5_members, "p5_checked": p5_checked, "p5_loads": p5_loads}
SQL = {
    "p3_found": _DIFF,
    "p3_summary": f"select diff, field_name, count(*) as works from ({_DIFF}) group by 1, 2",
    "p5_found": f"select nano_id from ({_CHECKED}) where not agrees",
    "p5_members": _MEMBERS,
    "p5_checked": _CHECKED,
    "p5_loads": "select effective_nano_id, count(*) as n_rows, min(loaded_at) as first_load, max(loaded_at) as last_load from atlas_work_membership where effective_nano_id is not null group by 1",
}
