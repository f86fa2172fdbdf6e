"""Document flags by title rules, second-pass demotion and their combination."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import rules
from ..functions.dialect import matches
from ..runtime import by_key


def primary_members(membership: DataFrame) -> DataFrame:
    """One row per work: its smallest nano. Rows without work or nano are no membership."""
    m = membership.where(F.col("work_id").isNotNull() & F.col("effective_nano_id").isNotNull())
    return m.groupBy("work_id").agg(F.min("effective_nano_id").alias("nano_id"))


def latest_works(bib: DataFrame, *columns: str) -> DataFrame:
    """One row per work with the given columns as last delivered; other columns are not read."""
    last = bib.where(F.col("work_id").isNotNull()).groupBy("work_id").agg(F.max(F.struct("loaded_at", *columns)).alias("r"))
    return last.select("work_id", *[F.col(f"r.{c}").alias(c) for c in columns])


def title_members(membership: DataFrame, bib: DataFrame, *more: str) -> DataFrame:
    """``work_id, nano_id, title`` of every member; a member without bibliography has the empty title."""
    works = latest_works(bib, "title_display", *more)
    joined = primary_members(membership).join(works, "work_id", "left")
    return joined.select("work_id", "nano_id", F.coalesce("title_display", F.lit("")).alias("title"), *more)


def matched_works(bib: DataFrame) -> DataFrame:
    """``work_id, title`` of the works whose title some rule hits.

    Titles are matched here, once for each work and before any join, so members without bibliography (whose empty title
    no rule hits) and works delivered or filed more than once cost nothing; only hits reach the joins.
    """
    rows = by_key(bib.select("work_id", "loaded_at", "title_display"), "work_id")
    works = latest_works(rows, "title_display").select("work_id", F.coalesce("title_display", F.lit("")).alias("title"))
    hit = functools.reduce(operator.or_, [matches("title", rules.V2), *[matches("title", p) for p in rules.V3.values()]])
    return works.where(F.length("title") > 0).where(hit)


def hit_members(membership: DataFrame, bib: DataFrame) -> DataFrame:
    """``work_id, nano_id, title`` of the members that some rule hits: all that flags are made of."""
    return primary_members(membership).join(matched_works(bib), "work_id")


def type_array(title: Column, patterns: dict[str, str] = rules.V3, exclude: dict[str, str] = rules.V3_EXCLUDE) -> Column:
    """Ids of all rules that match, in catalogue order: one projection for the whole catalogue."""
    hits = [F.when(matches(title, p) & ~matches(title, exclude[k]) if k in exclude else matches(title, p), F.lit(k)) for k, p in patterns.items()]
    return F.array_compact(F.array(*hits))


def typed_once(df: DataFrame, title: Column, name: str = "junk_types") -> DataFrame:
    """``df`` with its type array, made by a one-row generator: a filter on the array isn't pushed below it, where the
    whole catalogue would be matched a second time."""
    return df.select("*", F.explode(F.array(type_array(title))).alias(name))


def v2_flags(members: DataFrame) -> DataFrame:
    hit = members.where(matches("title", rules.V2))
    return hit.select("work_id", "nano_id", F.substring("title", 1, config.HEAD_RULE).alias("title_head"), F.lit("junk_regex_v2").alias("reason"))


def v3_flags(members: DataFrame) -> DataFrame:
    head = F.substring("title", 1, config.HEAD_RULE).alias("title_head")
    return typed_once(members, F.col("title")).select("work_id", "nano_id", head, "junk_types").where(F.size("junk_types") > 0)


def demote(v3: DataFrame, research: DataFrame) -> DataFrame:
    """``flag_only`` marks works that a second judgement found to be research; ``research`` has their ids."""
    ids = research.select("work_id").distinct().withColumn("known", F.lit(True))
    return v3.join(ids, "work_id", "left").withColumn("flag_only", F.coalesce("known", F.lit(False))).drop("known")


def combine_flags(v2: DataFrame, v3: DataFrame) -> DataFrame:
    """All flagged works; a hit of the second generation can never be flag-only and has an empty type list if alone."""
    x, y = v2.alias("x"), v3.alias("y")
    both = x.join(y, F.col("x.work_id") == F.col("y.work_id"), "full_outer")
    is_v2 = F.col("x.work_id").isNotNull()
    return both.select(
        F.coalesce("x.work_id", "y.work_id").alias("work_id"),
        F.coalesce("x.nano_id", "y.nano_id").alias("nano_id"),
        F.coalesce("x.title_head", "y.title_head").alias("title_head"),
        F.coalesce("y.junk_types", F.array().cast("array<string>")).alias("junk_types"),
        F.when(is_v2, "v2").otherwise("v3").alias("flag_source"),
        (F.coalesce("y.flag_only", F.lit(False)) & ~is_v2).alias("flag_only"),
    )


def title_type(title: Column) -> Column:
    """First matching type of the second generation, else ``other``."""
    out = F
    for name, pattern in rules.TITLE_TYPES.items():
        out = out.when(matches(title, pattern), name)
    return out.otherwise("other")
